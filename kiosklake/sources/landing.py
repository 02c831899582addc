"""Landed JSON documents: typed parsing that never fails a job on a bad document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from kiosklake.sources.schemas import DOCUMENTS, SCHEMAS


def read_landing(spark: SparkSession, path: str, name: str) -> DataFrame:
    """JSON-lines documents of one landing table.

    A line that is not valid JSON keeps its text in ``_corrupt_record`` and has
    NULL fields, in place of a per-document try/except; ``_file`` names its file.
    """
    fields = [*SCHEMAS[name].fields, T.StructField("_corrupt_record", T.StringType())]
    lines = spark.read.schema(T.StructType(fields)).json(path, mode="PERMISSIVE")
    return lines.select("*", F.col("_metadata.file_name").alias("_file"))


def accepted(landed: DataFrame, key: str = "film_id") -> DataFrame:
    """Documents that parsed and carry their key."""
    return landed.filter(F.col("_corrupt_record").isNull() & F.col(key).isNotNull()).drop("_corrupt_record", "_file")


def rejected(landed: DataFrame, key: str = "film_id") -> DataFrame:
    """Documents that did not parse or lack their key."""
    return landed.filter(F.col("_corrupt_record").isNotNull() | F.col(key).isNull())


def elements(df: DataFrame, column: str, shape: str) -> DataFrame:
    """One row per array element of a JSON text column: ``pos`` and the struct ``item``.

    Text that is not a JSON array of the shape yields no rows; ``unparsed`` lists it.
    """
    parsed = F.from_json(F.col(column), shape, {"mode": "PERMISSIVE"})
    return df.select("*", F.posexplode(parsed).alias("pos", "item")).drop(column)


def unparsed(df: DataFrame, key: str, shapes: dict[str, str]) -> DataFrame:
    """``(key, column_name, document)`` for JSON text columns that do not parse as their shape."""
    frames = []
    for column, shape in shapes.items():
        broken = F.col(column).isNotNull() & F.from_json(F.col(column), shape, {"mode": "PERMISSIVE"}).isNull()
        frames.append(df.filter(broken).select(key, F.lit(column).alias("column_name"), F.col(column).alias("document")))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


# ---------------------------------------------------------------- quarantine

def quarantined(landed: DataFrame, name: str, key: str = "film_id") -> DataFrame:
    """What cannot be loaded of a landing table, as rows of the ``quarantine`` table.

    A line that is no JSON or has no key is kept whole (``column_name`` NULL); of a line whose
    JSON text column does not parse as its shape that column is kept. ``landed`` is a read
    landing table, or one without ``_corrupt_record`` and ``_file``.
    """
    from_file = "_file" in landed.columns
    file_name = F.col("_file") if from_file else F.lit(None).cast("string")

    def entry(rows: DataFrame, column, document) -> DataFrame:
        return rows.select(
            F.lit(name).alias("table_name"), file_name.alias("file_name"), column.cast("string").alias("column_name"),
            F.col(key).alias("film_id"), document.alias("document"),
        )

    fields = [c for c in landed.columns if not c.startswith("_")]
    corrupt = F.col("_corrupt_record") if "_corrupt_record" in landed.columns else F.lit(None).cast("string")
    whole = F.coalesce(corrupt, F.to_json(F.struct(*fields)))
    out = entry(landed.filter(corrupt.isNotNull() | F.col(key).isNull()), F.lit(None), whole)
    for column, shape in DOCUMENTS.get(name, {}).items():
        broken = F.col(column).isNotNull() & F.from_json(F.col(column), shape, {"mode": "PERMISSIVE"}).isNull()
        out = out.unionByName(entry(landed.filter(F.col(key).isNotNull() & broken), F.lit(column), F.col(column)))
    return out


def replayed(spark: SparkSession, quarantine: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Entries of one landing table read again, as mended in ``document``: rows to load, and what is still broken.

    A whole line gives its row; a single column gives a row with the other columns NULL.
    """
    schema = SCHEMAS[name]
    mine = quarantine.filter(F.col("table_name") == name)
    lines = mine.filter(F.col("column_name").isNull())
    read = F.from_json("document", schema, {"mode": "PERMISSIVE"})
    parts = [lines.select(read.alias("_row")).select("_row.*")]
    for column in DOCUMENTS.get(name, {}):
        filled = [
            F.col("film_id") if f.name == "film_id" else F.col("document") if f.name == column else F.lit(None)
            for f in schema.fields
        ]
        parts.append(mine.filter(F.col("column_name") == column).select(
            *[c.cast(f.dataType).alias(f.name) for c, f in zip(filled, schema.fields)]
        ))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    still = quarantined(rows, name)
    fine = rows.filter(F.col("film_id").isNotNull())
    for column, shape in DOCUMENTS.get(name, {}).items():
        parsed = F.from_json(F.col(column), shape, {"mode": "PERMISSIVE"})
        fine = fine.filter(F.col(column).isNull() | parsed.isNotNull())
    return fine, still
