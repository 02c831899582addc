"""A set of named tables, with typed loading and versioned snapshots.

History tables are stored in folders by the month in which a row starts and, for periods, the
month in which it ends or ``open``. A period question so opens only the folders it can concern,
and closing rentals moves rows between two folders of their month. A version of the tables is a
list of folders, each written in that version or an earlier one: a job rewrites the folders that
its changed rows leave or enter, and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kiosklake.functions.periods import contains, is_open, moment, month_text, overlaps
from kiosklake.session import materialize
from kiosklake.sources.schemas import KEYS, SCHEMAS

OPEN = "open"


@dataclass(frozen=True)
class Layout:
    """The column whose month a table is stored by, and the end of its periods if it has any."""

    start: str
    end: str | None = None

    @property
    def folders(self) -> list[str]:
        return ["month"] if self.end is None else ["month", "until"]


_LAYOUT = {
    "rental": Layout("period_start", "period_end"), "payment": Layout("payment_date"),
    "revenue_part": Layout("revenue_month"),
}


class Tables(Mapping[str, DataFrame]):
    """Tables by name or attribute; a table may be given lazily as a function.

    ``slices`` holds, for tables stored by month, a function that opens only the folders
    that a stretch of time concerns.
    """

    def __init__(
        self,
        entries: Mapping[str, DataFrame | Callable[[], DataFrame]],
        slices: Mapping[str, Callable[..., DataFrame]] | None = None,
    ):
        self._entries = dict(entries)
        self._slices = dict(slices or {})

    def within(self, name: str, lo=None, hi=None) -> DataFrame:
        """A table without the months that lie wholly outside ``[lo, hi]``.

        Rows just outside can remain, so callers filter as if nothing was skipped;
        a table that is not stored by month comes back whole.
        """
        return self._cut(name, lo=lo, hi=hi)

    def still_open(self, name: str) -> DataFrame:
        """Rows whose period has no end."""
        return self._cut(name, only_open=True).filter(is_open(F.col(_LAYOUT[name].end)))

    def touching(self, name: str, lo, hi) -> DataFrame:
        """Rows whose period shares an instant with ``[lo, hi)``."""
        at = _LAYOUT[name]
        return self._cut(name, hi=hi, until=lo).filter(overlaps(F.col(at.start), F.col(at.end), lo, hi))

    def holding(self, name: str, at) -> DataFrame:
        """Rows whose period contains an instant."""
        by = _LAYOUT[name]
        return self._cut(name, hi=at, until=at).filter(contains(F.col(by.start), F.col(by.end), at))

    def of_months(self, name: str, months: list[str]) -> DataFrame:
        """Rows that start in the named months (as ``yyyy-MM``)."""
        return self._cut(name, months=months).filter(month_text(F.col(_LAYOUT[name].start)).isin(months))

    def _cut(self, name: str, **cut) -> DataFrame:
        return self._slices[name](**cut) if name in self._slices else self[name]

    def __getitem__(self, name: str) -> DataFrame:
        entry = self._entries[name]
        if not isinstance(entry, DataFrame):
            entry = self._entries[name] = entry()
        return entry

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            return self[name]
        except KeyError as missing:
            raise AttributeError(name) from missing

    def __iter__(self) -> Iterator[str]:
        return iter(self._entries)

    def __len__(self) -> int:
        return len(self._entries)

    def joined(self, other: "Tables") -> "Tables":
        """The tables of both; of one name that of ``other``. None is opened."""
        return Tables({**self._entries, **other._entries}, {**self._slices, **other._slices})

    def replaced(self, **changed: DataFrame | Callable[[], DataFrame]) -> "Tables":
        """A new set with some tables exchanged; the rest is shared."""
        slices = {name: cut for name, cut in self._slices.items() if name not in changed}
        return Tables({**self._entries, **changed}, slices)


def _stored(name: str) -> StructType:
    """The declared schema with the folder columns."""
    folders = _LAYOUT[name].folders if name in _LAYOUT else []
    return StructType([*SCHEMAS[name].fields, *[StructField(f, StringType()) for f in folders]])


def _cut_folders(
    df: DataFrame, name: str, *, lo=None, hi=None, until=None, only_open: bool = False, months: list[str] | None = None
) -> DataFrame:
    """Folders that start in ``[lo, hi]`` or in ``months`` and end in or after ``until``'s month, if at all."""
    if months is not None:
        df = df.filter(F.col("month").isin(months))
    if lo is not None:
        df = df.filter(F.col("month") >= month_text(moment(lo)))
    if hi is not None:
        df = df.filter(F.col("month") <= month_text(moment(hi)))
    if until is not None:
        df = df.filter((F.col("until") == OPEN) | (F.col("until") >= month_text(moment(until))))
    if only_open:
        df = df.filter(F.col("until") == OPEN)
    return df


def load(spark: SparkSession, root: str, name: str, **cut) -> DataFrame:
    """One table of a folder with its declared schema (no inference, so columns prune and filters push).

    A table stored by month can be cut: ``lo`` and ``hi`` to the months of a stretch of
    time, ``until`` to periods that end in or after a month, ``only_open`` to open ones.
    """
    df = spark.read.schema(_stored(name)).parquet(f"{root}/{name}")
    return (_cut_folders(df, name, **cut) if name in _LAYOUT else df).select(*SCHEMAS[name].names)


def load_all(spark: SparkSession, root: str, names=None) -> Tables:
    """Every table below a folder, opened on first use."""
    def opener(name: str) -> Callable[[], DataFrame]:
        return lambda: load(spark, root, name)

    def slicer(name: str) -> Callable[..., DataFrame]:
        return lambda **cut: load(spark, root, name, **cut)

    names = list(names or SCHEMAS)
    return Tables({n: opener(n) for n in names}, {n: slicer(n) for n in names if n in _LAYOUT})


def conformed(df: DataFrame, name: str) -> DataFrame:
    """Columns of a frame cast and ordered as the declared schema; absent ones NULL."""
    fields = SCHEMAS[name].fields
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in fields
        ]
    )


def _in_folders(df: DataFrame, name: str) -> DataFrame:
    """Rows with the folder columns; a row without a start has the last month."""
    at = _LAYOUT[name]
    df = df.withColumn("month", F.coalesce(month_text(F.col(at.start)), F.lit("unknown")))
    if at.end is None:
        return df
    return df.withColumn("until", F.coalesce(month_text(F.col(at.end)), F.lit(OPEN)))


def _write(df: DataFrame, name: str, path: str) -> None:
    out = conformed(df, name) if name in SCHEMAS else df
    if name in _LAYOUT:
        # a rebalance splits a busy folder over tasks and joins quiet ones, by their real sizes
        at = _LAYOUT[name]
        out = _in_folders(out, name).hint("rebalance", *at.folders)
        out.sortWithinPartitions(*at.folders, at.start).write.mode("overwrite").partitionBy(*at.folders).parquet(path)
    else:
        out.write.mode("overwrite").parquet(path)


# ---------------------------------------------------------------- versions

_MANIFEST = "version int, table string, folder string, written_in int"
#: The folder of a table that is stored whole.
_WHOLE = ""


def _folder(row) -> str:
    return "/".join(f"{column}={value}" for column, value in row.asDict().items())


def _place(root: str, name: str, written_in: int, folder: str = _WHOLE) -> str:
    return f"{root}/{name}/written={written_in}" + (f"/{folder}" if folder else "")


def _folders_of(df: DataFrame, name: str) -> set[str]:
    """The folders a frame's rows lie in (one row per pair of months is read)."""
    return {_folder(row) for row in df.select(*_LAYOUT[name].folders).distinct().collect()}


def _written(df: DataFrame, root: str, name: str, version: int) -> dict[str, int]:
    """Write a table's rows for a version; the folders that now hold them."""
    path = _place(root, name, version)
    _write(df, name, path)
    if name not in _LAYOUT:
        return {_WHOLE: version}
    back = df.sparkSession.read.schema(_stored(name)).parquet(path)
    return dict.fromkeys(_folders_of(back, name), version)


def _publish(spark: SparkSession, root: str, version: int, placed: Mapping[str, Mapping[str, int]]) -> None:
    rows = [(version, name, folder, at) for name, folders in placed.items() for folder, at in folders.items()]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}/manifest")


def _next_version(spark: SparkSession, root: str, version: int) -> dict[str, dict[str, int]]:
    """What the current version consists of, once ``version`` is known to be above it."""
    carried = _placement(spark, root)
    current = current_version(spark, root)
    if current is not None and version <= current:
        raise ValueError(f"version {version} is not above the current version {current}")
    return carried


def write_snapshot(tables: Mapping[str, DataFrame], root: str, version: int) -> None:
    """Write the given tables as a version, then publish it.

    Tables not given are carried over from the version before, so a job writes only
    what it changed. Readers follow the manifest, which is appended in one file
    after every table is complete: a job that dies half-way leaves the previous
    version current, and its retry writes over what it left. A version that is not
    above the current one raises ``ValueError``.
    """
    spark = next(iter(tables.values())).sparkSession
    placed = _next_version(spark, root, version)
    for name, df in tables.items():
        placed[name] = _written(df, root, name, version)
    _publish(spark, root, version, placed)


def write_changes(changes: Mapping[str, DataFrame], root: str, version: int) -> None:
    """Publish a version that differs from the current one by new and changed rows.

    ``changes`` has whole rows, unique by the table's key, in place of the rows of equal key.
    Of a table stored by month only the folders that such rows leave or enter are read and
    written, the others are carried over; a row keeps the month it starts in. Other tables
    are rewritten. Nothing is published if a write fails.
    """
    spark = next(iter(changes.values())).sparkSession
    placed = _next_version(spark, root, version)
    for name, rows in changes.items():
        rows = materialize(conformed(rows, name), f"changed-{name}")  # read to find folders, and to write
        now = _open(spark, root, name, placed.get(name, {}))
        if name not in _LAYOUT:
            kept = now.join(rows.select(*KEYS[name]), KEYS[name], "left_anti").select(*SCHEMAS[name].names)
            placed[name] = _written(kept.unionByName(rows), root, name, version)
            continue
        entered = _folders_of(_in_folders(rows, name), name)
        months = sorted({folder.split("/")[0].partition("=")[2] for folder in entered})
        old = now.filter(F.col("month").isin(months)).join(rows.select(*KEYS[name]), KEYS[name], "left_semi")
        hit = entered | _folders_of(old, name)
        touched = {folder: at for folder, at in placed.get(name, {}).items() if folder in hit}
        kept = _open(spark, root, name, touched).join(rows.select(*KEYS[name]), KEYS[name], "left_anti")
        made = _written(kept.select(*SCHEMAS[name].names).unionByName(rows), root, name, version)
        placed[name] = {f: at for f, at in placed.get(name, {}).items() if f not in hit} | made
    _publish(spark, root, version, placed)


def outdated_months(spark: SparkSession, root: str, source: str, derived: str) -> list[str]:
    """Months of ``source`` written since ``derived`` was worked out for them, and months it has lost.

    Both tables are stored by month. Read from the manifest alone.
    """
    placed = _placement(spark, root)

    def written(name: str) -> dict[str, int]:
        at: dict[str, int] = {}
        for folder, version in placed.get(name, {}).items():
            month = folder.split("/")[0].partition("=")[2]
            at[month] = max(at.get(month, 0), version)
        return at

    now, then = written(source), written(derived)
    return sorted(m for m in now.keys() | then.keys() if m not in now or then.get(m, -1) <= now[m])


def replace_months(df: DataFrame, root: str, version: int, name: str, months: list[str]) -> None:
    """Publish a version in which a table has, for the named months, the rows of ``df`` and no others."""
    spark = df.sparkSession
    placed = _next_version(spark, root, version)
    kept = {f: at for f, at in placed.get(name, {}).items() if f.split("/")[0].partition("=")[2] not in months}
    placed[name] = kept | _written(df, root, name, version)
    _publish(spark, root, version, placed)


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{root}/manifest")


def current_version(spark: SparkSession, root: str) -> int | None:
    """The newest published version; None before the first."""
    return _manifest(spark, root).agg(F.max("version")).first()[0]


def _placement(spark: SparkSession, root: str, version: int | None = None) -> dict[str, dict[str, int]]:
    """Per table its folders and the version that wrote each (one row per pair of months, or table)."""
    spark.createDataFrame([], _MANIFEST).write.mode("ignore").parquet(f"{root}/manifest")
    manifest = _manifest(spark, root)
    if version is None:
        version = current_version(spark, root)
    placed: dict[str, dict[str, int]] = {}
    for row in manifest.filter(F.col("version") == version).collect():
        placed.setdefault(row["table"], {})[row["folder"]] = row["written_in"]
    return placed


def _open(spark: SparkSession, root: str, name: str, folders: Mapping[str, int]) -> DataFrame:
    """The rows of some folders of a table, with the folder columns."""
    stored = _stored(name)
    if not folders:
        return spark.createDataFrame([], stored)
    paths = [_place(root, name, at, folder) for folder, at in sorted(folders.items())]
    if name not in _LAYOUT:
        return spark.read.schema(stored).parquet(*paths)
    return spark.read.schema(stored).option("basePath", f"{root}/{name}").parquet(*paths)


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> Tables:
    """Tables of a version, the current one by default."""
    placed = _placement(spark, root, version)

    def opened(name: str, **cut) -> DataFrame:
        df = _open(spark, root, name, placed[name])
        return (_cut_folders(df, name, **cut) if name in _LAYOUT else df).select(*SCHEMAS[name].names)

    def opener(name: str) -> Callable[[], DataFrame]:
        return lambda: opened(name)

    def slicer(name: str) -> Callable[..., DataFrame]:
        return lambda **cut: opened(name, **cut)

    return Tables({n: opener(n) for n in placed}, {n: slicer(n) for n in placed if n in _LAYOUT})
