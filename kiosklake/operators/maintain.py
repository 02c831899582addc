"""Table changes as snapshot in, new snapshot out.

Nothing here writes in place: every operator returns the changed table (and, where
useful, the affected rows) built from one immutable input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kiosklake.functions import periods
from kiosklake.operators.ranking import first_per, shuffled_rank


# Status-log entries as (status, reason, notes).
SIGNUP = ("active", "signup", "Backfilled from existing customer data")
SUSPENDED = ("suspended", "lost_item", "Item not returned, charged replacement cost")
DORMANT = ("inactive", "inactivity", "No rental in %s days")
WON_BACK = ("active", "winback", "Random reactivation (simulated marketing)")


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    """All rows of both; columns the new rows lack become NULL."""
    return target.unionByName(rows, allowMissingColumns=True).select(*target.columns)


def with_next_ids(
    rows: DataFrame, id_column: str, target: DataFrame, keys: list[str], top: int | None = None
) -> DataFrame:
    """Number new rows after the target's largest id, or after ``top`` where the caller knows it.

    The numbering is dense, depends only on the row's own ``keys`` (unique per
    row), and is split over tasks.
    """
    if top is None:
        after = target.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("top")).scalar()
    else:
        after = F.lit(top)
    ranked = shuffled_rank(rows, id_column, keys, name="_new")
    return ranked.withColumn(id_column, (F.col("_new") + after).cast("bigint")).drop("_new")


def insert_new(
    target: DataFrame, rows: DataFrame, keys: list[str], order: list[Column]
) -> DataFrame:
    """The rows an insert-if-absent would add: first per key by ``order``, key not in target."""
    return first_per(rows, keys, order).join(target.select(*keys), keys, "left_anti")


def insert_if_absent(
    target: DataFrame, rows: DataFrame, keys: list[str], order: list[Column]
) -> DataFrame:
    return append(target, insert_new(target, rows, keys, order))


def upsert(target: DataFrame, rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Insert new keys; on existing keys replace ``columns``. ``rows`` has unique keys."""
    old = target.withColumn("_old", F.lit(True)).alias("o")
    new = rows.withColumn("_new", F.lit(True)).alias("n")
    both = old.join(new, keys, "full")
    picked = []
    for c in target.columns:
        if c in keys:
            picked.append(F.col(c))
        elif c in columns:
            picked.append(F.when(F.col("_new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        elif c in rows.columns:
            picked.append(F.when(F.col("_old"), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
        else:
            picked.append(F.col(f"o.{c}").alias(c))
    return both.select(*picked)


def update_from(
    target: DataFrame,
    changes: DataFrame,
    keys: list[str],
    columns: dict[str, str],
    *,
    only_if: Column | None = None,
    stamp: object = None,
) -> DataFrame:
    """``UPDATE target SET a = changes.x FROM changes``.

    ``columns`` maps target columns to change columns; ``changes`` has unique keys.
    ``only_if`` is an extra test on target columns and on change columns named
    ``_new_<column>``. ``stamp`` sets ``last_update`` on changed rows.
    """
    source = changes.select(
        *keys, *[F.col(src).alias(f"_new_{src}") for src in dict.fromkeys(columns.values())],
        F.lit(True).alias("_hit"),
    )
    joined = target.join(source, keys, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    if only_if is not None:
        hit = hit & F.coalesce(only_if, F.lit(False))
    picked = []
    for c in target.columns:
        value = F.col(c)
        if c in columns:
            value = F.when(hit, F.col(f"_new_{columns[c]}").cast(target.schema[c].dataType)).otherwise(value)
        elif c == "last_update" and stamp is not None:
            value = F.when(hit, periods.moment(stamp)).otherwise(value)
        picked.append(value.alias(c))
    return joined.select(*picked)


def changed_rows(target: DataFrame, changes: DataFrame, keys: list[str], columns: dict[str, str], **given) -> DataFrame:
    """What ``update_from`` makes of the rows that ``changes`` names, without the other rows."""
    named = target.join(changes.select(*keys), keys, "left_semi")
    return update_from(named, changes, keys, columns, **given)


def delete_keys(target: DataFrame, keys_frame: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not listed. A key listed very often is one row before the shuffle."""
    return target.join(keys_frame.select(*keys).distinct(), keys, "left_anti")


def emptied(table: DataFrame) -> DataFrame:
    """The table's schema with no rows (truncate)."""
    return table.limit(0)


def newer_than(source: DataFrame, column: str, target: DataFrame) -> DataFrame:
    """Source rows at or after the target's newest ``column``; none when the target is empty."""
    mark = target.agg(F.max(column).alias("mark")).scalar()
    return source.filter(F.col(column) >= mark)


def missing_keys(wanted: list[DataFrame], key: str, have: DataFrame) -> DataFrame:
    """Distinct keys that occur in any wanted frame and not in ``have``."""
    union = wanted[0].select(key)
    for frame in wanted[1:]:
        union = union.unionByName(frame.select(key))
    return union.distinct().join(have.select(key).distinct(), key, "left_anti")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(label, n)`` with one counted row per table."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("label"), "n")
        for label, df in tables.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def count_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Before/after/change of two row-count frames; a label missing on one side counts 0 there."""
    b = before.select("label", F.col("n").alias("before_n"))
    a = after.select("label", F.col("n").alias("after_n"))
    before_n, after_n = F.coalesce("before_n", F.lit(0)), F.coalesce("after_n", F.lit(0))
    return b.join(a, "label", "full").select(
        "label", before_n.alias("before_n"), after_n.alias("after_n"), (after_n - before_n).alias("delta")
    )


def protect_column(
    updated: DataFrame, current: DataFrame, key: str, column: str
) -> tuple[DataFrame, DataFrame]:
    """Keep an immutable column on update.

    Returns the update with the stored value put back, and one row per attempt to
    change it (key, kept value, refused value). Rows new to the table keep theirs.
    """
    old = current.select(key, F.col(column).alias("_kept"), F.lit(True).alias("_known"))
    joined = updated.join(old, key, "left")
    known = F.coalesce(F.col("_known"), F.lit(False))
    kept = F.when(known, F.col("_kept")).otherwise(F.col(column))
    guarded = joined.withColumn(column, kept).select(*updated.columns)
    refused = joined.filter(known & ~F.col(column).eqNullSafe(F.col("_kept"))).select(
        key, F.col("_kept").alias("kept"), F.col(column).alias("refused")
    )
    return guarded, refused


def status_entries(
    customers: DataFrame, kind: tuple[str, str, str], *, status_date, days=None, rental_id: Column | None = None
) -> DataFrame:
    """Status-log rows (without ids) of one kind for a frame of customers.

    ``days`` fills the place in the notes of kinds that name a number of days.
    """
    status, reason, notes = kind
    text = F.lit(notes) if days is None else F.format_string(notes, F.lit(str(days)))
    return customers.select(
        F.col("customer_id"),
        periods.moment(status_date).alias("status_date"),
        F.lit(status).alias("status"),
        F.lit(reason).alias("reason_code"),
        text.alias("notes"),
        (rental_id if rental_id is not None else F.lit(None)).cast("bigint").alias("rental_id"),
    )


def numbered_entries(log: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries as rows of the log with fresh ids."""
    keys = ["customer_id", "status", "status_date"]
    return with_next_ids(entries, "log_id", log, keys).select(*log.columns)


def log_status(log: DataFrame, entries: DataFrame) -> DataFrame:
    """Append entries to the log with fresh ids."""
    return append(log, numbered_entries(log, entries))


def signup_backfill(customer: DataFrame) -> DataFrame:
    """One sign-up entry per existing customer, dated at creation."""
    return status_entries(customer, SIGNUP, status_date=F.col("create_date").cast("timestamp_ntz"))
