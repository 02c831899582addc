"""Batch table jobs: one snapshot of the tables in, the next one out.

Every frame a job returns is computed from the tables it was given, so the parts
of one job never see each other's changes except where stated. Nothing is written
here; ``kiosklake.sources.tables.write_changes`` publishes the changed rows of a result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from kiosklake.functions import periods
from kiosklake.functions.numbers import MONEY_SUM, draw, sampled
from kiosklake.functions.pricing import FALLBACK_COST, daily_rate, rental_fee, replacement_cost
from kiosklake.operators.availability import IN_CIRCULATION
from kiosklake.operators.maintain import (
    DORMANT, SUSPENDED, WON_BACK, append, changed_rows, numbered_entries, row_counts, status_entries, update_from, with_next_ids,
)
from kiosklake.operators.membership import only
from kiosklake.operators.ranking import first_per, random_slice
from kiosklake.plans.reports import NEARBY_M
from kiosklake.plans.stock import random_near_store
from kiosklake.plans.views import disc_films
from kiosklake.session import materialize
from kiosklake.sources.tables import Tables

# Fixed value: status id of a disc that never came back.
LOST = 2


@dataclass
class JobResult:
    """Outcome of a job: the next tables, the rows it added or touched, and their counts.

    ``changes`` holds, per table, the new and changed rows alone, as ``write_changes`` takes
    them. Numbered rows are written when they are first asked for, so a caller who wants one
    table does not pay for the others.
    """

    tables: Tables
    rows: Tables = field(default_factory=lambda: Tables({}))
    changes: Tables = field(default_factory=lambda: Tables({}))

    def summary(self) -> DataFrame:
        """``(label, n)``: how many rows of each kind the job produced."""
        return row_counts(self.rows)


def _payments(t: Tables, charges: DataFrame, top: int | None = None) -> DataFrame:
    """Charges (customer_id, rental_id, amount, payment_date) as payment rows, numbered after ``top`` or the largest id."""
    rows = charges.select(
        "customer_id", "rental_id", F.col("amount").cast("decimal(12,2)").alias("amount"), "payment_date"
    )
    return with_next_ids(rows, "payment_id", t.payment, ["rental_id"], top).select(*t.payment.columns)


def _billed(t: Tables, paid: Callable[[], DataFrame]) -> Tables:
    return t.replaced(payment=lambda: append(t.payment, paid()))


# --- billing -----------------------------------------------------------------


def due_payments(t: Tables, rental: DataFrame, *, known: DataFrame | None = None, top: int | None = None) -> DataFrame:
    """Payment rows for the closed, unpaid rentals among ``rental``.

    ``known`` has the rental_id of what is paid, all payments by default.
    """
    known = t.payment if known is None else known
    closed = (
        rental.filter(~periods.is_open(F.col("period_end")))
        .select("rental_id", "customer_id", "inventory_id", "period_start", "period_end")
        .join(known.select("rental_id").distinct(), "rental_id", "left_anti")
        .join(disc_films(t).select("inventory_id"), "inventory_id", "left_semi")
    )
    charges = closed.select(
        "customer_id", "rental_id",
        rental_fee(F.col("period_start"), F.col("period_end"), daily_rate(t.pricing)).alias("amount"),
        F.col("period_end").alias("payment_date"),
    )
    return _payments(t, charges, top)


def insert_payments(t: Tables, around=None) -> JobResult:
    """Bill closed, unpaid rentals that began within a day of ``around`` (of any date if None)."""
    rental = t.rental
    if around is not None:
        lo, hi = periods.shift(around, days=-1), periods.shift(around, days=1)
        rental = t.within("rental", lo, hi).filter(
            (F.col("period_start") >= lo) & (F.col("period_start") <= hi)
        )
    added = cache(lambda: due_payments(t, rental))
    return JobResult(_billed(t, added), Tables({"payments": added}), Tables({"payment": added}))


def single_payment(t: Tables, rental_id: int) -> JobResult:
    """Bill one rental."""
    added = cache(lambda: due_payments(t, t.rental.filter(F.col("rental_id") == rental_id)))
    return JobResult(_billed(t, added), Tables({"payments": added}), Tables({"payment": added}))


# --- returns -----------------------------------------------------------------


def plan_returns(
    t: Tables,
    as_of,
    *,
    min_age_hours: int = 16,
    completion_pct: float = 15.0,
    skip_pct: float = 0.1,
    radius_m: float = NEARBY_M,
    min_duration_hours: int = 16,
    max_duration_hours: int = 96,
    seed: str = "returns",
) -> DataFrame:
    """Seeded choice of rentals to close, each with a return time and a nearby return store."""
    eligible = t.still_open("rental").filter(
        F.col("period_start") < periods.shift(as_of, hours=-min_age_hours)
    ).select("rental_id", "customer_id", "period_start")
    chosen = random_slice(eligible, seed, ["rental_id"], skip_pct, completion_pct)
    chosen = materialize(chosen, "chosen-returns")
    span = (max_duration_hours - min_duration_hours) * 3_600_000_000
    micros = F.floor(draw(f"{seed}-time", F.col("rental_id")) * F.lit(float(span)))
    kept_for = F.make_dt_interval(
        hours=F.lit(min_duration_hours),
        secs=(micros.cast("decimal(18,0)") / F.lit(1000000)).cast("decimal(18,6)"),
    )
    stores = random_near_store(
        t, chosen.select("rental_id", "customer_id"), "rental_id", f"{seed}-store", radius_m
    ).select("rental_id", F.col("store_id").alias("return_store_id"))
    return chosen.join(stores, "rental_id", "left").select(
        "rental_id",
        F.greatest(periods.moment(as_of), F.col("period_start") + kept_for).alias("return_time"),
        "return_store_id",
    )


def complete_rentals(
    t: Tables, returns: DataFrame, as_of, default_store: bool = True, stamp_rentals: bool = False
) -> JobResult:
    """Close returned rentals, bill them and move their discs.

    The batch changes a rental's period alone; ``stamp_rentals`` also dates the change.

    ``returns`` has one row per rental: rental_id, return_time, return_store_id.
    Without a return store the disc goes to the renting store, or stays where it
    is when ``default_store`` is False.
    """
    back = F.col("return_store_id")
    if default_store:
        back = F.coalesce(back, F.col("store_id"))
    done = (
        t.still_open("rental")
        .join(returns, "rental_id")
        .select(
            "rental_id", "customer_id", "inventory_id", "period_start",
            *(c.alias(n) for c, n in zip(
                periods.make_period(F.col("period_start"), F.col("return_time")), ("_start", "return_time")
            )),
            back.alias("new_store"),
        )
        .drop("_start")
    )
    done = materialize(done, "completed")  # feeds three tables
    stamp = as_of if stamp_rentals else None
    closing = (done, ["rental_id"], {"period_end": "return_time"})
    rental = update_from(t.rental, *closing, stamp=stamp)
    moves = first_per(
        done.filter(F.col("new_store").isNotNull()).select("inventory_id", "new_store", "rental_id"),
        ["inventory_id"], [F.col("rental_id")],
    )
    moved_if = ~F.col("store_id").eqNullSafe(F.col("_new_new_store"))
    moving = (t.inventory, moves, ["inventory_id"], {"store_id": "new_store"})
    inventory = update_from(*moving, only_if=moved_if, stamp=as_of)
    charges = done.join(disc_films(t).select("inventory_id"), "inventory_id", "left_semi").select(
        "customer_id", "rental_id",
        rental_fee(F.col("period_start"), F.col("return_time"), daily_rate(t.pricing)).alias("amount"),
        F.col("return_time").alias("payment_date"),
    )
    paid = cache(lambda: _payments(t, charges))
    return JobResult(
        _billed(t, paid).replaced(rental=rental, inventory=inventory), Tables({"completed": done, "payments": paid}),
        Tables({
            "rental": lambda: changed_rows(t.still_open("rental"), *closing, stamp=stamp),
            "inventory": lambda: changed_rows(*moving, only_if=moved_if, stamp=as_of), "payment": paid,
        }),
    )


def return_rentals(
    t: Tables, as_of, rental_id=None, *, min_age_hours: int = 8, radius_m: float = NEARBY_M, seed: str = "return"
) -> JobResult:
    """Close one rental (or every open one of the given age) now, at a random store near its customer.

    A disc whose customer has no store nearby stays where it is.
    """
    back = only(
        t.still_open("rental").filter(F.col("period_start") < periods.shift(as_of, hours=-min_age_hours)),
        "rental_id", rental_id,
    ).select("rental_id", "customer_id")
    stores = random_near_store(t, back, "rental_id", seed, radius_m).select(
        "rental_id", F.col("store_id").alias("return_store_id")
    )
    returns = back.join(stores, "rental_id", "left").select(
        "rental_id", periods.moment(as_of).alias("return_time"), "return_store_id"
    )
    return complete_rentals(t, returns, as_of, default_store=False, stamp_rentals=True)


# --- losses ------------------------------------------------------------------


def _open_longer_than(t: Tables, as_of, days: int) -> DataFrame:
    return t.still_open("rental").filter(
        F.col("period_start") < periods.shift(as_of, days=-days)
    ).select("rental_id", "customer_id", "inventory_id")


def _write_off(t: Tables, lost: DataFrame, as_of, stamp_rentals: bool) -> tuple[Tables, Tables]:
    """Close lost rentals, mark their discs lost and charge each one's ``amount``.

    Returns the next tables, and the changed rows of each.
    """
    now = periods.moment(as_of)
    closed = lost.select("rental_id", now.alias("loss_date"))
    stamp = as_of if stamp_rentals else None
    closing = (closed, ["rental_id"], {"period_end": "loss_date"})
    rental = update_from(t.rental, *closing, stamp=stamp)
    discs = lost.select("inventory_id").distinct().withColumn("status", F.lit(LOST))
    marking = (t.inventory, discs, ["inventory_id"], {"status_id": "status"})
    inventory = update_from(*marking, stamp=as_of)
    charges = lost.select("customer_id", "rental_id", "amount", now.alias("payment_date"))
    paid = cache(lambda: _payments(t, charges))
    changes = Tables({
        "rental": lambda: changed_rows(t.still_open("rental"), *closing, stamp=stamp),
        "inventory": lambda: changed_rows(*marking, stamp=as_of), "payment": paid,
    })
    return _billed(t, paid).replaced(rental=rental, inventory=inventory), changes


def _set_active(t: Tables, ids: DataFrame, active: bool, as_of) -> tuple[DataFrame, Tables]:
    """The customers after some were switched, and those alone."""
    flagged = ids.select("customer_id").withColumn("flag", F.lit(active))
    switching = (t.customer, flagged, ["customer_id"], {"activebool": "flag"})
    return update_from(*switching, stamp=as_of), Tables({"customer": lambda: changed_rows(*switching, stamp=as_of)})


def _logged(t: Tables, entries: DataFrame) -> tuple[Callable[[], DataFrame], Tables]:
    """The log with entries added, and the new rows of it; both open when asked for."""
    new = cache(lambda: numbered_entries(t.customer_status_log, entries))
    return (lambda: append(t.customer_status_log, new())), Tables({"customer_status_log": new})


def _switched(t: Tables, ids: DataFrame, entries: DataFrame, active: bool, as_of) -> tuple[Tables, Tables]:
    """Switch customers and log it: the next tables, and the changed rows of each."""
    customer, people = _set_active(t, ids, active, as_of)
    log, added = _logged(t, entries)
    return t.replaced(customer=customer, customer_status_log=log), people.joined(added)


def process_lost_rentals(
    t: Tables, as_of, lost_after_days: int = 30, suspend: bool = True
) -> JobResult:
    """Write off rentals open too long; optionally suspend and log their customers.

    A customer with several losses is suspended and logged once, under the lowest
    rental id.
    """
    lost = (
        _open_longer_than(t, as_of, lost_after_days)
        .join(disc_films(t), "inventory_id")
        .join(t.film.select("film_id", "release_date"), "film_id")
    )
    cost = replacement_cost(t.pricing, F.col("release_date"), as_of)
    lost = materialize(lost.withColumn("amount", cost), "lost")  # feeds five tables
    tables, changes = _write_off(t, lost, as_of, stamp_rentals=False)
    rows = {"lost": lost, "payments": lambda: changes.payment}
    if suspend:
        hit = lost.groupBy("customer_id").agg(F.min("rental_id").alias("rental_id"))
        hit = hit.join(t.customer.select("customer_id"), "customer_id", "left_semi")
        entries = status_entries(hit, SUSPENDED, status_date=as_of, rental_id=F.col("rental_id"))
        tables, suspended = _switched(tables, hit, entries, False, as_of)
        changes = changes.joined(suspended)
        rows["suspended"] = entries
    return JobResult(tables, Tables(rows), changes)


def process_lost_inventory(
    t: Tables, as_of, lost_threshold_days: int = 30, deactivate_customer: bool = True
) -> JobResult:
    """Write off circulating discs out too long, with a fallback cost and no log entry."""
    discs = t.inventory.filter(F.col("status_id") == IN_CIRCULATION).select("inventory_id", "film_id")
    lost = (
        _open_longer_than(t, as_of, lost_threshold_days)
        .join(discs, "inventory_id")
        .join(t.film.select("film_id", "release_date"), "film_id")
    )
    cost = replacement_cost(t.pricing, F.col("release_date"), as_of)
    fallback = F.lit(FALLBACK_COST).cast("decimal(12,2)")
    lost = materialize(lost.withColumn("amount", F.coalesce(cost, fallback)), "lost")
    tables, changes = _write_off(t, lost, as_of, stamp_rentals=True)
    rows = Tables({"lost": lost, "payments": lambda: changes.payment})
    if deactivate_customer:
        customer, stopped = _set_active(t, lost.select("customer_id").distinct(), False, as_of)
        return JobResult(tables.replaced(customer=customer), rows, changes.joined(stopped))
    return JobResult(tables, rows, changes)


def charges_total(result: JobResult) -> DataFrame:
    """One row: number and sum of the payments a job created."""
    return result.rows["payments"].agg(
        F.count(F.lit(1)).alias("payments"),
        F.coalesce(F.sum("amount"), F.lit(0)).cast(MONEY_SUM).alias("charged"),
    )


# --- customer activity -------------------------------------------------------


def deactivate_dormant(t: Tables, as_of, dormant_days: int = 180) -> JobResult:
    """Deactivate active customers whose last rental is old and who have none open.

    A customer who never rented stays active: an outer join gives them one row
    without an end, which the rule reads as an open rental.
    """
    last = t.rental.groupBy("customer_id").agg(
        F.max("period_start").alias("last_rental"),
        F.count_if(periods.is_open(F.col("period_end"))).alias("open_rentals"),
    )
    dormant = (
        t.customer.filter(F.col("activebool"))
        .select("customer_id")
        .join(last, "customer_id")
        .filter(
            (F.col("last_rental") < periods.shift(as_of, days=-dormant_days))
            & (F.col("open_rentals") == 0)
        )
        .select("customer_id")
    )
    dormant = materialize(dormant, "dormant")
    entries = status_entries(dormant, DORMANT, status_date=as_of, days=dormant_days)
    tables, changes = _switched(t, dormant, entries, False, as_of)
    return JobResult(tables, Tables({"deactivated": entries}), changes)


def win_back(t: Tables, as_of, reactivate_pct: float = 0.5, seed: str = "winback") -> JobResult:
    """Reactivate a seeded sample of the inactive customers."""
    back = t.customer.filter(
        F.col("activebool").eqNullSafe(False) & sampled(reactivate_pct, seed, F.col("customer_id"))
    ).select("customer_id")
    back = materialize(back, "won-back")
    entries = status_entries(back, WON_BACK, status_date=as_of)
    tables, changes = _switched(t, back, entries, True, as_of)
    return JobResult(tables, Tables({"reactivated": entries}), changes)


def update_customer_activity(
    t: Tables, as_of, dormant_days: int = 180, reactivate_pct: float = 0.5, seed: str = "winback"
) -> JobResult:
    """Deactivation, then win-back over its result."""
    first = deactivate_dormant(t, as_of, dormant_days)
    # the second step reads both changed tables several times
    between = first.tables.replaced(
        customer=cache(lambda: materialize(first.tables.customer, "activity-customer")),
        customer_status_log=cache(lambda: materialize(first.tables.customer_status_log, "activity-log")),
    )
    second = win_back(between, as_of, reactivate_pct, seed)
    return JobResult(second.tables, first.rows.joined(second.rows))


def nightly_maintenance(
    t: Tables,
    as_of,
    lost_threshold_days: int = 30,
    deactivate_lost_customers: bool = True,
    dormant_days: int = 180,
    reactivate_pct: float = 0.5,
    seed: str = "winback",
) -> JobResult:
    """Lost inventory, then customer activity over its result."""
    lost = process_lost_inventory(t, as_of, lost_threshold_days, deactivate_lost_customers)
    # the closed rentals are read for the dormant customers and handed on
    after = lost.tables.replaced(rental=cache(lambda: materialize(lost.tables.rental, "nightly-rental")))
    activity = update_customer_activity(after, as_of, dormant_days, reactivate_pct, seed)
    return JobResult(activity.tables, lost.rows.joined(activity.rows))
