import pytest
from pyspark.sql import functions as F

from kiosklake.plans import customers, earlier, jobs, reports, stock, stores, views
from kiosklake.sources.tables import Tables, current_version, read_snapshot, write_changes, write_snapshot
from tests.conftest import AS_OF, dt, money


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_billing_fees_and_repeat(tables):
    done = jobs.insert_payments(tables)
    assert rows(done.rows["payments"], "rental_id", "amount") == [(1, money("1.99")), (3, money("3.98"))]
    assert sorted(r.payment_id for r in done.rows["payments"].collect()) == [4, 5]
    assert jobs.insert_payments(done.tables).rows["payments"].count() == 0
    assert rows(jobs.charges_total(done), "payments", "charged") == [(2, money("5.97"))]


def test_billing_window_is_a_day_either_way(tables):
    near = jobs.insert_payments(tables, "2025-06-02").rows["payments"]
    assert rows(near, "rental_id") == [(1,), (3,)]
    assert rows(jobs.insert_payments(tables, "2025-06-03 10:00:00").rows["payments"], "rental_id") == [(3,)]
    assert rows(jobs.single_payment(tables, 3).rows["payments"], "rental_id") == [(3,)]


def test_returns_close_pay_and_move(spark, tables):
    returns = spark.createDataFrame(
        [(5, dt("2025-06-15 00:00:01"), 2), (6, dt("2025-06-15 00:00:00"), None), (1, dt("2025-06-15 00:00:00"), 2)],
        "rental_id long, return_time timestamp_ntz, return_store_id long",
    )
    done = jobs.complete_rentals(tables, returns, AS_OF)
    closed = {r.rental_id: r.period_end for r in done.tables.rental.collect()}
    assert closed[5] == dt("2025-06-15 00:00:01") and closed[1] == dt("2025-06-01 10:00:01")  # 1 was closed before
    assert rows(done.rows["payments"], "rental_id", "amount") == [(5, money("3.98")), (6, money("149.25"))]
    discs = {r.inventory_id: (r.store_id, r.last_update) for r in done.tables.inventory.collect()}
    assert discs[18] == (2, dt(AS_OF)) and discs[13][1] != dt(AS_OF)
    still = jobs.complete_rentals(tables, returns, AS_OF, default_store=False)
    assert {r.inventory_id: r.store_id for r in still.tables.inventory.collect()}[13] == 2


def test_planned_returns_are_near_and_late_enough(tables):
    plan = jobs.plan_returns(tables, AS_OF, completion_pct=100.0, skip_pct=0.0).collect()
    assert {r.rental_id for r in plan} == {5, 6, 7, 8}
    assert all(r.return_time >= dt(AS_OF) for r in plan)
    assert all(r.return_store_id in (1, 2) for r in plan)


def test_lost_rentals_suspend_once_per_customer(tables):
    done = jobs.process_lost_rentals(tables, AS_OF)
    assert rows(done.rows["payments"], "rental_id", "amount") == [
        (6, money("9.99")), (7, money("9.99")), (8, money("9.99"))]
    log = rows(done.tables.customer_status_log, "customer_id", "status", "reason_code", "rental_id")
    assert log == [(4, "suspended", "lost_item", 8), (6, "suspended", "lost_item", 6)]
    assert rows(done.tables.customer.filter("not activebool"), "customer_id") == [(4,), (6,)]
    assert {r.inventory_id for r in done.tables.inventory.filter("status_id = 2").collect()} == {13, 14, 17}
    kept = jobs.process_lost_rentals(tables, AS_OF, suspend=False)
    assert kept.tables.customer.filter("not activebool").count() == 1
    assert dict(rows(kept.summary(), "label", "n")) == {"lost": 3, "payments": 3}


def test_lost_inventory_skips_discs_out_of_circulation(tables):
    done = jobs.process_lost_inventory(tables, AS_OF)
    assert rows(done.rows["payments"], "rental_id") == [(6,), (7,)]
    assert done.tables.customer_status_log.count() == 0
    assert jobs.process_lost_inventory(done.tables, AS_OF).rows["payments"].count() == 0


def test_dormant_rule_leaves_never_rented_customers(tables):
    done = jobs.deactivate_dormant(tables, AS_OF)
    assert rows(done.rows["deactivated"], "customer_id", "notes") == [(2, "No rental in 180 days")]
    assert rows(done.tables.customer.filter("not activebool"), "customer_id") == [(2,), (4,)]


def test_win_back_sees_the_deactivated(tables):
    everyone = jobs.update_customer_activity(tables, AS_OF, reactivate_pct=100.0)
    assert everyone.tables.customer.filter("not activebool").count() == 0
    assert rows(everyone.tables.customer_status_log, "customer_id", "reason_code") == [
        (2, "inactivity"), (2, "winback"), (4, "winback")]
    assert jobs.win_back(tables, AS_OF, 0.0).rows["reactivated"].count() == 0


def test_nightly_chain(tables):
    done = jobs.nightly_maintenance(tables, AS_OF, reactivate_pct=0.0)
    assert dict(rows(done.summary(), "label", "n")) == {"lost": 2, "payments": 2, "deactivated": 1, "reactivated": 0}
    assert rows(done.tables.customer.filter("not activebool"), "customer_id") == [(2,), (4,), (6,)]


def test_rebalance_conserves_discs(tables):
    after, moves = stock.rebalance_inventory(tables, AS_OF)
    assert after.inventory.count() == tables.inventory.count()
    moved = {r.inventory_id: r for r in moves.collect()}
    places = {r.inventory_id: r.store_id for r in after.inventory.collect()}
    before = {r.inventory_id: r.store_id for r in tables.inventory.collect()}
    assert moved
    for disc, store in places.items():
        assert store == (moved[disc].to_store if disc in moved else before[disc])
    assert stock.rebalance_moves(tables, max_moves=1).count() == 1


def test_allocation_only_for_films_without_discs(tables):
    after, added = stock.populate_inventory(tables, AS_OF)
    assert {r.film_id for r in added.collect()} <= {3}
    every, discs = stock.populate_inventory(tables, AS_OF, clear_existing=True)
    assert every.rental.count() == 0 and every.payment.count() == 0
    per_store = rows(discs.filter("film_id = 1").groupBy("store_id").count(), "store_id", "count")
    assert [s for s, _ in per_store] == [1, 2, 3] and all(10 <= n <= 14 for _, n in per_store)
    total = discs.count()
    assert sorted(r.inventory_id for r in discs.collect()) == list(range(1, total + 1))


def test_pairing_uses_each_disc_and_customer_once(tables):
    got = stock.pair_rentals(tables, "2025-06-20", 10).collect()
    assert got
    assert len({r.customer_id for r in got}) == len(got) == len({r.inventory_id for r in got})
    assert not {r.customer_id for r in got} & {1, 4, 5, 6}  # open rental, inactive, nowhere
    sizes = {r.store_id: (r.local_count, r.target) for r in stock.day_targets(tables, 10).collect()}
    assert sizes == {1: (4, 5), 2: (4, 5)}
    assert sorted(rows(stock.store_pool(tables), "store_id", "customer_id"))[:2] == [(1, 1), (1, 2)]


def test_batches_leave_the_rental_stamp(tables):
    """A batch changes a rental's period alone; the single return and the lost discs' job date it."""
    def stamps(after):
        return {r.rental_id: r.last_update for r in after.rental.collect()}

    before = stamps(tables)
    returned = jobs.complete_rentals(tables, jobs.plan_returns(tables, AS_OF, completion_pct=100.0, skip_pct=0.0), AS_OF)
    assert returned.rows["completed"].count() > 0 and stamps(returned.tables) == before
    assert stamps(jobs.process_lost_rentals(tables, AS_OF).tables) == before
    order = [r.rental_id for r in stores.recent_activity(tables, "2024-01-01", k=9).collect()]
    assert [r.rental_id for r in stores.recent_activity(returned.tables, "2024-01-01", k=9).collect()] == order
    assert stamps(jobs.return_rentals(tables, AS_OF).tables) != before
    assert stamps(jobs.process_lost_inventory(tables, AS_OF).tables) != before


def test_nightly_rentals_are_closed_once(tables):
    """The closed rentals are written for the dormant customers, and handed on as written."""
    done = jobs.nightly_maintenance(tables, AS_OF, reactivate_pct=0.0).tables
    assert "Join" not in done.rental._jdf.queryExecution().optimizedPlan().toString()
    closed = jobs.process_lost_inventory(tables, AS_OF).tables.rental
    assert sorted(map(str, done.rental.collect())) == sorted(map(str, closed.collect()))


def test_store_history_deals_rentals_three_times(spark, tables):
    """By rental, disc and customer, and no more where no side is small enough to be sent around."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    kept = [spark.conf.get(n, None) for n in names]
    try:
        for n in names:
            spark.conf.set(n, "-1")
        plan = customers.account_store_history(tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        for n, value in zip(names, kept):
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)
    # three of rentals; payments, discs twice, films and customers once each
    assert plan.count("Exchange hashpartitioning") <= 8


def test_nightly_log_plan_reads_each_table_few_times(tables):
    log = jobs.nightly_maintenance(tables, AS_OF).tables.customer_status_log
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") < 15


def test_snapshot_retry_and_old_versions(spark, tables, tmp_path):
    root = str(tmp_path / "snap")
    write_snapshot({"payment": tables.payment}, root, 1)
    # what a job that died half-way left behind
    tables.payment.limit(1).write.parquet(f"{root}/payment/written=2/month=2025-06")
    write_snapshot({"payment": tables.payment}, root, 2)
    assert read_snapshot(spark, root).payment.count() == tables.payment.count()
    for version in (1, 2):
        with pytest.raises(ValueError):
            write_snapshot({"payment": tables.payment}, root, version)


def test_snapshots_carry_unchanged_tables(spark, tables, tmp_path):
    root = str(tmp_path / "snap")
    kept = {n: tables[n] for n in ("rental", "payment", "inventory", "film", "pricing", "customer")}
    write_snapshot(kept, root, 1)
    first = read_snapshot(spark, root)
    assert first.rental.count() == 8 and first.rental.filter("period_end is null").count() == 4
    result = jobs.insert_payments(first)
    write_snapshot({"payment": result.tables.payment}, root, 2)
    assert current_version(spark, root) == 2
    now = read_snapshot(spark, root)
    assert now.payment.count() == 5 and now.rental.count() == 8
    assert read_snapshot(spark, root, 1).payment.count() == 3
    # a time window opens only its months, in whatever report asks for it
    since = customers.recent_rentals(now, AS_OF, 30)._jdf.queryExecution().executedPlan().toString()
    assert ">= 2025-05)" in since and "PartitionFilters: [isnotnull(month" in since
    whole = tables.replaced(rental=tables.rental)
    assert rows(customers.recent_rentals(now, AS_OF, 30), "rental_id") == rows(
        customers.recent_rentals(whole, AS_OF, 30), "rental_id")
    assert now.within("rental", "2025-06-01").count() == 4 and now.within("rental", hi="2024-07-01").count() == 1
    plan = now.rental.filter(F.col("period_start") < F.lit("2025-01-01").cast("timestamp_ntz"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(period_start" in text


KEPT = ("rental", "payment", "inventory", "film", "pricing", "customer", "customer_status_log")


def _files(df):
    """Folders below the snapshot that the scans of a plan read, once partitions are pruned."""
    leaves, found = df._jdf.queryExecution().sparkPlan().collectLeaves(), set()
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        if leaf.getClass().getSimpleName() != "FileSourceScanExec":
            continue
        listed = leaf.relation().location().listFiles(leaf.partitionFilters(), leaf.dataFilters())
        files = [listed.apply(i).files() for i in range(listed.size())]
        found |= {fs.apply(k).getPath().toString() for fs in files for k in range(fs.size())}
    return {f.split("/snap/")[1].rsplit("/", 1)[0] for f in found if "/snap/" in f}


def test_open_questions_open_the_open_folders(spark, tables, tmp_path):
    root = str(tmp_path / "snap")
    write_snapshot({n: tables[n] for n in KEPT}, root, 1)
    t = read_snapshot(spark, root).joined(Tables({n: tables[n] for n in ("store", "film_genre", "inventory_status")}))
    assert {f.split("/until=")[1] for f in _files(t.still_open("rental"))} == {"open"}
    for frame in (
        views.overdue_rentals(t, AS_OF), reports.film_availability(t), reports.overdue_in_circulation(t, AS_OF),
        stores.stock_of_stores(t), jobs._open_longer_than(t, AS_OF, 30),
    ):
        read = {f for f in _files(frame) if f.startswith("rental/")}
        assert read and all(f.endswith("until=open") for f in read)
    whole = tables
    assert rows(views.overdue_rentals(t, AS_OF), "rental_id") == rows(views.overdue_rentals(whole, AS_OF), "rental_id")
    # overlap: months that begin later or end earlier stay shut
    busy = _files(t.touching("rental", "2025-05-01", "2025-05-31"))
    assert busy == {f"rental/written=1/month=2025-0{m}/until=open" for m in (3, 4)}
    for lo, hi in (("2025-05-01", "2025-06-01"), ("2024-06-01", "2024-06-01 12:00:00"), ("2025-06-02", "2025-06-04"), ("2025-06-03 10:00:00", "2025-06-05")):
        assert rows(t.touching("rental", lo, hi), "rental_id") == rows(whole.touching("rental", lo, hi), "rental_id")
    for at in ("2025-06-02 10:00:00", "2025-06-03 10:00:00", "2024-06-01 05:00:00", "2020-01-01"):
        assert rows(t.holding("rental", at), "rental_id") == rows(whole.holding("rental", at), "rental_id")
        assert rows(earlier.disc_holders(t, at), "inventory_id", "customer_id") == rows(earlier.disc_holders(whole, at), "inventory_id", "customer_id")


@pytest.mark.parametrize("job", [
    lambda t: jobs.process_lost_rentals(t, AS_OF), lambda t: jobs.insert_payments(t), lambda t: jobs.process_lost_inventory(t, AS_OF),
    lambda t: jobs.deactivate_dormant(t, AS_OF), lambda t: jobs.win_back(t, AS_OF, 100.0),
    lambda t: jobs.complete_rentals(t, t.rental.filter("rental_id = 5").selectExpr(
        "rental_id", "timestamp_ntz'2025-06-15 12:00:00' AS return_time", "2 AS return_store_id"), AS_OF),
])
def test_changes_alone_make_the_next_version(spark, tables, tmp_path, job):
    root = str(tmp_path / "snap")
    write_snapshot({n: tables[n] for n in KEPT}, root, 1)
    t = read_snapshot(spark, root)
    result = job(t)
    write_changes(result.changes, root, 2)
    now = read_snapshot(spark, root)
    assert set(now) == set(t)
    for name in KEPT:
        columns = now[name].columns
        assert rows(now[name], *columns) == rows(result.tables[name].select(*columns), *columns), name
        assert rows(read_snapshot(spark, root, 1)[name], *columns) == rows(tables[name], *columns)


def test_closing_writes_only_its_folders(spark, tables, tmp_path):
    root = str(tmp_path / "snap")
    write_snapshot({n: tables[n] for n in KEPT}, root, 1)
    t = read_snapshot(spark, root)
    returns = t.rental.filter("rental_id = 6").selectExpr(
        "rental_id", "timestamp_ntz'2025-06-15 12:00:00' AS return_time", "cast(null AS int) AS return_store_id")
    write_changes(jobs.complete_rentals(t, returns, AS_OF).changes, root, 2)
    now = read_snapshot(spark, root)
    moved = {f for f in _files(now.rental) if "written=2" in f}
    # the other open rental of its month moves with the folder, nothing else is written
    assert moved == {"rental/written=2/month=2025-04/until=2025-06", "rental/written=2/month=2025-04/until=open"}
    assert len(_files(now.rental)) == len(_files(t.rental)) + 1
    assert {f for f in _files(now.payment) if "written=2" in f} == {"payment/written=2/month=2025-06"}


def test_revenue_parts_follow_changed_months(spark, tables, tmp_path):
    root = str(tmp_path / "snap")
    write_snapshot({n: tables[n] for n in (*KEPT, "store")}, root, 1)
    assert views.refresh_revenue_parts(spark, root) == ["2024-06", "2025-06"]
    assert views.refresh_revenue_parts(spark, root) == []
    t = read_snapshot(spark, root)
    write_changes(jobs.insert_payments(t).changes, root, 3)
    assert views.refresh_revenue_parts(spark, root) == ["2025-06"]
    now = read_snapshot(spark, root)
    # the other month's part is the one first written
    assert _files(now.revenue_part) == {"revenue_part/written=2/month=2024-06", "revenue_part/written=4/month=2025-06"}
    columns = views.revenue_summary(now).columns
    assert rows(views.revenue_summary(now, now.revenue_part), *columns) == rows(views.revenue_summary(now), *columns)
    # a month that loses all its payments loses its part
    write_snapshot({"payment": now.payment.filter("payment_date > timestamp_ntz'2025-01-01'")}, root, 5)
    assert "2024-06" in views.refresh_revenue_parts(spark, root)
    assert all("2024-06" not in f for f in _files(read_snapshot(spark, root).revenue_part))
