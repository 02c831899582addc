from pyspark.sql import functions as F

from kiosklake.sources.tables import read_snapshot, write_snapshot
from kiosklake.streaming import billing, lost
from tests.conftest import dt, money


def test_billing_stream_bills_each_rental_once(spark, tables, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("rentals", "payments", "state"))
    first = tables.rental.filter("period_end is not null and rental_id <= 2")
    first.coalesce(1).write.parquet(source)

    def run(checkpoint=state):
        stream = spark.readStream.schema(tables.rental.schema).parquet(source)
        billing.bill_closed_rentals(stream, tables, sink, checkpoint).awaitTermination()
        return sorted((r.rental_id, r.amount) for r in billing.billed(spark, sink).collect())

    assert run() == [(1, money("1.99"))]  # rental 2 was paid before
    tables.rental.filter("period_end is not null").coalesce(1).write.mode("append").parquet(source)
    assert run() == [(1, money("1.99")), (3, money("3.98"))]
    assert run() == [(1, money("1.99")), (3, money("3.98"))]
    paid = billing.billed(spark, sink)
    assert paid.select("payment_id").distinct().count() == paid.count()


def test_a_batch_opens_its_months_only(spark, tables, tmp_path, monkeypatch):
    root = str(tmp_path / "snap")
    write_snapshot({n: tables[n] for n in ("payment", "inventory", "film", "pricing")}, root, 1)
    t = read_snapshot(spark, root)
    seen = []
    due = billing.due_payments
    monkeypatch.setattr(billing, "due_payments", lambda *a, known, **k: seen.append(known) or due(*a, known=known, **k))
    tables.rental.filter("period_end is not null and rental_id <= 3").coalesce(1).write.parquet(str(tmp_path / "rentals"))
    stream = spark.readStream.schema(tables.rental.schema).parquet(str(tmp_path / "rentals"))
    billing.bill_closed_rentals(stream, t, str(tmp_path / "sink"), str(tmp_path / "state")).awaitTermination()
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan and ">= 2025-06)" in plan and "2025-06" in plan.split("PartitionFilters")[1]
    assert sorted(r.rental_id for r in billing.billed(spark, str(tmp_path / "sink")).collect()) == [1, 3]


def test_lost_alerts(spark, tmp_path):
    rented = [(1, dt("2025-01-01 00:00:00")), (2, dt("2025-01-02 00:00:00")), (3, dt("2025-01-03 00:00:00")), (4, dt("2025-06-01 00:00:00"))]
    # 1 comes back in time, 2 too late, 3 never; 4 is too recent to call lost
    returned = [(1, dt("2025-01-20 00:00:00")), (2, dt("2025-03-20 00:00:00")), (9, dt("2025-06-01 00:00:00"))]
    spark.createDataFrame(rented, "rental_id long, rented_at timestamp_ntz").selectExpr(
        "rental_id", "7L as customer_id", "8L as inventory_id", "cast(rented_at as timestamp) as rented_at"
    ).coalesce(1).write.parquet(str(tmp_path / "rented"))
    spark.createDataFrame(returned, "rental_id long, returned_at timestamp_ntz").selectExpr(
        "rental_id", "cast(returned_at as timestamp) as returned_at"
    ).coalesce(1).write.parquet(str(tmp_path / "returned"))
    read = lambda name, schema: spark.readStream.schema(schema).parquet(str(tmp_path / name))
    alerts = lost.lost_alerts(
        read("rented", "rental_id long, customer_id long, inventory_id long, rented_at timestamp"),
        read("returned", "rental_id long, returned_at timestamp"),
    )
    lost.write_alerts(alerts, str(tmp_path / "alerts"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.schema(alerts.schema).parquet(str(tmp_path / "alerts"))
    assert sorted(r.rental_id for r in got.collect()) == [2, 3]
