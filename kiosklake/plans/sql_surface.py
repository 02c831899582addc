"""Names for ``spark.sql``: tables, standing views, scalar functions and report functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from kiosklake.plans import reports, views
from kiosklake.sources.tables import Tables

# name, parameters, result and body of the scalar functions
_SCALAR = [
    ("get_pricing", "wanted STRING", "DECIMAL(10,2)",
     "SELECT max(pricing_value) FROM pricing WHERE pricing_key = wanted"),
    ("last_day_of", "at TIMESTAMP_NTZ", "DATE", "last_day(at)"),
    ("rental_days", "begun TIMESTAMP_NTZ, ended TIMESTAMP_NTZ", "BIGINT",
     "greatest(ceil(cast(cast(ended - begun AS INTERVAL SECOND) AS DECIMAL(20,6)) / 86400), 1)"),
    ("rental_fee", "begun TIMESTAMP_NTZ, ended TIMESTAMP_NTZ", "DECIMAL(12,2)",
     "cast(rental_days(begun, ended) AS DECIMAL(10,0)) * get_pricing('daily_rental_rate')"),
]
# name, parameters, and the report or view with the condition that the parameters set
_TABLE = [
    ("customer_balance", "wanted BIGINT", "report_customer_balance", "customer_id = wanted"),
    ("film_cost", "wanted BIGINT", "report_film_prices", "film_id = wanted"),
    ("disc_cost", "wanted BIGINT", "report_disc_prices", "inventory_id = wanted"),
    ("film_availability", "least_stores INT", "report_film_availability", "stores_with_film >= least_stores"),
    ("overdue_in_circulation", "least_days INT", "report_overdue_in_circulation", "days_overdue >= least_days"),
]


def publish(spark: SparkSession, t: Tables, as_of) -> None:
    """Register everything as temporary views and functions of the session.

    Tables keep their names. The standing views are ``customer_rentals``, ``film_catalog``,
    ``overdue_rentals``, ``revenue_summary`` and ``store_inventory_summary``; reports are
    ``report_<name>``. Functions are SQL bodies that the optimizer inlines, so a filter on
    a function's result reaches the scans like any other.
    """
    for name in t:
        t[name].createOrReplaceTempView(name)
    frames = {
        "customer_rentals": views.customer_rentals(t),
        "film_catalog": views.film_catalog(t),
        "overdue_rentals": views.overdue_rentals(t, as_of),
        "revenue_summary": views.revenue_summary(t),
        "store_inventory_summary": views.store_inventory_summary(t),
        "report_customer_balance": reports.customer_balance(t, as_of),
        "report_customer_status_summary": reports.customer_status_summary(t, as_of),
        "report_film_availability": reports.film_availability(t),
        "report_inventory_balance": reports.inventory_balance(t),
        "report_inventory_status_summary": reports.inventory_status_summary(t),
        "report_overdue_in_circulation": reports.overdue_in_circulation(t, as_of, 0),
        "report_film_prices": reports.film_prices(t, as_of),
        "report_disc_prices": reports.disc_prices(t, as_of),
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    for name, parameters, result, body in _SCALAR:
        value = f"({body})" if body.startswith("SELECT") else body
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {value}")
    for name, parameters, source, condition in _TABLE:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frames[source].schema)
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({columns}) "
            f"RETURN SELECT * FROM {source} WHERE {condition}"
        )
