"""Table jobs P1 to P13 and P20, and the earlier-version operators."""

from pyspark.sql import functions as F

from crosscheck.binding import AS_OF as NOW
from crosscheck.binding_sql import AS_OF, CELLS_FIRST, days, digest, dist, draw, rdiv, sql
from crosscheck.q_reports import NEAR, TARGETS, cost
from crosscheck.registry import register
from kiosklake.operators.ranking import random_slice
from kiosklake.plans import jobs, stock

NOW_US = f"epoch_us({AS_OF})"


def numbered(id_name: str, top: str, keys: str | list[str], body: str) -> str:
    """SQL for rows numbered after a table's largest id in digest order."""
    keys = [keys] if isinstance(keys, str) else keys
    return (f"SELECT *, {top} + row_number() OVER (ORDER BY {digest(id_name, *keys)}, {', '.join(keys)}) AS {id_name} "
            f"FROM ({body})")


MAX_PAYMENT = "(SELECT max(payment_id) FROM d_payment)"
FEE = lambda a, b: f"({days(a, b)} * 1.99::decimal(10,2))::double"
DUE = f"""SELECT customer_id, rental_id, {FEE('period_start', 'period_end')} AS amount, period_end AS payment_date
    FROM d_rental WHERE period_end IS NOT NULL AND rental_id NOT IN (SELECT rental_id FROM d_payment)"""
AROUND = "AND period_start >= TIMESTAMP '1998-06-01' - INTERVAL 1 DAY AND period_start <= TIMESTAMP '1998-06-01' + INTERVAL 1 DAY"
register("p1_insert_payments", lambda t: jobs.insert_payments(t, "1998-06-01").rows["payments"],
         sql(numbered("payment_id", MAX_PAYMENT, "rental_id", f"{DUE} {AROUND}")))
register("p1_all_due_payments", lambda t: jobs.insert_payments(t).rows["payments"],
         sql(numbered("payment_id", MAX_PAYMENT, "rental_id", DUE)))
register("p1_charges_total", lambda t: jobs.charges_total(jobs.insert_payments(t)),
         sql(f"SELECT count(*) AS payments, sum(amount::decimal(12,2))::double AS charged FROM ({DUE})"))

POOL = f"""SELECT store_id, customer_id FROM (SELECT s.store_id, c.customer_id, {dist('s.lat', 's.lng', 'c.lat', 'c.lng')} AS m
    FROM d_store s, d_customer c WHERE c.lat IS NOT NULL AND abs(s.lat - c.lat) < 0.5) WHERE m <= 25000"""
LISTED = f"""SELECT p.*, row_number() OVER (PARTITION BY customer_id ORDER BY {CELLS_FIRST}) AS pick,
    count(*) OVER (PARTITION BY customer_id) AS reach FROM pool p JOIN d_place g ON g.store_id = p.store_id"""
ELIGIBLE = f"""SELECT rental_id, customer_id, period_start, row_number() OVER (ORDER BY {digest('returns', 'rental_id')}, rental_id) AS rn,
    count(*) OVER () AS n FROM d_rental WHERE period_end IS NULL AND period_start < {AS_OF} - INTERVAL 16 HOUR"""
RETURNS = f"""SELECT e.rental_id, greatest({AS_OF}, e.period_start + INTERVAL 16 HOUR
        + to_microseconds(floor({draw('returns-time', 'e.rental_id')} * 288000000000.0::double)::bigint)) AS return_time,
    l.store_id AS return_store_id
    FROM (SELECT * FROM eligible WHERE rn > (2 * n + 1000) // 2000
          AND rn <= (2 * n + 1000) // 2000 + greatest(1, (30 * n + 100) // 200)) e
    LEFT JOIN listed l ON l.customer_id = e.customer_id
        AND l.pick = floor({draw('returns-store', 'e.rental_id')} * l.reach) + 1"""
RETURN_CTES = {"pool": POOL, "listed": LISTED, "eligible": ELIGIBLE, "returned": RETURNS}
register("p2_plan_returns", lambda t: jobs.plan_returns(t, NOW), sql("SELECT * FROM returned", **RETURN_CTES))


def _completed(t):
    return jobs.complete_rentals(t, jobs.plan_returns(t, NOW), NOW)


register("p2_completed_rentals", lambda t: _completed(t).tables.rental, sql(f"""
    SELECT r.rental_id, r.period_start, coalesce(b.return_time, r.period_end) AS period_end, r.inventory_id, r.customer_id,
    r.store_id, r.last_update
    FROM d_rental r LEFT JOIN returned b ON b.rental_id = r.rental_id""", **RETURN_CTES))
register("p2_moved_discs", lambda t: _completed(t).tables.inventory, sql(f"""
    SELECT i.inventory_id, i.film_id, coalesce(m.to_store, i.store_id) AS store_id, i.status_id, i.circulation_start,
    CASE WHEN m.to_store <> i.store_id THEN {AS_OF} ELSE i.last_update END AS last_update
    FROM d_inventory i LEFT JOIN (SELECT r.inventory_id, arg_min(coalesce(b.return_store_id, r.store_id), r.rental_id) AS to_store
        FROM d_rental r JOIN returned b ON b.rental_id = r.rental_id GROUP BY r.inventory_id) m
    ON m.inventory_id = i.inventory_id""", **RETURN_CTES))
register("p2_return_payments", lambda t: _completed(t).rows["payments"], sql(numbered(
    "payment_id", MAX_PAYMENT, "rental_id", f"""SELECT r.customer_id, r.rental_id,
    {FEE('r.period_start', 'b.return_time')} AS amount, b.return_time AS payment_date
    FROM d_rental r JOIN returned b ON b.rental_id = r.rental_id"""), **RETURN_CTES))

HOME = f"""SELECT r.rental_id, r.customer_id, r.inventory_id, r.period_start, l.store_id AS return_store_id
    FROM d_rental r LEFT JOIN listed l ON l.customer_id = r.customer_id
        AND l.pick = floor({draw('return', 'r.rental_id')} * l.reach) + 1
    WHERE r.period_end IS NULL AND r.period_start < {AS_OF} - INTERVAL 8 HOUR"""
register("s23_return_payments", lambda t: jobs.return_rentals(t, NOW).rows["payments"], sql(numbered(
    "payment_id", MAX_PAYMENT, "rental_id", f"""SELECT customer_id, rental_id, {FEE('period_start', AS_OF)} AS amount,
    {AS_OF} AS payment_date FROM home"""), pool=POOL, listed=LISTED, home=HOME))
register("s23_returned_discs", lambda t: jobs.return_rentals(t, NOW).tables.inventory.select("inventory_id", "store_id"), sql("""
    SELECT i.inventory_id, coalesce(m.to_store, i.store_id) AS store_id FROM d_inventory i LEFT JOIN
    (SELECT inventory_id, arg_min(return_store_id, rental_id) AS to_store FROM home WHERE return_store_id IS NOT NULL
     GROUP BY inventory_id) m ON m.inventory_id = i.inventory_id""", pool=POOL, listed=LISTED, home=HOME))

LOST = f"""SELECT r.rental_id, r.customer_id, r.inventory_id, i.status_id, {cost('f.release_date')}::double AS amount
    FROM d_rental r JOIN d_inventory i ON i.inventory_id = r.inventory_id JOIN d_film f ON f.film_id = i.film_id
    WHERE r.period_end IS NULL AND r.period_start < {AS_OF} - INTERVAL 30 DAY"""
LOST_PAID = "SELECT customer_id, rental_id, amount, {0} AS payment_date FROM lost".format(AS_OF)
register("p3_lost_payments", lambda t: jobs.process_lost_rentals(t, NOW).rows["payments"],
         sql(numbered("payment_id", MAX_PAYMENT, "rental_id", LOST_PAID), lost=LOST))
LOG_COLS = "customer_id, {0} AS status_date".format(AS_OF)
SIGNUP = """SELECT customer_id + 1 AS log_id, customer_id, create_date::timestamp AS status_date, 'active' AS status,
    'signup' AS reason_code, 'Backfilled from existing customer data' AS notes, NULL::bigint AS rental_id FROM d_customer"""
MAX_LOG = "(SELECT max(customer_id) + 1 FROM d_customer)"


def log_sql(entries: str, base: str = SIGNUP, top: str = MAX_LOG) -> str:
    # the digest sees timestamps as text, so spell them as Spark does
    keyed = numbered("log_id", top, ["customer_id", "status", "strftime(status_date, '%Y-%m-%d %H:%M:%S')"], entries)
    cols = "log_id, customer_id, status_date, status, reason_code, notes, rental_id"
    return f"SELECT {cols} FROM ({base}) UNION ALL SELECT {cols} FROM ({keyed})"


SUSPENDED = f"""SELECT {LOG_COLS}, 'suspended' AS status, 'lost_item' AS reason_code,
    'Item not returned, charged replacement cost' AS notes, min(rental_id) AS rental_id FROM lost GROUP BY customer_id"""
register("p3_suspension_log", lambda t: jobs.process_lost_rentals(t, NOW).tables.customer_status_log,
         sql(log_sql(SUSPENDED), lost=LOST))
register("p3_closed_rentals", lambda t: jobs.process_lost_rentals(t, NOW).tables.rental, sql(f"""
    SELECT r.rental_id, r.period_start, CASE WHEN l THEN {AS_OF} ELSE r.period_end END AS period_end, r.inventory_id,
    r.customer_id, r.store_id, r.last_update
    FROM (SELECT *, rental_id IN (SELECT rental_id FROM lost) AS l FROM d_rental) r""", lost=LOST))
ACTIVE = lambda cond: f"SELECT customer_id, activebool AND NOT ({cond}) AS activebool FROM d_customer"
register("p3_suspended_customers", lambda t: jobs.process_lost_rentals(t, NOW).tables.customer.select("customer_id", "activebool"),
         sql(ACTIVE("customer_id IN (SELECT customer_id FROM lost)"), lost=LOST))
register("p4_lost_without_suspension",
         lambda t: jobs.process_lost_rentals(t, NOW, suspend=False).summary(),
         sql("SELECT 'lost' AS label, count(*) AS n FROM lost UNION ALL SELECT 'payments', count(*) FROM lost", lost=LOST))
IN_USE = f"SELECT * FROM ({LOST}) WHERE status_id = 1"


def closed_rentals(stamped: bool) -> str:
    """All rentals after those of ``lost`` were written off."""
    dated = f"CASE WHEN l THEN {AS_OF} ELSE last_update END" if stamped else "last_update"
    return f"""SELECT rental_id, period_start, CASE WHEN l THEN {AS_OF} ELSE period_end END AS period_end, inventory_id, customer_id,
        store_id, {dated} AS last_update FROM (SELECT *, rental_id IN (SELECT rental_id FROM lost) AS l FROM d_rental)"""


LOST_DISCS = f"""SELECT inventory_id, film_id, store_id, CASE WHEN l THEN 2 ELSE status_id END AS status_id, circulation_start,
    CASE WHEN l THEN {AS_OF} ELSE last_update END AS last_update
    FROM (SELECT *, inventory_id IN (SELECT inventory_id FROM lost) AS l FROM d_inventory)"""
KEPT_PAYMENTS = "SELECT payment_id, customer_id, rental_id, amount::double AS amount, payment_date FROM d_payment"


def all_payments(body: str) -> str:
    added = numbered("payment_id", MAX_PAYMENT, "rental_id", body)
    return f"{KEPT_PAYMENTS} UNION ALL SELECT payment_id, customer_id, rental_id, amount, payment_date FROM ({added})"


def _kept_payments(tables):
    return tables.payment.select("payment_id", "customer_id", "rental_id", "amount", "payment_date")


register("p4_closed_rentals", lambda t: jobs.process_lost_rentals(t, NOW, suspend=False).tables.rental,
         sql(closed_rentals(False), lost=LOST))
register("p4_lost_discs", lambda t: jobs.process_lost_rentals(t, NOW, suspend=False).tables.inventory, sql(LOST_DISCS, lost=LOST))
register("p4_all_payments", lambda t: _kept_payments(jobs.process_lost_rentals(t, NOW, suspend=False).tables),
         sql(all_payments(LOST_PAID), lost=LOST))
register("p5_closed_rentals", lambda t: jobs.process_lost_inventory(t, NOW).tables.rental, sql(closed_rentals(True), lost=IN_USE))
register("p5_stopped_customers", lambda t: jobs.process_lost_inventory(t, NOW).tables.customer.select("customer_id", "activebool"),
         sql("SELECT customer_id, activebool AND customer_id NOT IN (SELECT customer_id FROM lost) AS activebool FROM d_customer",
             lost=IN_USE))
register("p20_nightly_rentals", lambda t: jobs.nightly_maintenance(t, NOW, reactivate_pct=20.0).tables.rental,
         sql(closed_rentals(True), lost=IN_USE))
register("p20_nightly_discs", lambda t: jobs.nightly_maintenance(t, NOW, reactivate_pct=20.0).tables.inventory,
         sql(LOST_DISCS, lost=IN_USE))
register("p20_nightly_payments", lambda t: _kept_payments(jobs.nightly_maintenance(t, NOW, reactivate_pct=20.0).tables),
         sql(all_payments(LOST_PAID), lost=IN_USE))
register("s23_returned_rentals", lambda t: jobs.return_rentals(t, NOW).tables.rental, sql(f"""
    SELECT rental_id, period_start, CASE WHEN b THEN {AS_OF} ELSE period_end END AS period_end, inventory_id, customer_id, store_id,
    CASE WHEN b THEN {AS_OF} ELSE last_update END AS last_update
    FROM (SELECT *, rental_id IN (SELECT rental_id FROM home) AS b FROM d_rental)""", pool=POOL, listed=LISTED, home=HOME))
register("p5_lost_inventory_payments", lambda t: jobs.process_lost_inventory(t, NOW).rows["payments"],
         sql(numbered("payment_id", MAX_PAYMENT, "rental_id", LOST_PAID), lost=IN_USE))
register("p5_lost_inventory_discs", lambda t: jobs.process_lost_inventory(t, NOW).tables.inventory.select("inventory_id", "status_id"),
         sql("SELECT inventory_id, CASE WHEN inventory_id IN (SELECT inventory_id FROM lost) THEN 2 ELSE status_id END AS status_id FROM d_inventory",
             lost=IN_USE))

# nobody who never rented: the rule reads the missing rental as an open one
DORMANT = f"""SELECT customer_id FROM {{customer}} WHERE activebool AND customer_id IN (
        SELECT customer_id FROM {{rental}} GROUP BY customer_id
        HAVING bool_and(period_end IS NOT NULL) AND max(period_start) < {AS_OF} - INTERVAL 180 DAY)"""
GONE = f"SELECT {LOG_COLS}, 'inactive' AS status, 'inactivity' AS reason_code, 'No rental in 180 days' AS notes, NULL::bigint AS rental_id FROM dormant"
register("p6_deactivate_dormant", lambda t: jobs.deactivate_dormant(t, NOW).tables.customer_status_log,
         sql(log_sql(GONE), dormant=DORMANT.format(customer="d_customer", rental="d_rental")))
BACK = lambda src: (f"SELECT {LOG_COLS}, 'active' AS status, 'winback' AS reason_code, 'Random reactivation (simulated marketing)' AS notes, "
                    f"NULL::bigint AS rental_id FROM {src} WHERE NOT activebool AND {draw('winback', 'customer_id')} < 20.0::double / 100.0::double")
register("p7_win_back", lambda t: jobs.win_back(t, NOW, 20.0).tables.customer_status_log, sql(log_sql(BACK("d_customer"))))
AFTER_DORMANT = "SELECT customer_id, activebool AND customer_id NOT IN (SELECT customer_id FROM dormant) AS activebool FROM {0}"
FINAL = f"SELECT customer_id, activebool OR {draw('winback', 'customer_id')} < 20.0::double / 100.0::double AS activebool FROM quiet"
register("p7_activity_customers",
         lambda t: jobs.update_customer_activity(t, NOW, reactivate_pct=20.0).tables.customer.select("customer_id", "activebool"),
         sql(FINAL, dormant=DORMANT.format(customer="d_customer", rental="d_rental"), quiet=AFTER_DORMANT.format("d_customer")))
CLOSED = f"""SELECT customer_id, period_start, CASE WHEN rental_id IN (SELECT rental_id FROM lost) THEN {AS_OF} ELSE period_end END
    AS period_end FROM d_rental"""
register("p20_nightly_customers",
         lambda t: jobs.nightly_maintenance(t, NOW, reactivate_pct=20.0).tables.customer.select("customer_id", "activebool"),
         sql(FINAL, lost=IN_USE, blocked=ACTIVE("customer_id IN (SELECT customer_id FROM lost)"), closed=CLOSED,
             dormant=DORMANT.format(customer="blocked", rental="closed"), quiet=AFTER_DORMANT.format("blocked")))
register("p20_nightly_summary", lambda t: jobs.nightly_maintenance(t, NOW, reactivate_pct=20.0).summary(),
         sql(f"""SELECT 'lost' AS label, count(*) AS n FROM lost UNION ALL SELECT 'payments', count(*) FROM lost
         UNION ALL SELECT 'deactivated', count(*) FROM dormant UNION ALL SELECT 'reactivated', count(*) FROM ({BACK('quiet')})""",
             lost=IN_USE, blocked=ACTIVE("customer_id IN (SELECT customer_id FROM lost)"), closed=CLOSED,
             dormant=DORMANT.format(customer="blocked", rental="closed"), quiet=AFTER_DORMANT.format("blocked")))

MOVES = f"""SELECT q.inventory_id, q.store_id AS from_store, s.to_store FROM (SELECT *, row_number() OVER (ORDER BY
        {digest('rebalance-all', 'inventory_id')}, inventory_id) AS g FROM given) q
    JOIN slots s ON s.slot_rank = (q.g - 1) % (SELECT count(*) FROM slots) + 1 WHERE q.g <= 10000"""
MOVE_CTES = dict(
    near=NEAR, targets=TARGETS,
    slots="""SELECT store_id AS to_store, row_number() OVER (ORDER BY target_inventory - current_inventory DESC, store_id) AS slot_rank
        FROM targets WHERE current_inventory < target_inventory * 0.9""",
    given=f"""SELECT inventory_id, store_id FROM (SELECT d.inventory_id, d.store_id, t.current_inventory - t.target_inventory AS excess,
        row_number() OVER (PARTITION BY d.store_id ORDER BY {digest('rebalance-store', 'inventory_id')}, inventory_id) AS rn
        FROM d_disc d JOIN targets t ON t.store_id = d.store_id
        WHERE d.is_available AND t.current_inventory > t.target_inventory * 1.1) WHERE rn <= excess""")
NIGHT = dict(lost=IN_USE, blocked=ACTIVE("customer_id IN (SELECT customer_id FROM lost)"), closed=CLOSED,
             dormant=DORMANT.format(customer="blocked", rental="closed"), quiet=AFTER_DORMANT.format("blocked"))
register("p20_nightly_log", lambda t: jobs.nightly_maintenance(t, NOW, reactivate_pct=20.0).tables.customer_status_log,
         sql(log_sql(BACK("quiet"), "SELECT * FROM first_log", "(SELECT max(log_id) FROM first_log)"), **NIGHT, first_log=log_sql(GONE)))

register("p8_rebalance_moves", stock.rebalance_moves, sql(MOVES, **MOVE_CTES))
register("p8_rebalanced_discs", lambda t: stock.rebalance_inventory(t, NOW)[0].inventory, sql(f"""
    SELECT i.inventory_id, i.film_id, coalesce(m.to_store, i.store_id) AS store_id, i.status_id, i.circulation_start,
    CASE WHEN m.to_store IS NOT NULL THEN {AS_OF} ELSE i.last_update END AS last_update
    FROM d_inventory i LEFT JOIN ({MOVES}) m ON m.inventory_id = i.inventory_id""", **MOVE_CTES))

TIER = f"""CASE WHEN popularity >= 100 OR release_date > {AS_OF} - INTERVAL 1 YEAR THEN 'A'
    WHEN popularity >= 30 OR release_date > {AS_OF} - INTERVAL 3 YEAR THEN 'B'
    WHEN popularity >= 10 OR vote_average >= 7.0::float THEN 'C' ELSE 'D' END"""


ALLOCATION = f"""SELECT f.film_id, s.store_id, f.tier, floor({draw('stock-copies', 'f.film_id', 's.store_id')} * k.steps + k.low)::int AS copies
        FROM (SELECT film_id, {TIER} AS tier FROM d_film) f
        JOIN (VALUES ('A', 1.0, 10, 5), ('B', 0.6, 5, 3), ('C', 0.3, 2, 3), ('D', 0.1, 1, 2)) k(tier, share, low, steps) ON k.tier = f.tier
        JOIN (SELECT store_id, {draw('stock-store', 'store_id')} AS chance FROM d_store) s
          ON k.share >= 1.0 OR s.chance < k.share::double"""
register("p9_allocation", lambda t: stock.allocation(t, NOW, clear_existing=True), sql(ALLOCATION))
register("p9_populate_inventory", lambda t: stock.populate_inventory(t, NOW, clear_existing=True)[1].groupBy(
    "film_id", "store_id", "status_id").agg(F.count(F.lit(1)).alias("discs"), F.min("inventory_id").alias("first_id"),
    F.max("inventory_id").alias("last_id"), F.sum("inventory_id").alias("id_sum")), sql(f"""
    SELECT film_id, store_id, 1 AS status_id, count(*) AS discs, min(id) AS first_id, max(id) AS last_id, sum(id)::bigint AS id_sum FROM (
        SELECT film_id, store_id, row_number() OVER (ORDER BY {digest('inventory_id', 'film_id', 'store_id', 'copy')}, film_id, store_id, copy) AS id
        FROM (SELECT film_id, store_id, unnest(generate_series(1, copies)) AS copy FROM ({ALLOCATION}))) GROUP BY ALL"""))

register("p10_random_slice", lambda t: random_slice(
    t.rental.filter(F.col("period_end").isNull()).select("rental_id", "customer_id"), "slice", ["rental_id"], 2.5, 40.0), sql(f"""
    SELECT rental_id, customer_id FROM (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY
        {digest('slice', 'rental_id')}, rental_id) AS rn FROM d_rental WHERE period_end IS NULL)
    WHERE rn > (2 * n * 25 + 1000) // 2000 AND rn <= (2 * n * 25 + 1000) // 2000 + greatest(1, (2 * n * 40 + 100) // 200)"""))
register("p11_store_pool", stock.store_pool, sql("SELECT * FROM pool", pool=POOL))
ACTIVE_POOL = "SELECT p.* FROM pool p JOIN d_customer c ON c.customer_id = p.customer_id WHERE c.activebool"
SIZES = "SELECT store_id, count(*) AS local_count FROM active_pool GROUP BY store_id"
DAY_TARGETS = f"""SELECT store_id, local_count, {rdiv('5000 * local_count', '(SELECT sum(local_count) FROM sizes)', 0)}::bigint AS target FROM sizes"""
register("p12_day_targets", lambda t: stock.day_targets(t, 5000),
         sql(DAY_TARGETS, pool=POOL, active_pool=ACTIVE_POOL, sizes=SIZES))
BUSY = "period_start < TIMESTAMP '1999-03-02' AND (period_end IS NULL OR period_end > TIMESTAMP '1999-03-01')"
PAIR_CTES = {
    "pool": POOL, "active_pool": ACTIVE_POOL, "sizes": SIZES, "targets_": DAY_TARGETS, "listed": LISTED,
    "placed": f"""SELECT l.store_id, l.customer_id FROM listed l JOIN d_customer c ON c.customer_id = l.customer_id
        WHERE c.activebool AND l.customer_id NOT IN (SELECT customer_id FROM d_rental WHERE {BUSY})
        AND l.pick = floor({draw('pair-home', 'l.customer_id')} * l.reach) + 1""",
    "people": f"""SELECT p.store_id, p.customer_id, t.target, row_number() OVER (PARTITION BY p.store_id ORDER BY
        {digest('pair-customer_id', 'customer_id')}, customer_id) AS rn FROM placed p JOIN targets_ t ON t.store_id = p.store_id WHERE t.target > 0""",
    "discs": f"""SELECT i.store_id, i.inventory_id, t.target, row_number() OVER (PARTITION BY i.store_id ORDER BY
        {digest('pair-inventory_id', 'inventory_id')}, inventory_id) AS rn
        FROM d_inventory i JOIN d_film f ON f.film_id = i.film_id JOIN targets_ t ON t.store_id = i.store_id
        WHERE i.status_id = 1 AND t.target > 0 AND f.release_date <= DATE '1999-03-01'
        AND i.inventory_id NOT IN (SELECT inventory_id FROM d_rental WHERE {BUSY})""",
}
register("p13_pair_rentals", lambda t: stock.pair_rentals(t, "1999-03-01", 5000), sql("""
    SELECT p.store_id, p.rn, p.customer_id, d.inventory_id FROM people p JOIN discs d ON d.store_id = p.store_id AND d.rn = p.rn
    WHERE p.rn <= p.target AND d.rn <= d.target""", **PAIR_CTES))
