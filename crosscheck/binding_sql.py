"""The same derivations as ``binding.py`` in SQL, plus small SQL text helpers."""

from __future__ import annotations

from kiosklake.sources import seeds

AS_OF = "TIMESTAMP '2001-06-01'"
BASE = "1000000000"


def spot(base: float, key: str, mul: int, mod: int, span: float) -> str:
    return f"({base}::double + (({key} * {mul}) % {mod})::double * {span}::double / {mod}::double)"


def rdiv(num: str, den: str, digits: int) -> str:
    """num / den for integers, rounded half away from zero, as double."""
    scale = 10**digits
    n, d = f"(({num})::hugeint)", f"(({den})::hugeint)"
    return (
        f"(CASE WHEN {d} = 0 THEN NULL ELSE "
        f"(sign({n})::hugeint * ((2 * abs({n}) * {scale} + {d}) // (2 * {d})))::double / {scale} END)"
    )


def cents(money: str) -> str:
    return f"((({money}) * 100)::hugeint)"


def seconds(start: str, end: str) -> str:
    return f"(epoch_us({end}) - epoch_us({start}))"


def days(start: str, end: str) -> str:
    """Started days, at least one."""
    return f"greatest((({seconds(start, end)}) + 86399999999) // 86400000000, 1)"


def dist(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    """Andoyer-Lambert distance in metres."""
    f = "(1.0::double / 298.257223563::double)"
    b1 = f"atan((1.0::double - {f}) * tan(radians({lat1})))"
    b2 = f"atan((1.0::double - {f}) * tan(radians({lat2})))"
    return f"""(SELECT CASE WHEN sg = 0 THEN 0.0::double ELSE 6378137.0::double * (sg - {f} / 2.0::double * (
        (sg - sin(sg)) * pow(sin((b1 + b2) / 2) * cos((b2 - b1) / 2) / cos(sg / 2), 2)
      + (sg + sin(sg)) * pow(cos((b1 + b2) / 2) * sin((b2 - b1) / 2) / sin(sg / 2), 2))) END
      FROM (SELECT b1, b2, 2.0::double * asin(sqrt(least(1.0::double,
          pow(sin((b2 - b1) / 2), 2) + cos(b1) * cos(b2) * pow(sin(hl), 2)))) AS sg
        FROM (SELECT {b1} AS b1, {b2} AS b2, radians({lng2} - {lng1}) / 2.0::double AS hl)))"""


def digest(seed: str, *keys: str) -> str:
    parts = ", ".join(f"({k})::varchar" for k in keys)
    return f"md5(concat_ws('|', '{seed}', {parts}))"


def draw(seed: str, *keys: str) -> str:
    return f"((('0x' || substr({digest(seed, *keys)}, 1, 13))::bigint)::double / {16**13}::double)"


def _rows(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join("'" + str(v) + "'" for v in r) + ")" for r in rows)


# Degrees of latitude and longitude of a cell.
CELL_ROW, CELL_COL = (f"{12500.0 / metres!r}::double" for metres in (110574.0, 111319.0))
CELLS_FIRST = "g.cell_row, g.cell_col, g.lat, g.lng, g.store_id"

CTES: dict[str, str] = {
    "d_customer": f"""SELECT c_custkey AS customer_id, c_custkey % (SELECT count(*) FROM supplier) AS store_id,
        c_name AS full_name, lower(c_name) || '@example.org' AS email, '555-' || c_custkey AS phone,
        c_nationkey AS zip_code, c_custkey % 7 <> 0 AS activebool,
        DATE '1994-01-01' + (c_custkey % 365)::int AS create_date,
        CASE WHEN c_custkey % 50 <> 13 THEN {spot(40.0, 'c_custkey', 41, 997, 4.0)} END AS lat,
        CASE WHEN c_custkey % 50 <> 13 THEN {spot(-79.0, 'c_custkey', 59, 991, 6.0)} END AS lng
        FROM customer""",
    "d_store": f"""SELECT s_suppkey AS store_id, s_name AS street_name, 'Route ' || (s_suppkey % 50) AS road_ref,
        '556-' || s_suppkey AS phone, s_nationkey AS zip_code,
        {spot(40.0, 's_suppkey', 37, 97, 4.0)} AS lat, {spot(-79.0, 's_suppkey', 53, 89, 6.0)} AS lng
        FROM supplier""",
    # stores with the cell of 12.5 km that they lie in
    "d_place": f"""SELECT *, floor((lng + 180) * columns / 360)::int % columns AS cell_col FROM (
        SELECT *, greatest(floor(cos(radians(least(abs((cell_row + 0.5::double) * {CELL_ROW} - 90) + {CELL_ROW} / 2, 90))) * (360.0::double / {CELL_COL})), 1)::int AS columns
        FROM (SELECT *, floor((lat + 90) / {CELL_ROW})::int AS cell_row FROM d_store))""",
    "d_zip": f"""SELECT n_nationkey AS zip_code, n_name AS city, r_name AS state_id,
        n_nationkey * 1000 + 500 AS population,
        {spot(40.0, 'n_nationkey', 7, 25, 4.0)} AS lat, {spot(-79.0, 'n_nationkey', 11, 25, 6.0)} AS lng
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "d_film": """SELECT p_partkey AS film_id, p_name || ' ' || p_partkey AS title,
        concat_ws(' ', p_type, p_brand, p_name) AS overview,
        CASE WHEN p_partkey % 61 <> 7 THEN DATE '1993-01-01' + (p_partkey % 3000)::int END AS release_date,
        CASE WHEN p_partkey % 83 = 3 THEN NULL WHEN p_partkey % 83 = 4 THEN []::int[]
             ELSE [(p_partkey % 25)::int, ((p_partkey * 7 + 3) % 27)::int] END AS genre_ids,
        CASE WHEN p_partkey % 5 = 0 THEN 'fr' ELSE 'en' END AS original_language,
        CASE p_partkey % 7 WHEN 0 THEN 'G' WHEN 1 THEN 'PG' WHEN 2 THEN 'PG-13' WHEN 3 THEN 'R'
             WHEN 4 THEN 'NC-17' WHEN 5 THEN 'NR' END AS rating,
        CASE WHEN p_partkey % 97 <> 5 THEN ((p_partkey * 13 % 6000)::double / 10)::float END AS popularity,
        (p_partkey * 11 % 500)::int AS vote_count, ((p_partkey * 17 % 100)::double / 10)::float AS vote_average,
        CASE WHEN p_partkey % 3 <> 0 THEN p_partkey * 7919 % 200000000 END AS budget,
        CASE WHEN p_partkey % 3 <> 1 THEN p_partkey * 104729 % 900000000 END AS revenue,
        CASE WHEN p_partkey % 3 <> 2 THEN p_size + 80 END AS runtime
        FROM part""",
    "d_genre": """SELECT n_nationkey AS genre_id, n_name AS name FROM nation
        UNION ALL SELECT 25, n_name FROM nation WHERE n_nationkey = 3""",
    "d_person": """SELECT s_suppkey AS person_id,
        'Actor ' || (CASE WHEN s_suppkey % 10 = 9 THEN s_suppkey - 1 ELSE s_suppkey END) AS name,
        CASE WHEN s_suppkey % 13 <> 0 THEN s_acctbal::float END AS popularity FROM supplier""",
    "d_cast": """SELECT DISTINCT l_partkey AS film_id, l_suppkey AS person_id,
        'Role ' || ((l_partkey + l_suppkey) % 50) AS film_character FROM lineitem""",
    "d_crew": """SELECT l_partkey AS film_id, l_suppkey AS person_id,
        CASE min(l_returnflag) WHEN 'A' THEN 'Directing' WHEN 'N' THEN 'Writing' ELSE 'Production' END AS department,
        CASE min(l_returnflag) WHEN 'A' THEN 'Director' WHEN 'N' THEN 'Writer' ELSE 'Producer' END AS job
        FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "d_line": """SELECT l_orderkey AS o_orderkey, l_partkey AS film_id, l_suppkey % 4 AS copy, l_extendedprice,
        (l_partkey * 7 + l_suppkey % 4 * 13) % (SELECT count(*) FROM supplier) AS store_id FROM lineitem""",
    "d_inventory": f"""SELECT film_id * {BASE} + store_id AS inventory_id, film_id, store_id,
        greatest((film_id * 7 + store_id) % 20 - 15, 1)::int AS status_id,
        TIMESTAMP '1996-01-01' + ((film_id * 7 + store_id) % 1500 * 24)::int * INTERVAL 1 HOUR AS circulation_start,
        TIMESTAMP '2001-01-01' + ((film_id + store_id) % 120)::int * INTERVAL 1 HOUR AS last_update
        FROM (SELECT DISTINCT film_id, store_id FROM d_line)""",
    "d_rented": f"""SELECT o_orderkey * {BASE} + film_id * 4 + copy AS rental_id, film_id, store_id, price, o.*,
        o_orderdate + (o_orderkey % 62 + 10)::int * INTERVAL 1 HOUR AS due
        FROM (SELECT o_orderkey, film_id, copy, store_id, min(l_extendedprice) AS price FROM d_line GROUP BY ALL) JOIN orders o USING (o_orderkey)""",
    "d_rental": f"""SELECT rental_id, o_orderdate AS period_start, CASE WHEN NOT still_out THEN due END AS period_end,
        film_id * {BASE} + store_id AS inventory_id, o_custkey AS customer_id, store_id,
        CASE WHEN still_out THEN o_orderdate ELSE due END AS last_update
        FROM (SELECT *, o_orderstatus = 'O' AND (o_orderkey + film_id) % 8 = 0 AS still_out FROM d_rented)""",
    "d_payment": """SELECT rental_id * 2 + part AS payment_id, o_custkey AS customer_id, rental_id,
        (CASE WHEN part = 0 THEN price ELSE 1.99::double END)::decimal(12,2) AS amount, due AS payment_date
        FROM d_rented, (SELECT unnest([0, 1]) AS part)
        WHERE o_orderstatus = 'F' AND (part = 0 OR o_orderkey % 11 = 0)""",
    "d_holiday": """SELECT year(d) * 10000 + month(d) * 100 + day(d) AS id,
        (CASE month(d) WHEN 1 THEN 'New Year' WHEN 7 THEN 'Independence Day' WHEN 11 THEN 'Veterans Day'
         ELSE 'Christmas' END) || ' ' || year(d) AS holiday_name, d AS holiday_date
        FROM (SELECT DISTINCT o_orderdate::date AS d FROM orders)
        WHERE month(d) * 100 + day(d) IN (101, 704, 1111, 1225)""",
    "d_status": f"""SELECT status_id::int AS status_id, status_code, description, display_order::int AS display_order
        FROM (VALUES {_rows(seeds.STATUSES)}) v(status_id, status_code, description, display_order)""",
    "d_pricing": f"""SELECT pricing_key, pricing_value::decimal(10,2) AS pricing_value, description
        FROM (VALUES {_rows(seeds.PRICES)}) v(pricing_key, pricing_value, description, effective_date)""",
    "d_detail": f"""SELECT CASE WHEN p_partkey % 40 = 0 THEN p_partkey + {BASE} ELSE p_partkey END AS film_id,
        p_partkey AS k, p_partkey * 31 % 100000 AS budget, p_partkey * 37 % 100000 AS revenue,
        p_partkey % 60 + 60 AS runtime, p_partkey % 10 = 0 AS processed FROM part""",
    "d_film_company": """SELECT p_partkey AS film_id, (p_partkey * 3) % 300 AS production_company_id
        FROM part WHERE p_partkey % 6 = 0""",
    "d_company": "SELECT n_nationkey::bigint AS production_company_id, 'Company ' || n_nationkey AS name FROM nation",
    # discs with a flag for an open rental, used by every availability question
    "d_disc": """SELECT i.*, o.inventory_id IS NOT NULL AS is_out, i.status_id = 1 AND o.inventory_id IS NULL AS is_available
        FROM d_inventory i LEFT JOIN (SELECT DISTINCT inventory_id FROM d_rental WHERE period_end IS NULL) o
        ON o.inventory_id = i.inventory_id""",
}


def sql(body: str, **more: str) -> str:
    """A full statement: the derivations a body needs, extra CTEs, then the body."""
    used, text = [], body + " ".join(more.values())
    pending = True
    names = list(CTES)
    while pending:
        pending = False
        for name in names:
            if name not in used and name in text:
                used.append(name)
                text += CTES[name]
                pending = True
    parts = [f"{n} AS ({CTES[n]})" for n in names if n in used]
    parts += [f"{n} AS ({q})" for n, q in more.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
