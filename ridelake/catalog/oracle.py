"""The same results in plain SQL, written independently of the Spark plans.

Money is added up as exact decimals and leaves as DOUBLE; every rounding is done on
whole cents (or finer units) with integer arithmetic, so no binary float decides a
tie.
"""

from __future__ import annotations

# Projections of the stored tables, prefixed to the queries that use them.

RIDES = """
rides AS (
  SELECT o.o_orderkey AS ride_id, o.o_orderkey % (SELECT count(*) FROM supplier) AS driver_id, o.o_custkey AS passenger_id,
         s.s_name AS driver_name, c.c_name AS passenger_name,
         pn.n_name AS pickup_city, dn.n_name AS dropoff_city,
         c.c_nationkey AS pickup_location_id, s.s_nationkey AS dropoff_location_id,
         CAST(o.o_totalprice AS DECIMAL(10,2)) AS fare_amount,
         CAST((10 + o.o_orderkey % 440) / 10.0 AS DECIMAL(6,2)) AS ride_distance_km,
         CASE o.o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'cancelled' ELSE 'no_show' END AS ride_status,
         o.o_orderdate + to_minutes(CAST((o.o_orderkey * 37) % 1440 AS INT)) AS requested_at,
         CASE WHEN o.o_orderstatus = 'F'
              THEN o.o_orderdate + to_minutes(CAST((o.o_orderkey * 37) % 1440 + 8 + o.o_orderkey % 83 AS INT)) END AS completed_at,
         CASE WHEN o.o_orderstatus = 'F' AND o.o_orderkey % 5 <> 0
              THEN CAST(1 + 0.5 * (o.o_orderkey % 9) AS DECIMAL(2,1)) END AS rating,
         NULLIF(o.o_orderpriority, '4-NOT SPECIFIED') AS payment_method
  FROM orders o
  LEFT JOIN supplier s ON s.s_suppkey = o.o_orderkey % (SELECT count(*) FROM supplier)
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation pn ON pn.n_nationkey = c.c_nationkey
  LEFT JOIN nation dn ON dn.n_nationkey = s.s_nationkey
)"""

TRIPS = RIDES + """,
trips AS (
  SELECT ride_id AS trip_id, driver_id, passenger_id, pickup_location_id, dropoff_location_id,
         fare_amount, ride_distance_km AS distance_km, ride_status AS status, requested_at, completed_at, rating,
         CAST(substr(payment_method, 1, 1) AS BIGINT) AS payment_method_id
  FROM rides
)"""

FAULTY = TRIPS + """,
faulty AS (
  SELECT trip_id, passenger_id, distance_km, requested_at,
         CASE WHEN trip_id % 97 = 0 THEN 99 ELSE rating END AS rating,
         CASE WHEN trip_id % 79 = 0 THEN -fare_amount ELSE fare_amount END AS fare_amount,
         CASE WHEN trip_id % 89 = 0 THEN -1 ELSE driver_id END AS driver_id,
         CASE WHEN status = 'completed' AND trip_id % 71 = 0 THEN NULL
              WHEN status <> 'completed' AND trip_id % 73 = 0 THEN requested_at
              ELSE completed_at END AS completed_at,
         CASE WHEN trip_id % 101 = 0 THEN NULL WHEN trip_id % 103 = 0 THEN 'pending' ELSE status END AS status
  FROM trips
)"""

MESSY_NAMES = """
messy AS (
  SELECT p_partkey, p_name, p_brand, p_type, p_size,
         CASE p_partkey % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN replace(p_name, ' ', '  ') ELSE ' ' || p_name || ' ' END AS name
  FROM part
)"""


def titled(text: str) -> str:
    """Title case for texts whose words are separated by spaces."""
    return f"array_to_string(list_transform(string_split(lower({text}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def cleaned(text: str) -> str:
    return titled(rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))")


def half_up(units: str, cut: str) -> str:
    """Non-negative whole ``units`` divided by ``cut``, nearest, ties up."""
    return f"((2 * ({units}) + ({cut})) // (2 * ({cut})))"


def half_even(units: str, cut: int) -> str:
    """Non-negative whole ``units`` divided by ``cut``, nearest, ties to even."""
    up = f"({units}) % {cut} * 2 > {cut} OR (({units}) % {cut} * 2 = {cut} AND ({units}) // {cut} % 2 = 1)"
    return f"(({units}) // {cut} + CASE WHEN {up} THEN 1 ELSE 0 END)"


def scaled(units: str, by: int) -> str:
    """Whole units back to a number."""
    return f"CAST({units} AS DOUBLE) / {by}"


def cents(value: str) -> str:
    return f"CAST(({value}) * 100 AS BIGINT)"


def dbl(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


# The priced model counts in cents: base, tip and discount; surge in hundredths.
PRICED = RIDES + f""",
promo_codes AS (
  SELECT CAST(n_nationkey AS BIGINT) AS promo_code_id, 'RIDE-' || n_name AS code,
         CASE WHEN n_nationkey % 2 = 0 THEN 'percent' ELSE 'flat' END AS discount_type,
         CAST(4 * n_nationkey + 5 AS DECIMAL(8,2)) AS discount_value, n_nationkey % 7 <> 0 AS is_active
  FROM nation
),
promised AS (
  SELECT *, {cents('fare_amount')} AS base_c,
         CASE WHEN ride_status = 'completed' AND passenger_id % 5 = 0 THEN passenger_id % 28 END AS promo_code_id
  FROM rides
),
priced AS (
  SELECT ride_id AS trip_id, driver_id, passenger_id,
         CASE WHEN ride_id % 7 <> 0 THEN (ride_id * 13) % ((SELECT count(*) FROM part) + 20) END AS vehicle_id,
         passenger_id % 26 AS pickup_location_id, ride_id % 25 AS dropoff_location_id,
         CASE WHEN ride_status <> 'no_show' THEN CAST(substr(payment_method, 1, 1) AS BIGINT) END AS payment_method_id,
         promo_code_id, base_c,
         CASE WHEN ride_status = 'completed' THEN {half_up('base_c * (ride_id % 26)', '100')} ELSE 0 END AS tip_c,
         CASE WHEN promo_code_id IS NULL THEN 0
              WHEN promo_code_id % 2 = 0 THEN least({half_even('base_c * (4 * promo_code_id + 5)', 100)}, base_c)
              ELSE least((4 * promo_code_id + 5) * 100, base_c) END AS discount_c,
         100 + ride_id % 5 * 25 AS surge_h,
         ride_distance_km AS distance_km, ride_status AS status, requested_at, completed_at,
         rating AS driver_rating,
         CASE WHEN rating IS NOT NULL THEN (10 - ride_id % 9) / 2.0 END AS passenger_rating
  FROM promised
),
fared AS (
  SELECT *, base_c * surge_h + 100 * (tip_c - discount_c) AS fare_4 FROM priced
),
payment_methods AS (
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS payment_method_id, o_orderpriority AS name,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'card' WHEN '2' THEN 'cash' WHEN '3' THEN 'wallet' WHEN '5' THEN 'voucher' END AS type,
         o_orderpriority NOT LIKE '5%' AS is_active
  FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'
),
placed AS (
  SELECT *,
    CASE WHEN driver_id NOT IN (SELECT s_suppkey FROM supplier) THEN 'driver'
         WHEN vehicle_id >= (SELECT count(*) FROM part) THEN 'vehicle'
         WHEN passenger_id NOT IN (SELECT c_custkey FROM customer) THEN 'passenger'
         WHEN pickup_location_id > 24 THEN 'pickup'
         WHEN dropoff_location_id > 24 THEN 'dropoff'
         WHEN payment_method_id NOT IN (SELECT payment_method_id FROM payment_methods) THEN 'payment'
         WHEN promo_code_id > 24 THEN 'promo' END AS lost_key
  FROM fared
),
judged AS (
  SELECT *,
    CASE WHEN requested_at < TIMESTAMP '1995-01-01' OR requested_at >= TIMESTAMP '2001-07-01' THEN 'date' ELSE lost_key END AS reject_reason
  FROM placed
)"""

FACT_FARE_C = half_even("fare_4", 100)
VIEW_FARE_C = half_up("fare_4", "100")


def over(prelude: str, select: str) -> str:
    return f"WITH {prelude.strip()}\n{select.strip()}"


RIDE_LIST = f"""ride_id, driver_name, passenger_name, pickup_city, dropoff_city, {dbl('fare_amount')} AS fare_amount,
  {dbl('ride_distance_km')} AS ride_distance_km, ride_status, requested_at, completed_at, {dbl('rating')} AS rating, payment_method"""

TRIP_LIST = f"""trip_id, driver_id, passenger_id, pickup_location_id, dropoff_location_id, {dbl('fare_amount')} AS fare_amount, {dbl('distance_km')} AS distance_km,
  status, requested_at, completed_at, {dbl('rating')} AS rating, payment_method_id"""

OTHER_TRIP_COLUMNS = f"""trip_id, driver_id, passenger_id, vehicle_id, pickup_location_id, dropoff_location_id, promo_code_id,
  {scaled('base_c', 100)} AS base_fare, {dbl('distance_km')} AS distance_km, status, requested_at, completed_at,
  {dbl('driver_rating')} AS driver_rating, {dbl('passenger_rating')} AS passenger_rating"""


def keyed(select: str) -> str:
    """A dimension's rows with the number of its keys, one a row."""
    return f"SELECT *, count(*) OVER () AS n_keys FROM ({select}) AS members"


DRIVER_COUNTS = """
counted AS (
  SELECT s.s_suppkey AS driver_id, s.s_name AS driver_name, count(t.trip_id) AS total_trips,
         count(t.trip_id) FILTER (WHERE status = 'completed') AS completed_trips,
         count(t.trip_id) FILTER (WHERE status = 'cancelled') AS cancelled_trips,
         CAST(sum(fare_amount * 100) FILTER (WHERE status = 'completed') AS BIGINT) AS fare_c,
         count(fare_amount) FILTER (WHERE status = 'completed') AS fare_n,
         CAST(sum(rating * 10) FILTER (WHERE status = 'completed') AS BIGINT) AS rating_t,
         count(rating) FILTER (WHERE status = 'completed') AS rating_n
  FROM supplier s LEFT JOIN trips t ON t.driver_id = s.s_suppkey
  GROUP BY s.s_suppkey, s.s_name
)"""

ORACLE: dict[str, str] = {
    "total_rides": over(RIDES, "SELECT count(*) AS total_rides FROM rides"),
    "null_rating_count": over(RIDES, "SELECT count(*) AS null_ratings FROM rides WHERE rating IS NULL"),
    "unrated_not_completed": over(RIDES, "SELECT count(*) AS unrated FROM rides WHERE rating IS NULL AND ride_status <> 'completed'"),
    "completed_fare_total": over(RIDES, f"SELECT {dbl('sum(fare_amount)')} AS total_fare FROM rides WHERE ride_status = 'completed'"),
    "global_stats": over(RIDES, f"""
        SELECT count(*) AS rides, {dbl('sum(fare_amount)')} AS sum_fare,
               {scaled(half_up('CAST(sum(fare_amount * 100) AS HUGEINT) * 10000', 'count(*)'), 1000000)} AS avg_fare,
               {dbl('min(ride_distance_km)')} AS min_distance, {dbl('max(ride_distance_km)')} AS max_distance
        FROM rides"""),
    "fare_per_km": over(RIDES, """
        SELECT round(avg(fare_amount / ride_distance_km), 4) AS all_rides,
               round(avg(fare_amount / ride_distance_km) FILTER (WHERE pickup_city = dropoff_city), 4) AS same_city
        FROM rides"""),
    "status_breakdown": over(RIDES, "SELECT ride_status, count(*) AS total FROM rides GROUP BY ride_status"),
    "driver_revenue": over(RIDES, f"SELECT driver_name, count(*) AS rides, {dbl('sum(fare_amount)')} AS revenue FROM rides GROUP BY driver_name"),
    "distance_min_max": over(RIDES, f"""
        SELECT {dbl('ride_distance_km')} AS ride_distance_km, {dbl('min(fare_amount)')} AS min_fare, {dbl('max(fare_amount)')} AS max_fare
        FROM rides GROUP BY ride_distance_km"""),
    "status_profile": over(RIDES, f"""
        SELECT ride_status, count(*) AS rides,
               {scaled(half_up('CAST(sum(ride_distance_km * 100) AS BIGINT)', 'count(*)'), 100)} AS avg_distance,
               {dbl('min(ride_distance_km)')} AS min_distance, {dbl('max(ride_distance_km)')} AS max_distance,
               {scaled(half_up('CAST(sum(fare_amount * 100) AS BIGINT)', 'count(*)'), 100)} AS avg_fare,
               {dbl('min(fare_amount)')} AS min_fare, {dbl('max(fare_amount)')} AS max_fare
        FROM rides WHERE pickup_city = dropoff_city GROUP BY ride_status"""),
    "having_count": over(RIDES, """
        SELECT driver_name, count(*) AS completed_rides FROM rides WHERE ride_status = 'completed'
        GROUP BY driver_name HAVING count(*) > 50"""),
    "high_value": over(RIDES, f"SELECT {RIDE_LIST} FROM rides WHERE fare_amount > 500"),
    "recent_completed": over(RIDES, f"""
        SELECT ride_id, {dbl('fare_amount')} AS fare, requested_at, completed_at FROM rides
        WHERE ride_status = 'completed' ORDER BY requested_at DESC, ride_id DESC LIMIT 10"""),
    "recent_by_completion": over(RIDES, """
        SELECT ride_id, requested_at, completed_at FROM rides WHERE completed_at IS NOT NULL
        ORDER BY completed_at DESC, ride_id DESC LIMIT 10"""),
    "latest_row": over(RIDES, f"""
        SELECT {RIDE_LIST} FROM rides ORDER BY ride_id DESC LIMIT 1"""),
    "same_city": over(RIDES, "SELECT ride_id, pickup_city, ride_status FROM rides WHERE pickup_city = dropoff_city"),
    "same_city_guarded": over(RIDES, """
        SELECT ride_id, pickup_city, ride_status FROM rides
        WHERE pickup_city IS NOT NULL AND dropoff_city IS NOT NULL AND pickup_city = dropoff_city"""),
    "same_city_ci": over(RIDES, """
        SELECT count(*) AS rides FROM rides
        WHERE lower(pickup_city) = lower(dropoff_city) AND ride_distance_km > 0 AND ride_status <> 'cancelled'"""),
    "same_city_unfulfilled": over(RIDES, """
        SELECT count(*) AS rides FROM rides WHERE pickup_city = dropoff_city AND ride_status IN ('cancelled', 'no_show')"""),
    "like_match": over(RIDES, "SELECT ride_id, driver_name, passenger_name FROM rides WHERE driver_name LIKE '%#00000000%'"),
    "distinct_pickup": over(RIDES, "SELECT DISTINCT pickup_city FROM rides"),
    "distinct_pair": over(RIDES, "SELECT DISTINCT driver_name, payment_method FROM rides"),
    "dim_payment_names": over(RIDES, "SELECT DISTINCT payment_method FROM rides WHERE payment_method IS NOT NULL"),
    "clean_names": over(MESSY_NAMES, f"SELECT DISTINCT {cleaned('name')} AS name FROM messy"),
    "count_distinct_clean": over(MESSY_NAMES, f"""
        SELECT count(DISTINCT name) AS spellings, count(DISTINCT {cleaned('name')}) AS names FROM messy"""),
    "scalar_strings": over(MESSY_NAMES, rf"""
        SELECT p_partkey, lower(name) AS lowered, {titled('name')} AS titled, trim(name) AS trimmed,
               replace(name, '  ', ' ') AS halved, regexp_replace(name, '\s+', ' ', 'g') AS squashed,
               split_part(trim(name), ' ', 2) AS second_word, split_part(name, ' ', 9) AS ninth_word,
               concat(p_brand, CASE WHEN p_size > 25 THEN split_part(p_name, ' ', 1) END, p_type) AS joined,
               p_brand || ':' || CASE WHEN p_size > 25 THEN split_part(p_name, ' ', 1) END AS piped,
               lpad(CAST(p_size AS VARCHAR), 4, '0') AS padded
        FROM messy"""),
    "scalar_dates": f"""
        SELECT event_id, ts - INTERVAL 6 MONTH AS half_year_before, ts - INTERVAL 2 YEAR AS two_years_before,
               {scaled(half_up("epoch_us(ts) - epoch_us(date_trunc('day', ts))", '60'), 1000000)} AS minutes_today,
               CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, strftime(ts, '%Y-%m') AS year_month,
               monthname(ts) AS month_name, dayname(ts) AS day_name,
               CAST(year(ts) AS INTEGER) AS year, CAST(quarter(ts) AS INTEGER) AS quarter, CAST(month(ts) AS INTEGER) AS month,
               CAST(weekofyear(ts) AS INTEGER) AS iso_week, CAST(dayofweek(ts) AS INTEGER) AS day_of_week,
               dayofweek(ts) IN (0, 6) AS is_weekend,
               CAST(hour(ts) * 100 + minute(ts) // 15 * 15 AS INTEGER) AS quarter_hour
        FROM events""",
    "scalar_numeric": f"""
        WITH priced AS (SELECT *, {cents('CAST(o_totalprice AS DECIMAL(10,2))')} AS c FROM orders)
        SELECT o_orderkey, {scaled(half_up('c', '2'), 100)} AS half_up, {scaled(half_even('c', 2), 100)} AS half_even,
               {scaled('c * 125 + (o_orderkey % 4 - 1) * 10000', 10000)} AS arithmetic,
               {dbl('o_orderkey % 4 * 25')} AS percent, o_orderkey % 4 = 0 AS divided_by_zero,
               CASE WHEN o_orderstatus <> 'P' THEN {scaled('c', 100)} ELSE 0 END AS or_zero,
               CASE WHEN c > 40000000 THEN 'high' WHEN c > 10000000 THEN 'middle' ELSE 'low' END AS band,
               CAST(c // 100 AS INTEGER) AS whole, CAST(o_orderdate AS DATE) AS day, CAST(o_orderkey AS VARCHAR) AS as_text
        FROM priced""",
    "promo_discount": over(PRICED, f"""
        SELECT trip_id, promo_code_id, {scaled('base_c', 100)} AS base_fare, {scaled('discount_c', 100)} AS discount
        FROM priced JOIN promo_codes USING (promo_code_id)"""),
    "union_distinct": over(RIDES, "SELECT pickup_city AS city_name FROM rides UNION SELECT dropoff_city FROM rides"),
    "union_all": over(RIDES, "SELECT DISTINCT pickup_city AS city FROM rides UNION ALL SELECT DISTINCT dropoff_city FROM rides"),
    "intersect_cities": over(RIDES, """
        SELECT pickup_city AS city FROM rides
        INTERSECT SELECT n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal < 0"""),
    "except_cities": over(RIDES, """
        SELECT pickup_city AS city FROM rides
        EXCEPT SELECT n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal < 0"""),
    "driver_and_status": over(TRIPS, f"SELECT {TRIP_LIST} FROM trips WHERE driver_id = 3 AND status = 'completed'"),
    "driver_trips": over(TRIPS, f"SELECT {TRIP_LIST} FROM trips WHERE driver_id = 3"),
    "status_trips": over(TRIPS, f"SELECT {TRIP_LIST} FROM trips WHERE status = 'cancelled'"),
    "delete_by_predicate": over(TRIPS, f"SELECT {TRIP_LIST} FROM trips WHERE rating IS NULL OR rating <= 3"),
    "case_flag": over(TRIPS, f"""
        SELECT CASE WHEN status = 'completed' THEN 1 END AS is_completed, s_suppkey AS id, s_name AS driver_name, {TRIP_LIST}
        FROM supplier LEFT JOIN trips ON driver_id = s_suppkey"""),
    "join_inner": over(TRIPS, """
        SELECT trip_id, driver_id, s_name AS driver_name, status FROM trips JOIN supplier ON s_suppkey = driver_id"""),
    "tagged_counts": """
        SELECT 'rides' AS tbl, count(*) AS row_count FROM orders UNION ALL SELECT 'trips', count(*) FROM orders
        UNION ALL SELECT 'drivers', count(*) FROM supplier UNION ALL SELECT 'passengers', count(*) FROM customer""",
    "completed_trips_view": over(RIDES, f"""
        SELECT ride_id AS trip_id, driver_name, passenger_name, pickup_city, dropoff_city, {dbl('fare_amount')} AS fare_amount,
               {dbl('ride_distance_km')} AS distance_km, {dbl('rating')} AS rating, payment_method, requested_at, completed_at
        FROM rides WHERE ride_status = 'completed'"""),
    "temp_snapshot": over(RIDES, f"SELECT {RIDE_LIST} FROM rides"),
    "inline_values": over(RIDES, """
        SELECT DISTINCT payment_method AS name, substr(payment_method, 1, 1) AS payment_method_id FROM rides WHERE payment_method IS NOT NULL
        UNION ALL VALUES ('IME pay5', NULL)"""),
    "conditional_update": over(RIDES, """
        SELECT driver_name,
               CASE WHEN driver_name LIKE '%#00000000%' THEN CASE WHEN ride_id > 1000 THEN '9876543210' ELSE '987654321' END END AS phone_number,
               count(*) AS rides
        FROM rides GROUP BY ALL"""),
    "driver_summary": over(TRIPS + "," + DRIVER_COUNTS, f"""
        SELECT driver_id, driver_name, total_trips, completed_trips, cancelled_trips,
               {scaled(half_up('cancelled_trips * 1000', 'total_trips'), 10)} AS cancellation_rate,
               {scaled(half_up('fare_c', 'NULLIF(fare_n, 0)'), 100)} AS avg_fare,
               {scaled(half_up('rating_t', 'NULLIF(rating_n, 0)'), 10)} AS avg_rating
        FROM counted WHERE total_trips > 0"""),
    "driver_cancellation": over(TRIPS + "," + DRIVER_COUNTS, f"""
        SELECT driver_id, driver_name, total_trips, completed_trips, cancelled_trips,
               {scaled(half_up('cancelled_trips * 10000', 'NULLIF(total_trips, 0)'), 100)} AS cancellation_rate
        FROM counted"""),
    "driver_completed_rides": over(TRIPS + "," + DRIVER_COUNTS, "SELECT driver_id, driver_name, completed_trips AS completed_rides FROM counted"),
    "running_fare": over(RIDES, f"""
        SELECT ride_id AS trip_id, driver_name, requested_at, {dbl('fare_amount')} AS fare_amount,
               {dbl('sum(fare_amount) OVER (PARTITION BY driver_id ORDER BY requested_at)')} AS running_total_fare
        FROM rides WHERE ride_status = 'completed'"""),
    "anti_not_in": """
        SELECT c_custkey AS passenger_id, c_name AS name FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
    "anti_left": """
        SELECT c_custkey AS passenger_id, c_name AS name FROM customer
        LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON o_custkey = c_custkey WHERE o_orderkey IS NULL""",
    "scalar_lookup": """
        SELECT o_orderkey AS ride_id, replace(c_name, '#', ' ') AS passenger_name,
               (SELECT c.c_custkey FROM customer c WHERE c.c_name = p.c_name) AS passenger_id
        FROM orders JOIN customer p ON p.c_custkey = o_custkey""",
    "normalize_trips": over(RIDES, f"""
        SELECT ride_id AS trip_id, replace(driver_name, '#', ' ') AS driver_name, replace(passenger_name, '#', ' ') AS passenger_name,
               pickup_city, dropoff_city, payment_method, {dbl('fare_amount')} AS fare_amount,
               {dbl('ride_distance_km')} AS distance_km, ride_status AS status, requested_at, completed_at, {dbl('rating')} AS rating
        FROM rides"""),
    "csv_load": over(RIDES, f"SELECT {RIDE_LIST}, (SELECT count(*) FROM rides) AS rows_loaded FROM rides"),
    "csv_empty_text": """
        SELECT CASE WHEN p_size > 25 THEN TRUE WHEN p_size > 5 THEN FALSE END AS is_empty, count(*) AS parts FROM part GROUP BY 1""",
    "append_select": over(TRIPS, f"""
        SELECT trip_id, driver_id, passenger_id, {dbl('fare_amount')} AS fare_amount, {dbl('distance_km')} AS distance_km,
               status, requested_at, completed_at, {dbl('rating')} AS rating, payment_method_id, count(*) OVER (PARTITION BY status) AS rows_added
        FROM trips WHERE status IN ('completed', 'cancelled')"""),
    "replace_table": over(TRIPS, f"""
        SELECT trip_id, driver_id, passenger_id, {dbl('fare_amount')} AS fare_amount, {dbl('distance_km')} AS distance_km,
               status, requested_at, completed_at, {dbl('rating')} AS rating, payment_method_id
        FROM trips WHERE status = 'completed'"""),
    "delete_set_null": over(PRICED, f"""
        SELECT CASE WHEN payment_method_id NOT IN (SELECT payment_method_id FROM payment_methods WHERE NOT is_active)
                    THEN payment_method_id END AS payment_method_id,
               {scaled('tip_c', 100)} AS tip_amount, {scaled('discount_c', 100)} AS discount_amount, {scaled('surge_h', 100)} AS surge_multiplier,
               {OTHER_TRIP_COLUMNS}
        FROM priced"""),
    "delete_cascade": over(PRICED, """
        SELECT 'trip_cancellations' AS tbl, trip_id AS id, count(*) AS n FROM priced WHERE status = 'cancelled' AND driver_id <> 3 GROUP BY trip_id
        UNION ALL SELECT 'vehicle_assignments', l_suppkey, count(*) FROM lineitem
        WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) GROUP BY l_suppkey"""),
    "defaulted_rows": over(PRICED, f"""
        SELECT payment_method_id, {dbl(0)} AS tip_amount, {dbl(0)} AS discount_amount, {dbl(1)} AS surge_multiplier, {OTHER_TRIP_COLUMNS}
        FROM priced"""),
    "inline_lookup": """
        SELECT line, typed, c_custkey AS passenger_id, NULLIF((SELECT count(*) FROM orders WHERE o_custkey = c_custkey), 0) AS trips
        FROM (VALUES (1, 'Customer#000000001'), (2, 'Customer#000000002'), (3, 'Nobody')) entered(line, typed)
        LEFT JOIN customer ON c_name = typed""",
    "current_moment": over(RIDES, """
        SELECT count(*) FILTER (WHERE requested_at < now()::TIMESTAMP) AS past,
               count(*) FILTER (WHERE requested_at < now()::TIMESTAMP AND requested_at >= now()::TIMESTAMP - INTERVAL 6 MONTH) AS recent
        FROM rides"""),
    "surrogate_keys": "SELECT count(*) AS rows, count(*) AS keys, CAST(0 AS BIGINT) AS clashes FROM orders",
    "dq_not_null": over(FAULTY, """
        SELECT 'driver_id_not_null' AS rule, count(*) AS violations, min(trip_id) AS first_row FROM faulty WHERE driver_id IS NULL
        UNION ALL SELECT 'status_not_null', count(*), min(trip_id) FROM faulty WHERE status IS NULL
        UNION ALL SELECT 'requested_at_not_null', count(*), min(trip_id) FROM faulty WHERE requested_at IS NULL
        UNION ALL SELECT 'completed_at_not_null', count(*), min(trip_id) FROM faulty WHERE completed_at IS NULL"""),
    "dq_ranges": over(FAULTY, """
        SELECT 'fare_amount_above' AS rule, count(*) AS violations, min(trip_id) AS first_row FROM faulty WHERE NOT fare_amount > 0
        UNION ALL SELECT 'distance_km_min', count(*), min(trip_id) FROM faulty WHERE NOT distance_km >= 0.5
        UNION ALL SELECT 'rating_range', count(*), min(trip_id) FROM faulty WHERE NOT rating BETWEEN 1 AND 5"""),
    "dq_enum": over(FAULTY, """
        SELECT 'status_enum' AS rule, count(*) AS violations, min(trip_id) AS first_row
        FROM faulty WHERE status NOT IN ('completed', 'cancelled', 'no_show')"""),
    "dq_completed_at": over(FAULTY, """
        SELECT trip_id, CASE WHEN status = 'completed' AND completed_at IS NULL THEN 'completed_has_time' ELSE 'completed_after_request' END AS failed
        FROM faulty WHERE (status = 'completed' AND completed_at IS NULL) OR completed_at <= requested_at"""),
    "dq_width": """
        SELECT 'p_name_width' AS rule, count(*) AS violations, min(p_partkey) AS first_row FROM part WHERE length(p_name) > 9
        UNION ALL SELECT 'p_retailprice_fits', count(*), min(p_partkey) FROM part WHERE p_retailprice >= 999.995
        UNION ALL SELECT 'p_size_fits', count(*), min(p_partkey) FROM part WHERE p_size > 9""",
    "dq_duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "dq_one_current": "SELECT l_partkey AS vehicle_id, count(*) AS n FROM lineitem WHERE l_linestatus <> 'F' GROUP BY 1 HAVING count(*) > 1",
    "dq_orphans": over(PRICED, """
        SELECT 'vehicle_id' AS foreign_key, vehicle_id AS missing_key, count(*) AS n, min(trip_id) AS first_row
        FROM priced WHERE vehicle_id NOT IN (SELECT p_partkey FROM part) GROUP BY vehicle_id
        UNION ALL SELECT 'pickup_location_id', pickup_location_id, count(*), min(trip_id)
        FROM priced WHERE pickup_location_id NOT IN (SELECT n_nationkey FROM nation) GROUP BY pickup_location_id
        UNION ALL SELECT 'promo_code_id', promo_code_id, count(*), min(trip_id)
        FROM priced WHERE promo_code_id NOT IN (SELECT promo_code_id FROM promo_codes) GROUP BY promo_code_id"""),
    "dq_state_probe": over(FAULTY, """
        SELECT 'status_missing' AS rule, count(*) AS violations, min(trip_id) AS first_row FROM faulty WHERE status IS NULL
        UNION ALL SELECT 'completed_without_time', count(*), min(trip_id) FROM faulty WHERE status = 'completed' AND completed_at IS NULL
        UNION ALL SELECT 'time_without_completed', count(*), min(trip_id) FROM faulty WHERE completed_at IS NOT NULL AND status <> 'completed'"""),
    "batch_gate": over(FAULTY, """
        SELECT 'status_not_null' AS rule, count(*) AS violations, min(trip_id) AS first_row FROM faulty WHERE status IS NULL
        UNION ALL SELECT 'status_enum', count(*), min(trip_id) FROM faulty WHERE status NOT IN ('completed', 'cancelled', 'no_show')
        UNION ALL SELECT 'fare_amount_above', count(*), min(trip_id) FROM faulty WHERE fare_amount <= 0
        UNION ALL SELECT 'rating_range', count(*), min(trip_id) FROM faulty WHERE rating < 1 OR rating > 5
        UNION ALL SELECT 'trip_id_unique', CAST(coalesce(sum(n - 1), 0) AS BIGINT), min(first)
          FROM (SELECT count(*) AS n, min(trip_id) AS first FROM faulty GROUP BY trip_id HAVING count(*) > 1)
        UNION ALL SELECT 'passenger_id_requested_at_unique', CAST(coalesce(sum(n - 1), 0) AS BIGINT), min(first)
          FROM (SELECT count(*) AS n, min(trip_id) AS first FROM faulty GROUP BY passenger_id, requested_at HAVING count(*) > 1)
        UNION ALL SELECT 'driver_id_reference', count(*), min(trip_id) FROM faulty WHERE driver_id NOT IN (SELECT s_suppkey FROM supplier)"""),
    "batch_gate_stored": over(TRIPS, """
        SELECT 'trip_id_unique' AS rule, count(*) AS violations, min(trip_id) AS first_row FROM trips WHERE status = 'completed'
        UNION ALL SELECT 'passenger_id_requested_at_unique', CAST(coalesce(sum(n), 0) AS BIGINT), min(first)
          FROM (SELECT count(*) - 1 + max(CASE WHEN status = 'completed' THEN 1 ELSE 0 END) AS n, min(trip_id) AS first
                FROM trips GROUP BY passenger_id, requested_at) WHERE n > 0"""),
    "dq_declared": over(PRICED, """
        SELECT 'trips' AS tbl, 'vehicle_id_reference' AS rule, count(*) AS violations, min(trip_id) AS first_row
        FROM priced WHERE vehicle_id NOT IN (SELECT p_partkey FROM part) HAVING count(*) > 0
        UNION ALL SELECT 'trips', 'pickup_location_id_reference', count(*), min(trip_id)
        FROM priced WHERE pickup_location_id NOT IN (SELECT n_nationkey FROM nation) HAVING count(*) > 0
        UNION ALL SELECT 'trips', 'promo_code_id_reference', count(*), min(trip_id)
        FROM priced WHERE promo_code_id NOT IN (SELECT n_nationkey FROM nation) HAVING count(*) > 0
        UNION ALL SELECT 'vehicles', 'year_above', count(*), min(p_partkey) FROM part WHERE 1975 + p_size <= 1980 HAVING count(*) > 0"""),
    "insert_if_absent": """
        WITH ranked AS (
          SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity,
                 row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity) AS place
          FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity FROM ranked r
        WHERE place = 1 AND NOT EXISTS (
          SELECT 1 FROM lineitem t WHERE t.l_orderkey = r.l_orderkey AND t.l_linenumber = r.l_linenumber AND t.l_shipdate < TIMESTAMP '1998-01-01')""",
    "dim_driver": """
        WITH joined AS (
          SELECT s_suppkey AS driver_id, s_name AS name,
                 CASE WHEN s_acctbal < 0 THEN 'suspended' WHEN s_acctbal < 1000 THEN 'inactive' ELSE 'active' END AS status,
                 CASE WHEN s_acctbal < 9000 THEN TIMESTAMP '1995-01-01' + to_days(CAST(1400 + s_suppkey * 11 % 1000 AS INT)) END AS joined_at
          FROM supplier)
        SELECT *, CASE WHEN joined_at >= TIMESTAMP '2001-02-01' THEN '0-6 months' WHEN joined_at >= TIMESTAMP '2000-08-01' THEN '6-12 months'
                       WHEN joined_at >= TIMESTAMP '1999-08-01' THEN '1-2 years' ELSE '2+ years' END AS tenure_bucket
        FROM joined""",
    "dim_passenger": """
        WITH created AS (
          SELECT c_custkey AS passenger_id, c_name AS name,
                 CASE WHEN c_mktsegment = 'MACHINERY' THEN 'inactive' WHEN c_acctbal < 0 THEN 'banned' ELSE 'active' END AS status,
                 TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey * 7 % 2000 AS INT)) AS created_at
          FROM customer)
        SELECT *, strftime(created_at, '%Y-%m') AS cohort_month FROM created""",
    "dim_location": f"""
        WITH placed AS (
          SELECT CAST(n_nationkey AS BIGINT) AS location_id, n_name AS city_name,
                 ['New York', 'Ohio', 'Texas', 'California', 'Vermont', 'Iowa', 'Florida', 'Ontario'][n_nationkey % 8 + 1] AS state_province,
                 CASE WHEN n_regionkey < 2 THEN 'USA' WHEN n_regionkey > 2 THEN 'Country ' || n_regionkey END AS country,
                 {dbl('n_nationkey * 1.5 - 20')} AS latitude, {dbl('n_nationkey * 2.25 - 30')} AS longitude
          FROM nation)
        SELECT *, CASE WHEN coalesce(country, 'USA') <> 'USA' OR state_province = 'Ontario' THEN 'International'
                       WHEN state_province IN ('New York', 'Vermont') THEN 'Northeast' WHEN state_province IN ('Ohio', 'Iowa') THEN 'Midwest'
                       WHEN state_province IN ('Texas', 'Florida') THEN 'South' ELSE 'West' END AS region
        FROM placed""",
    "dim_payment_method": over(PRICED, "SELECT * FROM payment_methods"),
    "dim_promo_code": over(PRICED, f"SELECT promo_code_id, code, discount_type, {dbl('discount_value')} AS discount_value, is_active FROM promo_codes"),
    "dim_vehicle": """
        SELECT p_partkey AS vehicle_id, 'PL-' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS plate_number, p_brand AS make, p_name AS model,
               CAST(1975 + p_size AS INTEGER) AS year, split_part(p_name, ' ', 1) AS color,
               CASE p_type WHEN 'ECONOMY' THEN 'economy' WHEN 'STANDARD' THEN 'comfort' WHEN 'LARGE' THEN 'xl' WHEN 'PROMO' THEN 'luxury' END AS category,
               p_retailprice > 910 AS is_active
        FROM part""",
    "dim_date": """
        WITH days AS (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS year,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
               CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(dayofweek(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
               dayofweek(d) IN (0, 6) AS is_weekend
        FROM days""",
    "dim_time": """
        WITH clock AS (SELECT h, m FROM range(24) hours(h), range(0, 60, 15) quarters(m)),
        seen AS (SELECT hour(ts) AS h, minute(ts) // 15 * 15 AS m, count(*) AS events FROM events GROUP BY ALL)
        SELECT CAST(h * 100 + m AS INTEGER) AS time_key, CAST(h AS INTEGER) AS hour, CAST(m AS INTEGER) AS minute_bucket,
               printf('%02d:%02d', h, m) AS time_label,
               CASE WHEN h < 6 OR h > 20 THEN 'Night' WHEN h < 12 THEN 'Morning' WHEN h < 17 THEN 'Afternoon' ELSE 'Evening' END AS time_of_day,
               h IN (7, 8, 17, 18, 19) AS is_rush_hour, coalesce(events, 0) AS events
        FROM clock LEFT JOIN seen USING (h, m)""",
    "fact_key_resolution": over(PRICED, "SELECT coalesce(reject_reason, 'accepted') AS outcome, count(*) AS trips FROM judged GROUP BY 1"),
    "fact_trips": over(PRICED, f"""
        SELECT trip_id AS source_trip_id, CAST(strftime(requested_at, '%Y%m%d') AS INTEGER) AS date_key,
               CAST(hour(requested_at) * 100 + minute(requested_at) // 15 * 15 AS INTEGER) AS time_key,
               driver_id AS driver_key, passenger_id AS passenger_key, vehicle_id AS vehicle_key,
               pickup_location_id AS pickup_location_key, dropoff_location_id AS dropoff_location_key,
               payment_method_id AS payment_method_key, promo_code_id AS promo_code_key,
               {scaled('base_c', 100)} AS base_fare, {scaled('tip_c', 100)} AS tip_amount, {scaled('discount_c', 100)} AS discount_amount,
               {scaled(FACT_FARE_C, 100)} AS fare_amount, {dbl('distance_km')} AS distance_km,
               {dbl("date_diff('minute', requested_at, completed_at)")} AS duration_minutes, CAST(1 AS INTEGER) AS trip_count,
               {dbl('driver_rating')} AS driver_rating, {dbl('passenger_rating')} AS passenger_rating,
               {scaled('surge_h', 100)} AS surge_multiplier, requested_at
        FROM judged WHERE reject_reason IS NULL"""),
    "v_trips": over(PRICED, f"""
        SELECT trip_id, driver_id, passenger_id, vehicle_id, pickup_location_id, dropoff_location_id, payment_method_id, promo_code_id,
               {scaled('base_c', 100)} AS base_fare, {scaled('tip_c', 100)} AS tip_amount, {scaled('discount_c', 100)} AS discount_amount,
               {scaled('surge_h', 100)} AS surge_multiplier, {dbl('distance_km')} AS distance_km, status, requested_at, completed_at,
               {dbl('driver_rating')} AS driver_rating, {dbl('passenger_rating')} AS passenger_rating,
               {scaled(VIEW_FARE_C, 100)} AS fare_amount, {dbl("date_diff('minute', requested_at, completed_at)")} AS duration_minutes,
               CASE WHEN status = 'cancelled' THEN requested_at + to_minutes(CAST(1 + trip_id % 15 AS INT)) END AS cancelled_at,
               CASE WHEN status = 'cancelled' THEN ['driver', 'passenger', 'system'][trip_id % 3 + 1] END AS cancelled_by,
               CASE WHEN status = 'cancelled' AND trip_id % 4 <> 0 THEN 'reason ' || trip_id % 4 END AS cancellation_reason
        FROM fared"""),
    "promo_usage": over(PRICED, f"""
        SELECT p.promo_code_id, code, discount_type, {dbl('discount_value')} AS discount_value, is_active, count(trip_id) AS times_used
        FROM promo_codes p LEFT JOIN priced t ON t.promo_code_id = p.promo_code_id GROUP BY ALL"""),
    "watermark": over(PRICED, """
        SELECT 'loaded' AS warehouse, max(requested_at) AS watermark FROM judged WHERE reject_reason IS NULL UNION ALL SELECT 'empty', NULL"""),
    "incremental_slice": over(PRICED, f"""
        SELECT trip_id AS source_trip_id, requested_at, CAST(strftime(requested_at, '%Y%m%d') AS INTEGER) AS date_key,
               {scaled(FACT_FARE_C, 100)} AS fare_amount
        FROM judged WHERE reject_reason IS NULL AND requested_at >= TIMESTAMP '2000-01-01'"""),
    "reloaded_facts": over(PRICED, f"""
        , moved AS (
          SELECT *, CASE WHEN trip_id % 5 = 0 THEN requested_at + INTERVAL 40 DAY WHEN trip_id % 7 = 0 THEN requested_at - INTERVAL 365 DAY
                         ELSE requested_at END AS later
          FROM judged),
        fed AS (
          SELECT trip_id, fare_4, requested_at AS moment, 1 AS feed FROM moved WHERE trip_id % 3 <> 0 AND reject_reason IS NULL
          UNION ALL SELECT trip_id, fare_4, later, 2 FROM moved
          WHERE lost_key IS NULL AND later >= TIMESTAMP '1995-01-01' AND later < TIMESTAMP '2001-07-01'),
        earliest AS (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY feed) AS place FROM fed)
        SELECT trip_id AS source_trip_id, moment AS requested_at, CAST(strftime(moment, '%Y%m%d') AS INTEGER) AS date_key,
               {scaled(FACT_FARE_C, 100)} AS fare_amount
        FROM earliest WHERE place = 1"""),
    "crash_between_tables": over(TRIPS, """
        SELECT 'drivers' AS tbl, CAST(0 AS INTEGER) AS half, count(*) AS n FROM supplier WHERE s_suppkey % 2 = 0 HAVING count(*) > 0
        UNION ALL SELECT 'trips', CAST(0 AS INTEGER), count(*) FROM trips WHERE driver_id % 2 = 0 HAVING count(*) > 0"""),
    "revenue_city_month": over(PRICED, f"""
        SELECT n_name AS city_name, CAST(year(requested_at) AS INTEGER) AS year, CAST(month(requested_at) AS INTEGER) AS month,
               {scaled(f'sum({FACT_FARE_C})', 100)} AS total_revenue
        FROM judged JOIN nation ON n_nationkey = pickup_location_id WHERE reject_reason IS NULL GROUP BY ALL"""),
    "revenue_city_month_oltp": over(PRICED, f"""
        SELECT n_name AS city_name, CAST(year(requested_at) AS INTEGER) AS year, CAST(month(requested_at) AS INTEGER) AS month,
               {scaled(f'sum({VIEW_FARE_C})', 100)} AS total_revenue
        FROM fared JOIN nation ON n_nationkey = pickup_location_id GROUP BY ALL"""),
    "revenue_by_method": over(PRICED, f"""
        SELECT name AS payment_method, {scaled(f'sum({FACT_FARE_C})', 100)} AS total_revenue
        FROM judged JOIN payment_methods USING (payment_method_id) WHERE reject_reason IS NULL GROUP BY name"""),
    "avg_fare_method_month": over(PRICED, f"""
        SELECT name AS payment_method, CAST(year(requested_at) AS INTEGER) AS year, CAST(month(requested_at) AS INTEGER) AS month,
               {scaled(half_up(f'CAST(sum({FACT_FARE_C}) AS BIGINT)', 'count(*)'), 100)} AS avg_fare
        FROM judged JOIN payment_methods USING (payment_method_id) WHERE reject_reason IS NULL GROUP BY ALL"""),
    "busiest_hour": over(PRICED, f"""
        SELECT CAST(hour(requested_at) AS INTEGER) AS hour, count(*) AS trip_count,
               {scaled(half_up('count(*) * 10000', 'CAST(sum(count(*)) OVER () AS BIGINT)'), 100)} AS pct_of_all_trips
        FROM judged WHERE reject_reason IS NULL GROUP BY 1"""),
}

for _name in ("dim_driver", "dim_passenger", "dim_location", "dim_payment_method", "dim_promo_code", "dim_vehicle"):
    ORACLE[_name] = keyed(ORACLE[_name])
