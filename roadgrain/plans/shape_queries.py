"""Registered queries: projections, filters, the calendar joins, the split, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadgrain import schemas as S
from roadgrain.functions import derive as D, text as X
from roadgrain.operators import shape
from roadgrain.operators.advisory import add_context_notes
from roadgrain.operators.calendar import day_category, integrate_calendar, neighbour_holidays
from roadgrain.operators.split import chronological_split, cutoff_date, split_at
from roadgrain.plans.registry import (
    CALENDAR_SQL,
    NOTES_SQL,
    over_observations,
    query,
    r4,
    rounded,
    sql_class,
    sql_r4,
)
from roadgrain.sources.given import calendar, observations, raw_observations, table


@query(
    "P1_standard_projection",
    over_observations(f"SELECT obs_id, {', '.join(S.STANDARD_SCHEMA.names)} FROM obs"),
)
def standard_projection(spark, sf_dir):
    return shape.standardise(raw_observations(spark, sf_dir), keep=["obs_id"])


_EDGE_LEVEL_SQL = (
    "CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN 'NaN'::DOUBLE "
    "WHEN o_orderkey % 107 = 0 THEN 60e0 WHEN o_orderkey % 109 = 0 THEN 90e0 ELSE o_totalprice / 5000e0 END"
)


@query(
    "P2_threshold_class",
    f"SELECT o_orderkey AS obs_id, {sql_class('lvl')} AS congestion_class "
    f"FROM (SELECT o_orderkey, {_EDGE_LEVEL_SQL} AS lvl FROM orders)",
)
def threshold_class(spark, sf_dir):
    key = F.col("o_orderkey")
    level = (
        F.when(key % 101 == 0, F.lit(None))
        .when(key % 103 == 0, F.lit(float("nan")))
        .when(key % 107 == 0, F.lit(60.0))
        .when(key % 109 == 0, F.lit(90.0))
        .otherwise(F.col("o_totalprice") / 5000.0)
    )
    return table(spark, sf_dir, "orders").select(
        key.alias("obs_id"), D.threshold_class(level).alias("congestion_class")
    )


@query("P3_day_of_week", over_observations("SELECT obs_id, day_of_week FROM obs"))
def day_of_week(spark, sf_dir):
    return observations(spark, sf_dir, "obs_id", "day_of_week")


@query(
    "P4_day_type",
    "SELECT o_orderkey AS obs_id, CASE WHEN o_orderkey % 13 = 0 THEN NULL "
    "WHEN dayofweek(o_orderdate) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type FROM orders",
)
def day_type(spark, sf_dir):
    date = F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderdate").cast("date"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("obs_id"), D.day_type(F.dayofweek(date)).alias("day_type")
    )


@query(
    "P5_corridor_name",
    "SELECT c_custkey AS custkey, r_name || ' | ' || CASE WHEN c_custkey % 7 <> 0 THEN n_name END AS corridor "
    "FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey",
)
def corridor_name(spark, sf_dir):
    named = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.col("c_custkey").alias("custkey"),
            F.col("r_name").alias("area"),
            F.when(F.col("c_custkey") % 7 != 0, F.col("n_name")).alias("road_intersection"),
        )
    )
    return shape.add_corridor(named).select("custkey", "corridor")


@query(
    "P6_missing_flags_are_false",
    over_observations(
        "SELECT festival_flag, holiday_flag, festival_name, count(*) AS row_count FROM obs GROUP BY ALL"
    ),
)
def missing_flags_are_false(spark, sf_dir):
    data = observations(spark, sf_dir, "festival_flag", "holiday_flag", "festival_name")
    return data.groupBy(*data.columns).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "P7_festival_rows",
    over_observations("SELECT obs_id, date, festival_name FROM obs WHERE festival_flag = true"),
)
def festival_rows(spark, sf_dir):
    data = observations(spark, sf_dir, "obs_id", "date", "festival_name", "festival_flag")
    return data.where("festival_flag").drop("festival_flag")


CUTOFF_SQL = (
    "dates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders), "
    "ranked AS (SELECT date, row_number() OVER (ORDER BY date) AS k, count(*) OVER () AS n FROM dates), "
    "cut AS (SELECT date AS cutoff_date, n, k FROM ranked "
    "WHERE k = greatest(1, least(n - 1, CAST(floor(n * 0.8e0) AS BIGINT))))"
)


@query(
    "P8_chronological_cutoff",
    f"WITH {CUTOFF_SQL} SELECT cutoff_date, CAST(n AS INTEGER) AS date_count, CAST(k AS INTEGER) AS training_dates FROM cut",
)
def chronological_cutoff(spark, sf_dir):
    return cutoff_date(observations(spark, sf_dir, "date"))


@query(
    "P8_chronological_split",
    f"WITH {CUTOFF_SQL} SELECT o_orderkey AS obs_id, CASE WHEN CAST(o_orderdate AS DATE) <= cutoff_date "
    "THEN 'training' ELSE 'testing' END AS part FROM orders, cut",
)
def chronological_parts(spark, sf_dir):
    training, testing, _ = chronological_split(observations(spark, sf_dir, "obs_id", "date"))
    return training.select("obs_id", F.lit("training").alias("part")).unionByName(
        testing.select("obs_id", F.lit("testing").alias("part"))
    )


@query(
    "P9_split_at_cutoff",
    "SELECT CASE WHEN CAST(o_orderdate AS DATE) <= DATE '1999-06-30' THEN 'training' ELSE 'testing' END AS part, "
    "count(*) AS row_count, min(CAST(o_orderdate AS DATE)) AS first_date, max(CAST(o_orderdate AS DATE)) AS last_date "
    "FROM orders GROUP BY ALL",
)
def split_at_cutoff(spark, sf_dir):
    parts = zip(("training", "testing"), split_at(observations(spark, sf_dir, "date"), "1999-06-30"))
    summaries = [
        rows.groupBy(F.lit(name).alias("part")).agg(
            F.count(F.lit(1)).alias("row_count"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
        )
        for name, rows in parts
    ]
    return summaries[0].unionByName(summaries[1])


@query(
    "P10_page_filters",
    over_observations(
        "SELECT obs_id, date, corridor, congestion_class FROM obs WHERE date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' "
        "AND corridor IN ('ASIA | NATION_2', 'AFRICA | NATION_0', 'EUROPE | NATION_3') "
        "AND congestion_class IN ('Medium', 'High') AND day_type IN ('Weekday') AND festival_flag = false"
    ),
)
def page_filters(spark, sf_dir):
    """The date bounds are also given to the view, which applies them on the stored column."""
    columns = ["obs_id", "date", "corridor", S.TARGET, "day_type", "festival_flag", "holiday_flag"]
    data = observations(spark, sf_dir, *columns, since="1996-01-01", before="2000-01-01")
    return shape.filtered(
        data,
        date_range=("1996-01-01", "1999-12-31"),
        corridors=["ASIA | NATION_2", "AFRICA | NATION_0", "EUROPE | NATION_3"],
        classes=["Medium", "High"],
        day_types=["Weekday"],
        festival_flag="False",
    ).select(*columns[:4])


@query(
    "P11_scenario_filter",
    over_observations(
        "SELECT obs_id, corridor, weather FROM obs WHERE weather = 'Fog' AND roadwork = 'No' "
        "AND day_type = 'Weekend' AND holiday_flag = false"
    ),
)
def scenario_filter(spark, sf_dir):
    data = observations(spark, sf_dir, "obs_id", "corridor", "weather", "roadwork", "day_type", "holiday_flag")
    return shape.filter_scenario(
        data, weather="Fog", roadwork="No", day_type="Weekend", holiday="Non-Holiday"
    ).select("obs_id", "corridor", "weather")


@query(
    "P12_exact_lookup",
    over_observations(
        f"SELECT corridor, count(*) AS record_count, {sql_r4('avg(congestion_level)')} AS average_congestion_level "
        "FROM obs WHERE corridor = 'ASIA | NATION_7' GROUP BY corridor"
    ),
)
def exact_lookup(spark, sf_dir):
    """The key filter sits below the aggregate, so only the wanted corridor is summarised."""
    data = shape.lookup(observations(spark, sf_dir, "corridor", "congestion_level"), "corridor", "ASIA | NATION_7")
    return rounded(
        data.groupBy("corridor").agg(
            F.count(F.lit(1)).alias("record_count"), F.avg("congestion_level").alias("average_congestion_level")
        )
    )


@query(
    "P13_display_labels",
    over_observations(
        "SELECT CASE WHEN festival_flag THEN 'Festival' ELSE 'Non-Festival' END AS festival_label, "
        "CASE weather WHEN 'Rain' THEN 'Wet' WHEN 'Clear' THEN 'Dry' END AS weather_label, count(*) AS row_count "
        "FROM obs GROUP BY ALL"
    ),
)
def display_labels(spark, sf_dir):
    data = observations(spark, sf_dir, "festival_flag", "weather")
    return data.groupBy(
        shape.display_label(F.col("festival_flag"), {True: "Festival", False: "Non-Festival"}).alias("festival_label"),
        shape.display_label(F.col("weather"), {"Rain": "Wet", "Clear": "Dry"}).alias("weather_label"),
    ).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "P14_different_endpoints",
    """WITH r AS (SELECT o_orderkey AS request_id,
         CASE o_orderkey % 6 WHEN 0 THEN '  ' ELSE ' Place ' || (o_custkey % 5) END AS origin,
         CASE o_orderkey % 6 WHEN 1 THEN NULL WHEN 2 THEN 'PLACE ' || (o_custkey % 5) ELSE 'Stop ' || (o_custkey % 5) END
           AS destination,
         CASE WHEN o_custkey % 3 > 0 THEN 10e0 + o_custkey % 4 END AS a, 10e0 + o_orderkey % 4 AS b FROM orders)
       SELECT request_id, CASE WHEN trim(coalesce(origin, '')) = '' THEN 'EMPTY_ORIGIN'
         WHEN trim(coalesce(destination, '')) = '' THEN 'EMPTY_DESTINATION'
         WHEN lower(trim(origin)) = lower(trim(destination)) THEN 'SAME_PLACE'
         WHEN a = b THEN 'SAME_PLACE' END AS problem FROM r""",
)
def different_endpoints(spark, sf_dir):
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    number = (customer % 5).cast("string")
    origin = F.when(key % 6 == 0, "  ").otherwise(F.concat(F.lit(" Place "), number))
    destination = (
        F.when(key % 6 == 1, F.lit(None))
        .when(key % 6 == 2, F.concat(F.lit("PLACE "), number))
        .otherwise(F.concat(F.lit("Stop "), number))
    )
    a = F.when(customer % 3 > 0, F.lit(10.0) + customer % 4)
    b = F.lit(10.0) + key % 4
    return table(spark, sf_dir, "orders").select(
        key.alias("request_id"), shape.endpoint_problem(origin, destination, (a, a), (b, b)).alias("problem")
    )


@query(
    "P15_coordinate_rules",
    """WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 13 = 0 THEN 'NaN'::DOUBLE ELSE l_partkey % 200 - 100e0 END AS lat,
         CASE WHEN l_suppkey % 9 = 0 THEN NULL WHEN l_suppkey % 10 = 1 THEN 'inf'::DOUBLE ELSE l_suppkey * 4 - 190e0 END AS lon
         FROM lineitem),
       q AS (SELECT CASE WHEN lat IS NULL AND lon IS NULL THEN NULL WHEN lat IS NULL OR lon IS NULL THEN 'INCOMPLETE'
         WHEN isnan(lat) OR isinf(lat) OR isnan(lon) OR isinf(lon) THEN 'NOT_FINITE'
         WHEN NOT (lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180) THEN 'OUT_OF_RANGE' END AS problem,
         l_partkey % 200 AS lat_group FROM p)
       SELECT lat_group, problem, count(*) AS row_count FROM q GROUP BY ALL""",
)
def coordinate_rules(spark, sf_dir):
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    lat = (
        F.when(part % 11 == 0, F.lit(None)).when(part % 13 == 0, F.lit(float("nan"))).otherwise(part % 200 - F.lit(100.0))
    )
    lon = (
        F.when(supplier % 9 == 0, F.lit(None))
        .when(supplier % 10 == 1, F.lit(float("inf")))
        .otherwise(supplier * 4 - F.lit(190.0))
    )
    points = table(spark, sf_dir, "lineitem").select((part % 200).alias("lat_group"), lat.alias("lat"), lon.alias("lon"))
    return points.groupBy("lat_group", shape.coordinate_problem(F.col("lat"), F.col("lon")).alias("problem")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


# ------------------------------------------------------------------ calendar joins
@query(
    "J1_calendar_left_join",
    over_observations("SELECT obs_id, date, festival_flag, festival_name, holiday_flag FROM obs"),
)
def calendar_left_join(spark, sf_dir):
    return integrate_calendar(observations(spark, sf_dir, "obs_id", "date"), calendar(spark, sf_dir))


_NEIGHBOUR_SQL = (
    f"WITH {CALENDAR_SQL}, d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders), "
    "n AS (SELECT d.date, EXISTS (SELECT 1 FROM cal WHERE holiday_flag AND cal.date = d.date + 1) AS next_is_holiday, "
    "EXISTS (SELECT 1 FROM cal WHERE holiday_flag AND cal.date = d.date - 1) AS previous_is_holiday, "
    "EXISTS (SELECT 1 FROM cal WHERE festival_flag AND cal.date = d.date) AS is_festival FROM d) "
)


@query("J3_neighbour_holidays", _NEIGHBOUR_SQL + "SELECT date, next_is_holiday, previous_is_holiday FROM n")
def neighbours(spark, sf_dir):
    days = observations(spark, sf_dir, "date").distinct()
    return neighbour_holidays(days, calendar(spark, sf_dir).where("holiday_flag"))


@query(
    "C8_day_category",
    _NEIGHBOUR_SQL + "SELECT date, CASE WHEN is_festival THEN 'Festival Day' WHEN next_is_holiday THEN 'Pre-Holiday' "
    "WHEN previous_is_holiday THEN 'Post-Holiday' WHEN dayofweek(date) = 5 THEN 'Friday Evening' ELSE 'Normal Day' END "
    "AS day_type FROM n",
)
def day_categories(spark, sf_dir):
    days = observations(spark, sf_dir, "date", "festival_flag").distinct()
    marked = neighbour_holidays(
        days.withColumnRenamed("festival_flag", "is_festival"), calendar(spark, sf_dir).where("holiday_flag")
    )
    return day_category(marked).select("date", "day_type")


# --------------------------------------------------------------- scalar functions
@query(
    "C1_iso_date",
    """WITH t AS (SELECT o_orderkey AS obs_id, CASE o_orderkey % 5 WHEN 0 THEN '1999-02-30' WHEN 1 THEN 'soon'
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS cell FROM orders)
       SELECT obs_id, TRY_CAST(cell AS DATE) AS date FROM t""",
)
def iso_date(spark, sf_dir):
    cell = (
        F.when(F.col("o_orderkey") % 5 == 0, "1999-02-30")
        .when(F.col("o_orderkey") % 5 == 1, "soon")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("obs_id"), D.parse_date(cell).alias("date"))


@query(
    "C2_joined_notes",
    over_observations(f"SELECT {NOTES_SQL} AS context_notes, count(*) AS row_count FROM obs GROUP BY ALL"),
)
def joined_notes(spark, sf_dir):
    data = observations(spark, sf_dir, "festival_flag", "holiday_flag", "roadwork", "weather")
    return add_context_notes(data).groupBy("context_notes").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "C3_substring_test",
    "SELECT p_partkey AS partkey, contains(p_name, 'ring') AS is_ring, contains(p_name, 'hot') AS is_hot FROM part",
)
def substring_test(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("partkey"),
        F.col("p_name").contains("ring").alias("is_ring"),
        F.col("p_name").contains("hot").alias("is_hot"),
    )


@query(
    "C4_null_handling",
    """SELECT o_orderstatus AS status, coalesce(CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END, 'none') AS priority,
         count(*) AS row_count, count(*) FILTER (CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END IS NULL) AS null_count,
         sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END)::BIGINT AS urgent_count
       FROM orders GROUP BY ALL""",
)
def null_handling(spark, sf_dir):
    some = F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderpriority"))
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderstatus").alias("status"), F.coalesce(some, F.lit("none")).alias("priority"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(some.isNull()).alias("null_count"),
            F.count_if(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("urgent_count"),
        )
    )


@query(
    "C5_percentage",
    "SELECT o_orderpriority AS priority, "
    f"{sql_r4('100e0 * count(*) FILTER (o_totalprice > 300000) / nullif(count(*), 0)')} AS share, "
    f"{sql_r4('100e0 * count(*) FILTER (o_totalprice > 300000) / nullif(count(*) FILTER (o_totalprice < 0), 0)')} AS share_of_none "
    "FROM orders GROUP BY ALL",
)
def percentage(spark, sf_dir):
    large = F.count_if(F.col("o_totalprice") > 300000)
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("priority"))
        .agg(
            r4(D.percentage(large, F.count(F.lit(1)))).alias("share"),
            r4(D.percentage(large, F.count_if(F.col("o_totalprice") < 0))).alias("share_of_none"),
        )
    )


def sql_duration(seconds: str) -> str:
    m = f"greatest(1, CAST(round_even({seconds} / 60e0, 0) AS BIGINT))"
    return (
        f"CASE WHEN {seconds} <= 0 THEN '0 min' WHEN {m} < 60 THEN {m} || ' min' "
        f"WHEN {m} % 60 = 0 THEN ({m} // 60) || ' hr' ELSE ({m} // 60) || ' hr ' || ({m} % 60) || ' min' END"
    )


@query(
    "C6_duration_text",
    "WITH t AS (SELECT CASE WHEN l_partkey % 50 = 0 THEN 0e0 ELSE l_quantity * l_linenumber * 15e0 END AS s FROM lineitem) "
    f"SELECT s AS seconds, {sql_duration('s')} AS duration, count(*) AS row_count FROM t GROUP BY ALL",
)
def duration_text(spark, sf_dir):
    seconds = F.when(F.col("l_partkey") % 50 == 0, F.lit(0.0)).otherwise(F.col("l_quantity") * F.col("l_linenumber") * 15.0)
    return (
        table(spark, sf_dir, "lineitem")
        .select(seconds.alias("seconds"))
        .groupBy("seconds", D.duration_text(F.col("seconds")).alias("duration"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query(
    "C7_kilometres_and_minutes",
    "SELECT CAST(round_even(round_even(l_extendedprice * 1.37e0 / 1000e0, 1) * 10, 0) AS BIGINT) AS km_tenths, "
    "CAST(round_even(round_even((l_quantity * 45e0 + 7) / 60e0, 2) * 100, 0) AS BIGINT) AS minute_hundredths, "
    "count(*) AS row_count FROM lineitem GROUP BY ALL",
)
def kilometres_and_minutes(spark, sf_dir):
    km = D.kilometres(F.col("l_extendedprice") * 1.37)
    minutes = D.minutes_2dp(F.col("l_quantity") * 45.0 + 7)
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.bround(km * 10, 0).cast("bigint").alias("km_tenths"),
            F.bround(minutes * 100, 0).cast("bigint").alias("minute_hundredths"),
        )
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query(
    "C9_load_ratio_class",
    """SELECT load_class, count(*) AS row_count FROM (SELECT CASE WHEN r >= 0.9e0 THEN 'Severe' WHEN r >= 0.7e0 THEN 'High'
         WHEN r >= 0.45e0 THEN 'Moderate' ELSE 'Low' END AS load_class
         FROM (SELECT l_quantity / (40e0 + l_linenumber) AS r FROM lineitem)) GROUP BY ALL""",
)
def load_ratio_class(spark, sf_dir):
    load = D.load_ratio_class(F.col("l_quantity"), F.lit(40.0) + F.col("l_linenumber"))
    return (
        table(spark, sf_dir, "lineitem").groupBy(load.alias("load_class")).agg(F.count(F.lit(1)).alias("row_count"))
    )


_NAME_SQL = "p_brand || ' -- ' || upper(p_name) || '!! (' || p_type || '), ' || p_partkey"


def _odd_name():
    return F.concat(
        F.col("p_brand"), F.lit(" -- "), F.upper("p_name"), F.lit("!! ("), F.col("p_type"), F.lit("), "), F.col("p_partkey")
    )


@query(
    "C10_normal_name",
    f"SELECT p_partkey AS partkey, trim(regexp_replace(lower({_NAME_SQL}), '[^a-z0-9]+', ' ', 'g')) AS name FROM part",
)
def normal_name(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), X.normal_name(_odd_name()).alias("name"))


@query(
    "C11_primary_place_name",
    f"SELECT p_partkey AS partkey, lower(trim(regexp_replace(split_part({_NAME_SQL}, ',', 1), '\\s*\\([^)]*\\)', '', 'g'))) "
    "AS name FROM part",
)
def primary_place_name(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("partkey"), X.primary_place_name(_odd_name()).alias("name")
    )


_QUERY_SQL = (
    "CASE conv_id % 4 WHEN 0 THEN regexp_replace(text, '[a-z]', '', 'g') "
    "WHEN 1 THEN regexp_replace(text, '\\p{L}', '', 'g') ELSE text END"
)


@query(
    "C12_meaningful_query",
    f"SELECT conv_id, turn, length(regexp_replace({_QUERY_SQL}, '[^\\p{{L}}\\p{{N}}]', '', 'g')) >= 3 AS is_meaningful "
    "FROM conversations",
)
def meaningful_query(spark, sf_dir):
    turn = F.col("text")
    search = (
        F.when(F.col("conv_id") % 4 == 0, F.regexp_replace(turn, "[a-z]", ""))
        .when(F.col("conv_id") % 4 == 1, F.regexp_replace(turn, r"\p{L}", ""))
        .otherwise(turn)
    )
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", X.is_meaningful_query(search).alias("is_meaningful")
    )


@query(
    "C13_localised_query",
    "SELECT p_partkey AS partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name || ', BANGALORE' "
    "WHEN p_partkey % 3 = 1 THEN 'Bengaluru ' || p_name ELSE p_name || ', Bengaluru, Karnataka, India' END AS search FROM part",
)
def localised_query(spark, sf_dir):
    name, key = F.col("p_name"), F.col("p_partkey")
    search = (
        F.when(key % 3 == 0, F.concat(name, F.lit(", BANGALORE")))
        .when(key % 3 == 1, F.concat(F.lit("Bengaluru "), name))
        .otherwise(name)
    )
    return table(spark, sf_dir, "part").select(
        key.alias("partkey"), X.localised_query(search, S.CITY_SPELLINGS, S.CITY_SUFFIX).alias("search")
    )


_DELAY_SQL = f"""WITH d AS (SELECT o_orderkey AS obs_id,
    CASE WHEN o_orderkey % 41 = 0 THEN -1e0 WHEN o_orderkey % 43 = 0 THEN 0.2e0 WHEN o_orderkey % 47 = 0 THEN 'NaN'::DOUBLE
      ELSE o_totalprice / 7001e0 END AS m,
    CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE 5e0 END AS km,
    CASE WHEN o_orderkey % 59 = 0 THEN 'Unknown' ELSE {sql_class("(o_totalprice / 5000e0)")} END AS c FROM orders),
  e AS (SELECT *, CASE c WHEN 'Low' THEN 1.1e0 WHEN 'Medium' THEN 1.5e0 WHEN 'High' THEN 2.1e0 END AS f FROM d),
  v AS (SELECT *, coalesce(NOT isnan(m) AND m >= 0 AND km >= 0 AND f IS NOT NULL, false) AS ok FROM e),
  w AS (SELECT obs_id, CASE WHEN ok THEN CAST(floor(m + 0.5e0) AS BIGINT) END AS standard_minutes,
    CASE WHEN ok THEN CAST(floor(m * f + 0.5e0) AS BIGINT) END AS adjusted_minutes FROM v)
  SELECT obs_id, standard_minutes IS NOT NULL AS is_valid, coalesce(standard_minutes, -1) AS standard_minutes,
    coalesce(adjusted_minutes, -1) AS adjusted_minutes, CASE WHEN standard_minutes > 0
    THEN CAST(floor((adjusted_minutes - standard_minutes) / standard_minutes::DOUBLE * 100e0 + 0.5e0) AS BIGINT)
    WHEN standard_minutes = 0 THEN 0 ELSE -1 END AS delay_percent FROM w"""


@query("C14_illustrative_delay", _DELAY_SQL)
def illustrative_delay(spark, sf_dir):
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    minutes = (
        F.when(key % 41 == 0, F.lit(-1.0))
        .when(key % 43 == 0, F.lit(0.2))
        .when(key % 47 == 0, F.lit(float("nan")))
        .otherwise(price / 7001.0)
    )
    km = F.when(key % 53 != 0, F.lit(5.0))
    class_ = F.when(key % 59 == 0, "Unknown").otherwise(D.threshold_class(price / 5000.0))
    delayed = table(spark, sf_dir, "orders").select(
        key.alias("obs_id"), D.illustrative_delay(minutes, km, class_).alias("delay")
    )
    numbers = ["standard_minutes", "adjusted_minutes", "delay_percent"]
    return delayed.select(
        "obs_id",
        F.col("delay").isNotNull().alias("is_valid"),
        *[F.coalesce(F.col(f"delay.{name}"), F.lit(-1)).alias(name) for name in numbers],
    )


_ERROR_TEXTS = [
    "Request timed out after 15s.",
    "Location 'X' could not be resolved",
    "No drivable routes were found",
    "Gateway TIMEOUT",
    "service returned HTTP 500",
    "NoRoute - impossible",
]


@query(
    "C15_provider_errors",
    "WITH t AS (SELECT event_id, lower(CASE event_id % 6 "
    + " ".join(f"WHEN {i} THEN '{text.replace(chr(39), chr(39) * 2)}'" for i, text in enumerate(_ERROR_TEXTS))
    + """ END) AS m, CASE WHEN user_id % 2 = 0 THEN 'geocoding' ELSE 'routing' END AS provider FROM events)
       SELECT event_id, provider, CAST(CASE WHEN m LIKE '%timed out%' OR m LIKE '%timeout%' THEN 504
         WHEN provider = 'geocoding' AND (m LIKE '%could not be resolved%' OR m LIKE '%not found%') THEN 404
         WHEN provider = 'routing' AND (m LIKE '%no route%' OR m LIKE '%noroute%' OR m LIKE '%no drivable routes%') THEN 404
         ELSE 502 END AS INTEGER) AS status,
         CASE WHEN m LIKE '%timed out%' OR m LIKE '%timeout%'
             THEN CASE provider WHEN 'geocoding' THEN 'GEOCODING_TIMEOUT' ELSE 'OSRM_TIMEOUT' END
           WHEN provider = 'geocoding' AND (m LIKE '%could not be resolved%' OR m LIKE '%not found%') THEN 'LOCATION_NOT_FOUND'
           WHEN provider = 'routing' AND (m LIKE '%no route%' OR m LIKE '%noroute%' OR m LIKE '%no drivable routes%')
             THEN 'ROUTE_NOT_FOUND'
           WHEN provider = 'geocoding' THEN 'GEOCODING_SERVICE_ERROR' ELSE 'OSRM_SERVICE_ERROR' END AS error_code FROM t""",
)
def provider_errors(spark, sf_dir):
    texts = F.array(*[F.lit(text) for text in _ERROR_TEXTS])
    message = F.element_at(texts, (F.col("event_id") % 6 + 1).cast("int"))
    log = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("user_id") % 2 == 0, "geocoding").otherwise("routing").alias("provider"),
        message.alias("message"),
    )
    return log.select(
        "event_id", "provider", D.provider_error(F.col("message"), F.col("provider")).alias("e")
    ).select("event_id", "provider", "e.*")
