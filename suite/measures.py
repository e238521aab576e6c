"""M-keys: derived measures and per-incident metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from adit.functions import measures as M
from adit.operators import joins, metrics
from suite.base import load, load_spread, query, sql_plain, sql_round
from suite.relational import DAY, PLACED_SQL, placed

# ---- telemetry ---------------------------------------------------------------------------------------------

SQL_SENSOR = r"""sensor AS (SELECT event_id, 'INC-' || (user_id % 5) AS incident_id, ts,
    CASE event_type WHEN 'click' THEN 'CH4' WHEN 'view' THEN 'CO' WHEN 'purchase' THEN 'SPEED' ELSE upper(event_type) END AS sensor_type,
    CASE event_type WHEN 'click' THEN value / 100 WHEN 'view' THEN value / 100000 WHEN 'purchase' THEN value / 20 ELSE value END AS value,
    CASE WHEN CAST(regexp_extract(props, '\d+') AS INT) % 10 <> 0 THEN '1' ELSE '0' END AS status FROM events)"""
SQL_CRITICAL = "CAST((sensor_type = 'CH4' AND value >= 1.0) OR (sensor_type = 'CO' AND value >= 0.002) OR (sensor_type = 'SPEED' AND (value < 0.5 OR value > 4.0)) AS INT)"


def sensor(events):
    """Driver events as telemetry."""
    kind, value = F.col("event_type"), F.col("value")
    return events.select(
        "event_id",
        F.concat(F.lit("INC-"), (F.col("user_id") % 5).cast("string")).alias("incident_id"),
        "ts",
        F.when(kind == "click", "CH4").when(kind == "view", "CO").when(kind == "purchase", "SPEED").otherwise(F.upper(kind)).alias("sensor_type"),
        F.when(kind == "click", value / 100).when(kind == "view", value / 100000).when(kind == "purchase", value / 20).otherwise(value).alias("value"),
        F.when(F.regexp_extract("props", r"\d+", 0).cast("int") % 10 != 0, "1").otherwise("0").alias("status"),
    )


@query(
    "sensor_critical",
    f"""WITH {SQL_SENSOR} SELECT incident_id, sensor_type, count(*) AS readings, CAST(sum({SQL_CRITICAL}) AS BIGINT) AS critical,
          CAST(sum(CASE WHEN {SQL_CRITICAL} = 0 AND ((sensor_type = 'CH4' AND value >= 0.5) OR (sensor_type = 'CO' AND value >= 0.001)) THEN 1 ELSE 0 END) AS BIGINT) AS warned,
          CAST(sum(CASE WHEN status = '1' THEN 0 ELSE 1 END) AS BIGINT) AS poor_quality
        FROM sensor GROUP BY 1, 2 ORDER BY critical DESC, 1, 2""",
)
def sensor_critical(spark, sf):
    kind, value = F.col("sensor_type"), F.col("value")
    return (
        sensor(load(spark, sf, "events"))
        .groupBy("incident_id", "sensor_type")
        .agg(
            F.count("*").alias("readings"),
            F.sum(M.sensor_critical(kind, value)).alias("critical"),
            F.count_if(M.sensor_level(kind, value) == "warn").alias("warned"),
            F.sum(1 - M.quality_flag(F.col("status"))).alias("poor_quality"),
        )
        .orderBy(F.desc("critical"), "incident_id", "sensor_type")
    )


@query(
    "quality_flag",
    f"WITH {SQL_SENSOR} SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 1 WHEN status = '1' THEN 1 ELSE 0 END AS good FROM sensor",
)
def quality_flag(spark, sf):
    status = F.when(F.col("event_id") % 7 == 0, "normal").otherwise(F.col("status"))
    return sensor(load(spark, sf, "events")).select("event_id", M.quality_flag(status).alias("good"))


# ---- air ---------------------------------------------------------------------------------------------------

KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
_KEY = ", ".join(KEY)
SQL_AIR = f"""air AS (SELECT {_KEY}, abs(l_tax) * 100 AS co2, 20.9 - (l_quantity - 1) / 10 AS o2, abs(l_discount) / 10 AS co,
    CASE WHEN l_returnflag = 'A' THEN 2.4 ELSE 0 END::DOUBLE AS ch4 FROM lineitem)"""
SQL_RATIOS = f"""ratios AS (SELECT *, {sql_round("(co2 - 0.03) / nullif(20.9 - o2, 0)", 4)} AS r1, {sql_round("co / nullif(20.9 - o2, 0)", 4)} AS r2,
    {sql_round("co / nullif(co2 - 0.03, 0)", 4)} AS r3 FROM air)"""


def air(items):
    """Driver line items as air samples; quantity 1 gives a zero denominator."""
    return items.select(
        *KEY,
        (F.abs("l_tax") * 100).alias("co2"),
        (F.lit(20.9) - (F.col("l_quantity") - 1) / 10).alias("o2"),
        (F.abs("l_discount") / 10).alias("co"),
        F.when(F.col("l_returnflag") == "A", 2.4).otherwise(0.0).alias("ch4"),
    )


def with_ratios(samples):
    r = M.gas_ratios(F.col("co2"), F.col("o2"), F.col("co"))
    return samples.withColumn("_r", r).select(*samples.columns, "_r.r1", "_r.r2", "_r.r3")


@query("gas_ratios", f"WITH {SQL_AIR}, {SQL_RATIOS} SELECT {_KEY}, r1, r2, r3 FROM ratios")
def gas_ratios(spark, sf):
    return with_ratios(air(load(spark, sf, "lineitem"))).select(*KEY, "r1", "r2", "r3")


SQL_CONCLUSION = f"""coalesce(nullif(concat_ws('; ',
      CASE WHEN ch4 > 0 THEN 'обнаружен метан (CH4: ' || {sql_plain('ch4')} || '%)' END,
      CASE WHEN o2 < 18 AND o2 <> 0 THEN 'снижение содержания кислорода до ' || {sql_plain('o2')} || '%' END,
      CASE WHEN r1 < 0.4 THEN 'R1<0.4 - возможен эндогенный пожар' WHEN r1 > 0.6 THEN 'R1>0.6 - окислительные процессы' END,
      CASE WHEN r2 > 0 THEN 'наличие CO (R2=' || {sql_plain('r2')} || ')' END,
      CASE WHEN r3 > 0 THEN 'соотношение CO/CO2 = ' || {sql_plain('r3')} END), ''), 'норма')"""


@query("gas_conclusion", f"WITH {SQL_AIR}, {SQL_RATIOS} SELECT {_KEY}, {SQL_CONCLUSION} AS conclusion FROM ratios")
def gas_conclusion(spark, sf):
    said = M.gas_conclusion(F.col("ch4"), F.col("o2"), F.col("r1"), F.col("r2"), F.col("r3"))
    return with_ratios(air(load_spread(spark, sf, "lineitem"))).select(*KEY, said.alias("conclusion"))


@query("gas_anomaly", f"SELECT {_KEY}, CASE WHEN l_discount * 20 >= 1.0 THEN 1 ELSE 0 END AS anomaly FROM lineitem")
def gas_anomaly(spark, sf):
    return load(spark, sf, "lineitem").select(*KEY, M.gas_anomaly(F.col("l_discount") * 20).alias("anomaly"))


@query(
    "compliance",
    f"SELECT {_KEY}, CASE WHEN l_linenumber = 7 THEN NULL WHEN 80 + l_quantity / 5 >= 85.0 THEN 1 ELSE 0 END AS compliant FROM lineitem",
)
def compliance(spark, sf):
    share = F.when(F.col("l_linenumber") != 7, F.lit(80) + F.col("l_quantity") / 5)
    return load(spark, sf, "lineitem").select(*KEY, M.compliance(share).alias("compliant"))


@query("ch4_flow", f"SELECT {_KEY}, {sql_round('l_extendedprice / 1000 * (abs(l_discount) * 100 / 100)', 2)} AS flow FROM lineitem")
def ch4_flow(spark, sf):
    flow = M.ch4_flow(F.col("l_extendedprice") / 1000, F.abs("l_discount") * 100)
    return load(spark, sf, "lineitem").select(*KEY, flow.alias("flow"))


def sql_distance(lat: str, lon: str) -> str:
    a = f"(pow(sin((radians({lat}) - radians(49.82)) / 2), 2) + cos(radians(49.82)) * cos(radians({lat})) * pow(sin((radians({lon}) - radians(73.12)) / 2), 2))"
    return f"atan2(sqrt({a}), sqrt(1.0 - {a})) * 2 * 6371.0"


@query(
    "haversine",
    f"""WITH p AS (SELECT c_custkey AS id, 49 + (c_custkey % 200) / 100 AS lat, 72 + (c_custkey % 300) / 100 AS lon FROM customer
         UNION ALL SELECT -1 - s_suppkey, 49 + (s_suppkey % 200) / 100, 72 + (s_suppkey % 300) / 100 FROM supplier)
        SELECT id, {sql_round(sql_distance('lat', 'lon'), 2)} AS km FROM p""",
)
def haversine(spark, sf):
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("k"))
    s = load(spark, sf, "supplier").select((-1 - F.col("s_suppkey")).alias("id"), F.col("s_suppkey").alias("k"))
    lat, lon = F.lit(49) + (F.col("k") % 200) / 100, F.lit(72) + (F.col("k") % 300) / 100
    return c.unionAll(s).select("id", M.distance_km(lat, lon).alias("km"))


@query(
    "valid_at",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 0 WHEN CAST(o_orderdate AS DATE) <= DATE '1998-06-01'
         AND (o_orderkey % 7 = 0 OR CAST(o_orderdate AS DATE) + 365 >= DATE '1998-06-01') THEN 1 ELSE 0 END AS valid FROM orders""",
)
def valid_at(spark, sf):
    issued = F.when(F.col("o_orderkey") % 11 != 0, F.to_date("o_orderdate"))
    expires = F.when(F.col("o_orderkey") % 7 != 0, F.date_add(issued, 365))
    return load(spark, sf, "orders").select("o_orderkey", M.valid_at(issued, expires, F.lit("1998-06-01").cast("date")).alias("valid"))


@query("returned_flag", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS returned FROM orders")
def returned_flag(spark, sf):
    back = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    return load(spark, sf, "orders").select("o_orderkey", M.returned_flag(back).alias("returned"))


@query(
    "layer_flags",
    "SELECT p_partkey, CAST(p_size % 3 = 0 AS INT) AS is_working_layer, CAST(p_size % 3 = 1 AS INT) AS is_satellite FROM part",
)
def layer_flags(spark, sf):
    layer = F.when(F.col("p_size") % 3 == 0, "К3").when(F.col("p_size") % 3 == 1, "К2")
    return load(spark, sf, "part").select("p_partkey", F.inline(F.array(M.layer_flags(layer))))


@query("signed_level", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN -p_size ELSE p_size END::DOUBLE AS level FROM part")
def signed_level(spark, sf):
    size = F.col("p_size")
    text = F.concat(F.when(size % 2 == 0, "Горизонт: -").otherwise("Горизонт: "), size.cast("string"), F.lit(" м"))
    return load(spark, sf, "part").select("p_partkey", M.signed_level(text).alias("level"))


# ---- per-incident metrics ----------------------------------------------------------------------------------


@query(
    "fire_metrics",
    f"""WITH {SQL_AIR}, {SQL_RATIOS}, g AS (SELECT 'INC-' || l_suppkey AS incident_id, avg(r1) AS r1, avg(r2) AS r2, avg(r3) AS r3, max(r1) AS m, max(co) AS co FROM ratios GROUP BY 1),
        f AS (SELECT 'INC-' || (o_custkey % 500) AS incident_id, date_diff('minute', min(o_orderdate), max(o_orderdate)) AS d FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1)
        SELECT coalesce(g.incident_id, f.incident_id) AS incident_id, round(r1, 4) AS r1_co2_o2_ratio, round(r2, 4) AS r2_co_o2_ratio, round(r3, 4) AS r3_co_co2_ratio,
          0.6::DOUBLE AS critical_r1_threshold, CASE WHEN m > 0.6 THEN 1 ELSE 0 END AS is_oxidation_detected, CAST(d AS INT) AS fire_duration_minutes,
          CAST(NULL AS DOUBLE) AS fire_spread_speed_mps, round(co * 10000, 4) AS max_co_ppm
        FROM g FULL JOIN f ON g.incident_id = f.incident_id""",
)
def fire_metrics(spark, sf):
    samples = with_ratios(air(load(spark, sf, "lineitem"))).select(
        F.concat(F.lit("INC-"), F.col("l_suppkey").cast("string")).alias("incident_id"),
        F.col("r1").alias("r1_co2_o2_ratio"),
        F.col("r2").alias("r2_co_o2_ratio"),
        F.col("r3").alias("r3_co_co2_ratio"),
        F.col("co").alias("co_percent"),
    )
    status = F.col("o_orderstatus")
    chronology = load(spark, sf, "orders").select(
        F.concat(F.lit("INC-"), (F.col("o_custkey") % 500).cast("string")).alias("incident_id"),
        F.when(status == "F", "тушение").when(status == "O", "сообщение о пожаре").otherwise("взрыв").alias("event_type"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("event_dttm"),
    )
    return metrics.fire_metrics(samples, chronology)


@query(
    "ventilation_metrics",
    """SELECT 'INC-' || l_suppkey AS incident_id, min(l_quantity / 10) AS air_velocity_min_mps, 0.5::DOUBLE AS air_velocity_norm_mps,
         round(greatest(0.0, (0.5 - min(l_quantity / 10)) / 0.5 * 100), 4) AS velocity_deficit_percent,
         round(avg(abs(l_discount)), 4) AS leakage_coefficient, round(avg(abs(l_tax)), 4) AS distribution_coefficient,
         CASE WHEN min(l_quantity / 10) >= 0.5 AND max(l_quantity / 10) <= 4.0 THEN 1 ELSE 0 END AS is_ventilation_valid
       FROM lineitem WHERE l_linenumber <> 7 GROUP BY l_suppkey""",
)
def ventilation_metrics(spark, sf):
    rows = load(spark, sf, "lineitem").select(
        F.concat(F.lit("INC-"), F.col("l_suppkey").cast("string")).alias("incident_id"),
        F.when(F.col("l_linenumber") != 7, "ventilation").otherwise("dust").alias("param_type"),
        (F.col("l_quantity") / 10).alias("air_velocity_mps"),
        F.abs("l_discount").alias("leakage_coefficient"),
        F.abs("l_tax").alias("distribution_coefficient"),
    )
    return metrics.ventilation_metrics(rows)


@query(
    "incident_metrics",
    f"""WITH {PLACED_SQL},
            o AS (SELECT 'INC-' || o_orderkey AS incident_id, o_orderkey AS k, CAST(o_custkey % 10 AS INT) AS fatalities_count, CAST(o_custkey % 7 AS INT) AS injuries_count,
              CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS economic_damage FROM orders),
            a AS (SELECT l_orderkey AS k, CAST(count(*) FILTER (l_linenumber <> 1) AS INT) AS n FROM lineitem GROUP BY l_orderkey)
       SELECT incident_id, fatalities_count, injuries_count, (o.k % 90) / 100 AS blast_pressure_mpa,
         CASE WHEN o.k % 3 = 0 THEN (300 + o.k % 90)::DOUBLE END AS blast_wave_speed_mps, (o.k % 40)::DOUBLE AS affected_area_length_m,
         coalesce(a.n, 0) AS destroyed_structures_count, economic_damage, CAST(o.k IN (SELECT k FROM n) AS INT) AS is_seismic_event
       FROM o LEFT JOIN a ON o.k = a.k""",
)
def incident_metrics(spark, sf):
    orders = load(spark, sf, "orders").withColumn("incident_id", F.concat(F.lit("INC-"), F.col("o_orderkey").cast("string")))
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    incidents = orders.select(
        "incident_id",
        (cust % 10).cast("int").alias("fatalities"),
        (cust % 7).cast("int").alias("injuries"),
        F.when(
            key % 5 != 0, F.concat(F.lit("ущерб "), F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit(" тенге"))
        ).otherwise("уточняется").alias("material_damage"),
    )
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Длина загазированного участка: "), (key % 40).cast("string"), F.lit(" м")),
        F.concat(F.lit("Избыточное давление во фронте УВ: "), ((key % 90) / 100).cast("string"), F.lit(" МПа")),
        F.when(key % 3 == 0, F.concat(F.lit("Скорость фронта УВ: "), (300 + key % 90).cast("string"), F.lit(" м/с"))),
    )
    models = metrics.blast_model(orders.select("incident_id", text.alias("text")))
    areas = load(spark, sf, "lineitem").select(
        F.concat(F.lit("INC-"), F.col("l_orderkey").cast("string")).alias("incident_id"),
        F.when(F.col("l_linenumber") == 1, 1).otherwise(0).alias("is_primary_blast_zone"),
    )
    near = joins.near_events(*placed(spark, sf), DAY, 4.0)
    shaken = near.select(F.concat(F.lit("INC-"), F.col("o_orderkey").cast("string")).alias("incident_id"), F.col("is_near").alias("is_seismic_event"))
    return metrics.incident_metrics(incidents, models, areas, shaken)
