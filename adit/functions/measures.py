"""Derived safety measures as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Composition of clean air, percent.
CO2_AIR, O2_AIR, CO_AIR = 0.03, 20.9, 0.0
# Limits.
CH4_ALARM, CO_ALARM = 1.0, 0.002
CH4_WARN, CO_WARN = 0.5, 0.001
VELOCITY_MIN, VELOCITY_MAX = 0.5, 4.0
NONCOMBUSTIBLE_NORM = 85.0
R1_OXIDATION, R1_FIRE = 0.6, 0.4
# Mine position and Earth radius in km.
MINE_LAT, MINE_LON, EARTH_KM = 49.82, 73.12, 6371.0


def _ratio(numerator: Column, denominator: Column) -> Column:
    """Null for a zero denominator; adding 0.0 turns a negative zero into zero."""
    return F.round(numerator / F.nullif(denominator, F.lit(0.0)), 4) + F.lit(0.0)


def gas_ratios(co2: Column, o2: Column, co: Column) -> Column:
    """Fire-gas ratios R1..R3; all null unless both CO2 and O2 are known."""
    known = co2.isNotNull() & o2.isNotNull()
    d_co2, d_o2, d_co = co2 - CO2_AIR, F.lit(O2_AIR) - o2, co - CO_AIR
    return F.struct(
        F.when(known, _ratio(d_co2, d_o2)).alias("r1"),
        F.when(known, _ratio(d_co, d_o2)).alias("r2"),
        F.when(known, _ratio(d_co, d_co2)).alias("r3"),
    )


def plain_number(c: Column, digits: int = 4) -> Column:
    """A number as text without exponent: 0.0001, 0.5, 29.3, 1.0."""
    return F.regexp_replace(c.cast(f"decimal(24,{digits})").cast("string"), r"(\.\d+?)0+$", "$1")


def gas_conclusion(ch4: Column, o2: Column, r1: Column, r2: Column, r3: Column) -> Column:
    """What a sample says, as ordered clauses; `норма` when there is nothing to say."""
    clauses = F.array(
        F.when(ch4 > 0, F.concat(F.lit("обнаружен метан (CH4: "), plain_number(ch4), F.lit("%)"))),
        F.when((o2 < 18) & (o2 != 0), F.concat(F.lit("снижение содержания кислорода до "), plain_number(o2), F.lit("%"))),
        F.when(r1 < R1_FIRE, "R1<0.4 - возможен эндогенный пожар").when(r1 > R1_OXIDATION, "R1>0.6 - окислительные процессы"),
        F.when(r2 > 0, F.concat(F.lit("наличие CO (R2="), plain_number(r2), F.lit(")"))),
        F.when(r3 > 0, F.concat(F.lit("соотношение CO/CO2 = "), plain_number(r3))),
    )
    return F.coalesce(F.nullif(F.array_join(F.array_compact(clauses), "; "), F.lit("")), F.lit("норма"))


def gas_anomaly(ch4: Column) -> Column:
    return F.when(ch4 >= CH4_ALARM, 1).otherwise(0)


def compliance(noncombustible: Column) -> Column:
    return F.when(noncombustible >= NONCOMBUSTIBLE_NORM, 1).when(noncombustible.isNotNull(), 0)


def ch4_flow(gas_flow: Column, ch4: Column) -> Column:
    return F.round(gas_flow * (ch4 / 100), 2)


def distance_km(lat: Column, lon: Column, lat0: float = MINE_LAT, lon0: float = MINE_LON) -> Column:
    """Great-circle distance to a fixed point, two decimals."""
    phi0, phi = F.radians(F.lit(lat0)), F.radians(lat)
    half_lat = (phi - phi0) / 2
    half_lon = (F.radians(lon) - F.radians(F.lit(lon0))) / 2
    a = F.pow(F.sin(half_lat), 2) + F.cos(phi0) * F.cos(phi) * F.pow(F.sin(half_lon), 2)
    return F.round(F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)) * 2 * EARTH_KM, 2)


def great_circle_km(lat: Column, lon: Column, lat0: Column, lon0: Column) -> Column:
    """Great-circle distance between two points, not rounded."""
    a = F.pow(F.sin(F.radians(lat - lat0) / 2), 2) + F.cos(F.radians(lat)) * F.cos(F.radians(lat0)) * F.pow(F.sin(F.radians(lon - lon0) / 2), 2)
    return F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * (2 * EARTH_KM)


def valid_at(issue: Column, expiry: Column, at: Column) -> Column:
    """1 when issued by that day and not yet expired; a missing expiry never expires."""
    return F.when(issue.isNotNull() & (issue <= at) & (expiry.isNull() | (expiry >= at)), 1).otherwise(0)


def sensor_critical(sensor_type: Column, value: Column) -> Column:
    return (
        F.when((sensor_type == "CH4") & (value >= CH4_ALARM), 1)
        .when((sensor_type == "CO") & (value >= CO_ALARM), 1)
        .when((sensor_type == "SPEED") & ((value < VELOCITY_MIN) | (value > VELOCITY_MAX)), 1)
        .otherwise(0)
    )


def sensor_level(sensor_type: Column, value: Column) -> Column:
    """`alarm`, `warn` or `ok`."""
    warn = ((sensor_type == "CH4") & (value >= CH4_WARN)) | ((sensor_type == "CO") & (value >= CO_WARN))
    return F.when(sensor_critical(sensor_type, value) == 1, "alarm").when(warn, "warn").otherwise("ok")


def quality_flag(status: Column) -> Column:
    return F.when(F.coalesce(status, F.lit("1")).isin("1", "normal"), 1).otherwise(0)


def returned_flag(return_date: Column) -> Column:
    return return_date.isNotNull().cast("int")


def layer_flags(layer: Column) -> Column:
    return F.struct(
        F.when(layer == "К3", 1).otherwise(0).alias("is_working_layer"),
        F.when(layer == "К2", 1).otherwise(0).alias("is_satellite"),
    )


def signed_level(text: Column) -> Column:
    """A level in metres, negative when the text carries a minus sign."""
    value = F.abs(F.regexp_extract(text, r"\d+", 0).try_cast("double"))
    return F.when(text.contains("-"), -value).otherwise(value)
