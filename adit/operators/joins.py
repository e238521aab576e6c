"""Lookups and matches between tables.

No join here carries a broadcast hint: small sides are broadcast by Spark when their measured size is
under `spark.sql.autoBroadcastJoinThreshold`, larger ones are shuffled and AQE splits skewed keys. Every
lookup side is reduced to one row per key first, so a hot key never multiplies rows. Sides that grow with the events or
incidents of `near_events` are never broadcast: their files are much smaller than their rows, and these would pass through the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adit.functions import text as tx
from adit.functions.classify import first_word
from adit.functions.measures import EARTH_KM, great_circle_km
from adit.session import materialize

KM_PER_DEGREE = math.pi * EARTH_KM / 180
#: Parts of a cell's side, where near_events looks closer.
PARTS = 64


def one_per_key(df: DataFrame, key: str | Column, value: str, order: str | None = None) -> DataFrame:
    """(`_key`, value) with one row per key: the value that comes last by `order` (by default by value)."""
    ranked = F.struct(F.col(order or value).alias("o"), F.col(value).alias("v"))
    k = F.col(key) if isinstance(key, str) else key
    return (
        df.select(k.alias("_key"), ranked.alias("_r"))
        .where(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.max("_r").getField("v").alias(value))
    )


def lookup(df: DataFrame, key: Column, table: DataFrame, table_key: Column, value: str, alias: str | None = None) -> DataFrame:
    """Left lookup: adds `alias` (null on a miss); never changes the number of rows.

    Rows without a key find nothing; they are dealt by a hash of the row, so that they do not all meet in one task.
    """
    side = one_per_key(table, table_key, value).withColumnRenamed(value, "_value")
    apart = F.concat(F.lit("\u0000"), F.xxhash64(*df.columns).cast("string"))
    return (
        df.withColumn("_lookup", F.coalesce(key.cast("string"), apart))
        .join(side, F.col("_lookup") == F.col("_key").cast("string"), "left")
        .select(*df.columns, F.col("_value").alias(alias or value))
    )


def attach_equipment(certs: DataFrame, equipment: DataFrame) -> DataFrame:
    """Equipment by `model|serial`, or by `model` when the certificate states no serial number."""
    by_model = equipment.select(F.col("model").alias("k"), "equipment_id")
    by_both = equipment.where(F.col("serial_number").isNotNull()).select(
        F.concat_ws("|", "model", "serial_number").alias("k"), "equipment_id"
    )
    key = F.when(F.col("model").isNotNull(), F.concat_ws("|", "model", "serial_number"))
    return lookup(certs, key, by_model.unionAll(by_both), F.col("k"), "equipment_id")


def attach_by_model(maintenance: DataFrame, equipment: DataFrame, model: str = "model") -> DataFrame:
    return lookup(maintenance, F.col(model), equipment, F.col("model"), "equipment_id")


def person_key(full_name: Column) -> Column:
    """Surname plus first initial, folded: `Иванов И.И.` and `Иванов Иван` agree."""
    parts = tx.split_name(full_name)
    return F.lower(F.concat_ws("_", parts["lastname"], F.substring(parts["firstname"], 1, 1)))


def attach_employee(issues: DataFrame, employees: DataFrame, name: str = "issued_to") -> DataFrame:
    """Employee by surname and first initial; two employees behind one key means no answer."""
    people = (
        employees.select(person_key(F.concat_ws(" ", "lastname", "firstname")).alias("_key"), "employee_id")
        .groupBy("_key")
        .agg(F.min("employee_id").alias("_lo"), F.max("employee_id").alias("_hi"))
        .where(F.col("_lo") == F.col("_hi"))
    )
    return (
        issues.withColumn("_lookup", person_key(F.col(name)))
        .join(people, F.col("_lookup") == F.col("_key"), "left")
        .select(*issues.columns, F.col("_lo").alias("employee_id"))
    )


def keyword_facts(sentences: DataFrame, hypotheses) -> DataFrame:
    """One row per sentence and hypothesis with a key word; the first word of the list is reported.

    The word list is fixed, so it becomes an expression: no pairing of sentences with words.
    """
    every_word = [w for _, words in hypotheses for w in words]
    folded = sentences.withColumn("_folded", F.lower("sentence")).where(tx.contains_any(F.col("_folded"), every_word, folded=True))
    words_found = folded.select(
        "*", *[first_word(F.col("_folded"), words, folded=True).alias(f"_word_{i}") for i, (_, words) in enumerate(hypotheses)]
    )
    hits = F.array(
        *[
            F.struct(F.lit(hid).alias("hypotesis_id"), F.lit(i).alias("hyp_rank"), F.col(f"_word_{i}").alias("keyword"))
            for i, (hid, _) in enumerate(hypotheses)
        ]
    )
    every = words_found.select(*sentences.columns, F.inline_outer(hits))
    return every.where("keyword is not null")


def _norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _angle(a: Column, b: Column) -> Column:
    """The angle between two vectors of unit length; null where they do not fit or hold nulls or NaN."""
    cos = _dot(a, b)
    return F.when(cos.isNotNull() & ~F.isnan(cos), F.acos(F.greatest(F.least(cos, F.lit(1.0)), F.lit(-1.0))))


def semantic_candidates(vectors: DataFrame, centroids: DataFrame, min_cos: float, pivots: int) -> DataFrame:
    """Pairs of vectors and centroids that the angles to pivots leave open: `_v` (the vector's row), `_length`, hypotesis_id and unit.

    Up to `pivots` centroids of each number of dimensions, by a hash of their id, are pivots; every centroid belongs to its nearest one's
    cell, and there to a ring by its angle. A vector meets only the rings of the cells that its own angles allow: an angle
    between two vectors is no less than the difference of their angles to a third.
    """
    turn, slack = math.acos(min_cos), 1e-6
    ring = max(turn / 2, 1e-3)
    size = F.nullif(_norm(F.col("centroid")), F.lit(0.0))
    units = centroids.select("hypotesis_id", F.transform("centroid", lambda x: x / size).alias("unit"), F.size("centroid").alias("_dim"))
    units = materialize(units.where(F.coalesce(F.forall("unit", lambda x: x.isNotNull() & ~F.isnan(x)), F.lit(False))), "centroids")
    order = Window.partitionBy("_dim").orderBy(F.xxhash64("hypotesis_id"), "hypotesis_id")
    chosen = units.withColumn("_cell", F.row_number().over(order)).where(F.col("_cell") <= pivots)
    packed = materialize(chosen.select("_dim", "_cell", F.col("unit").alias("_pivot")), "pivots")

    every = packed.agg(F.collect_list(F.struct("_dim", "_cell", "_pivot")).alias("p")).scalar()  # at most `pivots` a dimension
    angles = F.transform("_p", lambda p: F.struct(F.when(p["_dim"] == F.col("_dim"), _angle(F.col("unit"), p["_pivot"])).alias("a"), p["_cell"].alias("c")))
    nearest = F.array_min(F.filter(angles, lambda x: x["a"].isNotNull()))
    placed = units.withColumn("_p", every).withColumn("_n", nearest).select("hypotesis_id", "unit", "_dim", F.col("_n.c").alias("_cell"), F.col("_n.a").alias("_beta"))
    placed = materialize(placed.withColumn("_ring", F.floor(F.col("_beta") / ring).cast("int")), "cells")

    widths = placed.groupBy("_dim", "_cell").agg(F.max("_beta").alias("_width"))
    cells = packed.join(widths, ["_dim", "_cell"]).agg(F.collect_list(F.struct("_dim", "_cell", "_pivot", "_width")).alias("p")).scalar()
    length = F.nullif(_norm(F.col("vec")), F.lit(0.0))
    seen = vectors.select(F.struct("*").alias("_v"), F.col("vec").alias("_vec"), length.alias("_length")).withColumn("_p", cells)
    unit = F.transform("_vec", lambda x: x / F.col("_length"))
    turned = F.transform(
        "_p", lambda p: F.struct(p["_dim"].alias("_dim"), p["_cell"].alias("_cell"), F.when(p["_dim"] == F.size("_vec"), _angle(F.col("_unit"), p["_pivot"])).alias("_alpha"), p["_width"].alias("_width"))
    )
    near = F.filter(turned, lambda p: p["_alpha"] - (turn + slack) <= p["_width"])
    met = seen.withColumn("_unit", unit).select("_v", "_length", F.inline(near))
    first, last = (F.floor(x / ring).cast("int") for x in (F.greatest(F.col("_alpha") - (turn + slack), F.lit(0.0)), F.least(F.col("_alpha") + (turn + slack), F.col("_width"))))
    rings = met.withColumn("_ring", F.explode(F.sequence(first, F.greatest(first, last))))
    open_still = (F.col("_beta") - F.col("_alpha")).between(-(turn + slack), turn + slack)
    return rings.join(placed, ["_dim", "_cell", "_ring"]).where(open_still).select("_v", "_length", "hypotesis_id", "unit")


def semantic_facts(vectors: DataFrame, centroids: DataFrame, min_cos: float = 0.65, pivots: int = 256) -> DataFrame:
    """(vector, centroid) pairs with cosine above `min_cos`.

    `vectors`: any columns plus `vec array<double>`; `centroids`: `hypotesis_id, centroid`. Every vector is compared with `pivots`
    centroids at most, which are sent to all tasks, and with those others that the pivots leave open (`semantic_candidates`), found by an equality
    join; results are the same for any number. With a handful of centroids each is its own pivot and only hits are joined.
    Vectors and centroids that are null, zero or hold nulls or NaN are near nothing.
    """
    found = semantic_candidates(vectors, centroids, min_cos, pivots)
    scored = found.withColumn("similarity", _dot(F.col("_v.vec"), F.col("unit")) / F.col("_length"))
    return scored.where((F.col("similarity") > min_cos) & ~F.isnan("similarity")).select("_v.*", "hypotesis_id", "similarity")


def _placed(df: DataFrame, lat: str, lon: str, at: str) -> DataFrame:
    """Points on earth at a time, as _lat, _lon (-180 up to 180) and _at; rows without one are left out."""
    points = df.select(F.col(lat).cast("double").alias("_lat"), (F.pmod(F.col(lon).cast("double") + 180, F.lit(360.0)) - 180).alias("_lon"), F.col(at).cast("bigint").alias("_at"))
    return points.where("_lat BETWEEN -90 AND 90 AND _lon BETWEEN -180 AND 180 AND _at IS NOT NULL")


def _close_cell(km: float) -> tuple[Column, Column]:
    """Band and cell of a grid in which two points of one cell are within `km`: half of it north to south, half along the parallel."""
    height = km / 2 / KM_PER_DEGREE * 0.999
    band = F.floor((F.col("_lat") + 90) / height)
    low = band * height - 90
    widest = F.when((low <= 0) & (low + height >= 0), 1.0).otherwise(F.cos(F.radians(F.least(F.abs(low), F.abs(low + height)))))
    return band, F.floor((F.col("_lon") + 180) / (height / F.greatest(widest, F.lit(1e-9))))


def _cells(band: Column, km: float) -> Column:
    """Cells around the earth in a band: each at least as wide as `km` can reach from within the band or those beside it."""
    height = km / KM_PER_DEGREE * 1.001
    low = band * height - 90
    narrow = F.cos(F.radians(F.least(F.greatest(F.abs(low - height), F.abs(low + 2 * height)), F.lit(90.0))))
    reach = math.sin(min(km / EARTH_KM, math.pi) / 2)
    width = F.when(narrow <= reach, 360.0).otherwise(F.degrees(F.asin(reach / narrow)) * 2.002)
    return F.greatest(F.lit(1), F.floor(360 / width)).cast("bigint")


def _cell(n: Column) -> Column:
    return F.least(F.floor((F.col("_lon") + 180) / 360 * n), n - 1)


def _circle() -> list[Column]:
    """Of a group of events: a middle, how far any of them is from it at most, and the span of their times."""
    low, high, west, east = F.min("_lat"), F.max("_lat"), F.min("_lon"), F.max("_lon")
    widest = F.when((low <= 0) & (high >= 0), 1.0).otherwise(F.cos(F.radians(F.least(F.abs(low), F.abs(high)))))
    radius = ((high - low) / 2 + (east - west) / 2 * widest) * KM_PER_DEGREE * 1.0001 + 1e-6
    return [((low + high) / 2).alias("_lat0"), ((west + east) / 2).alias("_lon0"), radius.alias("_r"), F.min("_first").alias("_first"), F.max("_last").alias("_last")]


def _judged(pairs: DataFrame, cell: list[str], seconds: int, km: float) -> tuple[DataFrame, DataFrame]:
    """From pairs of points and groups of events: points that are near a whole group, and for the others the groups that may be near."""
    point = ["_lat", "_lon", "_at"]
    away = great_circle_km(F.col("_lat"), F.col("_lon"), F.col("_lat0"), F.col("_lon0"))
    known = pairs.where(F.col("_at").between(F.col("_first") - seconds, F.col("_last") + seconds)).select(*point, *cell, "_r", away.alias("_d")).where(F.col("_d") - F.col("_r") <= km)
    found = known.groupBy(*point).agg(F.max(F.col("_d") + F.col("_r") <= km).alias("_hit"), F.collect_set(F.struct(*cell)).alias("_open"))
    found = materialize(found, "judged")
    return found.where("_hit").select(*point), found.where("NOT _hit").select(*point, F.inline("_open"))


def near_events(incidents: DataFrame, events: DataFrame, seconds: int, km: float, lat: str = "latitude", lon: str = "longitude", at: str = "at_s") -> DataFrame:
    """Adds `is_near` (0/1): some event within `seconds` and `km` (great circle) of the incident. Rows without a place or time are near nothing.

    Times are whole seconds (`at`). Events of one place become their first and last time in a slot of `seconds`. Equality joins
    decide, on distinct incident points, and no pairs of points are formed until the last:
    points that share a slot and a cell so small that all in it is near are settled at once, so dense places need no comparison;
    the others meet groups of events, circles over a slot and a cell, first those of the cells beside theirs (latitude bands as
    high as `km`, cells as wide as the latitude asks, around the date line and over the poles), then, where a circle is cut by their own
    reach, its parts of a 64th; only the events of parts that are still cut are checked one by one, in a semi-join that stops at a point's first hit.
    """
    if seconds < 1 or not 0 < km:
        raise ValueError("seconds and km must be positive")
    point, home, part = ["_lat", "_lon", "_at"], ["_b", "_c", "_s"], ["_b", "_c", "_s", "_y", "_x"]
    slot, height = F.floor(F.col("_at") / seconds), km / KM_PER_DEGREE * 1.001
    band, cell = _close_cell(km)
    merged = lambda a, b, *how: a.join(b.hint("merge"), *how)
    points = _placed(incidents, lat, lon, at).distinct().select("*", band.alias("_b"), cell.alias("_c"), slot.alias("_s"))
    here = F.floor((F.col("_lat") + 90) / height)
    wide = _cells(F.col("_b"), km)
    shocks = (
        _placed(events, lat, lon, at).groupBy("_lat", "_lon", slot.alias("_s")).agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
        .select("*", here.alias("_b")).select("*", wide.alias("_n")).select("*", _cell(F.col("_n")).alias("_c"))
        .select("*", F.floor((F.col("_lat") + 90) / height * PARTS).alias("_y"), F.floor((F.col("_lon") + 180) / 360 * F.col("_n") * PARTS).alias("_x"))
    )
    # Each step is written: read again by the steps after it, and planned alone. One plan of all does not fit a driver.
    shocks = materialize(shocks, "shocks")
    sure = merged(points, shocks.select(band.alias("_b"), cell.alias("_c"), "_s").distinct().withColumn("_sure", F.lit(True)), home, "left")
    sure = materialize(sure.select(*point, "_s", "_sure"), "points")
    rest = sure.where("_sure IS NULL").select(*point, F.col("_s").alias("_slot"), here.alias("_band"), _cell(_cells(here, km)).alias("_cell"))

    beside = lambda c: F.array(*[c + k for k in (-1, 0, 1)])
    banded = shocks.withColumn("_band", F.explode(beside(F.col("_b")))).withColumn("_n", _cells(F.col("_band"), km))
    around = F.array_distinct(F.transform(beside(_cell(F.col("_n"))), lambda c: F.pmod(c, F.col("_n"))))
    reach = banded.withColumn("_cell", F.explode(around)).withColumn("_slot", F.explode(beside(F.col("_s")))).groupBy("_band", "_cell", "_slot", *home).agg(*_circle())
    first, cut = _judged(merged(rest, reach, ["_band", "_cell", "_slot"]), home, seconds, km)
    second, cut = _judged(merged(cut, shocks.groupBy(*part).agg(*_circle()), home), part, seconds, km)
    alone = shocks.select(*part, F.col("_lat").alias("_lat0"), F.col("_lon").alias("_lon0"), "_first", "_last")
    within = F.col("_at").between(F.col("_first") - seconds, F.col("_last") + seconds) & (great_circle_km(F.col("_lat"), F.col("_lon"), F.col("_lat0"), F.col("_lon0")) <= km)
    third = merged(cut, alone, [*[cut[c] == alone[c] for c in part], within], "left_semi").select(*point).distinct()

    near = sure.where("_sure").select(*point).unionAll(first).unionAll(second).unionAll(third).withColumn("_near", F.lit(1))
    keyed = incidents.withColumns({"__lat": F.col(lat).cast("double"), "__lon": F.pmod(F.col(lon).cast("double") + 180, F.lit(360.0)) - 180, "__at": F.col(at).cast("bigint")})
    return merged(keyed, near, [keyed["__lat"] == near["_lat"], keyed["__lon"] == near["_lon"], keyed["__at"] == near["_at"]], "left").select(
        *[keyed[c] for c in incidents.columns], F.coalesce("_near", F.lit(0)).alias("is_near")
    )


def files_without_rows(files: DataFrame, rows: DataFrame, key: str = "source_file") -> DataFrame:
    return files.join(rows.select(key).distinct(), key, "left_anti")


def incident_investigation(incidents: DataFrame, investigations: DataFrame) -> DataFrame:
    return incidents.join(investigations, "incident_id", "inner")
