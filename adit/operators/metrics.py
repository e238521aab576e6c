"""Per-incident metrics. Every input is aggregated to one row per incident (map-side combined) before joining."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adit.functions import measures as M
from adit.functions import numbers as N
from adit.functions import text as tx

FIRE_TYPES = ("сообщение о пожаре", "тушение")


def fire_metrics(air: DataFrame, chronology: DataFrame) -> DataFrame:
    """Mean ratios, oxidation flag, minutes from the first to the last fire event, and the CO peak in ppm."""
    gases = air.groupBy("incident_id").agg(
        F.avg("r1_co2_o2_ratio").alias("r1_co2_o2_ratio"),
        F.avg("r2_co_o2_ratio").alias("r2_co_o2_ratio"),
        F.avg("r3_co_co2_ratio").alias("r3_co_co2_ratio"),
        F.max("r1_co2_o2_ratio").alias("_r1"),
        (F.max("co_percent") * 10000).alias("max_co_ppm"),
    )
    when = F.col("event_dttm").try_cast("timestamp_ntz")
    fires = (
        chronology.where(F.col("event_type").isin(*FIRE_TYPES))
        .groupBy("incident_id")
        .agg(
            F.timestamp_diff("MINUTE", F.min(when), F.max(when)).cast("int").alias("fire_duration_minutes"),
        )
    )
    return gases.join(fires, "incident_id", "full").select(
        "incident_id",
        F.round("r1_co2_o2_ratio", 4).alias("r1_co2_o2_ratio"),
        F.round("r2_co_o2_ratio", 4).alias("r2_co_o2_ratio"),
        F.round("r3_co_co2_ratio", 4).alias("r3_co_co2_ratio"),
        F.lit(M.R1_OXIDATION).alias("critical_r1_threshold"),
        F.when(F.col("_r1") > M.R1_OXIDATION, 1).otherwise(0).alias("is_oxidation_detected"),
        "fire_duration_minutes",
        F.lit(None).cast("double").alias("fire_spread_speed_mps"),
        F.round("max_co_ppm", 4).alias("max_co_ppm"),
    )


def ventilation_metrics(parameters: DataFrame) -> DataFrame:
    """Lowest velocity against the norm, mean coefficients, and whether all velocities stay inside the limits."""
    lowest = F.col("air_velocity_min_mps")
    deficit = F.greatest(F.lit(0.0), (F.lit(M.VELOCITY_MIN) - lowest) / M.VELOCITY_MIN * 100)
    return (
        parameters.where(F.col("param_type") == "ventilation")
        .groupBy("incident_id")
        .agg(
            F.min("air_velocity_mps").alias("air_velocity_min_mps"),
            F.max("air_velocity_mps").alias("_max"),
            F.avg("leakage_coefficient").alias("leakage_coefficient"),
            F.avg("distribution_coefficient").alias("distribution_coefficient"),
        )
        .select(
            "incident_id",
            "air_velocity_min_mps",
            F.lit(M.VELOCITY_MIN).alias("air_velocity_norm_mps"),
            F.when(lowest.isNotNull(), F.round(deficit, 4)).alias("velocity_deficit_percent"),
            F.round("leakage_coefficient", 4).alias("leakage_coefficient"),
            F.round("distribution_coefficient", 4).alias("distribution_coefficient"),
            F.when((lowest >= M.VELOCITY_MIN) & (F.col("_max") <= M.VELOCITY_MAX), 1)
            .otherwise(0)
            .alias("is_ventilation_valid"),
        )
    )


def blast_model(docs: DataFrame) -> DataFrame:
    """Pressure, front speed and gassed length stated by a blast model text."""
    patterns = {
        "blast_pressure_mpa": [r"Избыточное давление[^:\n]*:\s*([\d.,]+)\s*МПа"],
        "blast_wave_speed_mps": [r"Скорость фронта[^:\n]*:\s*([\d.,]+)\s*м/с"],
        "affected_area_length_m": [r"Длина загазированного участка:\s*([\d.,]+)\s*м"],
    }
    return docs.select(
        "incident_id", *[N.to_float(tx.first_match(F.col("text"), ps)).alias(c) for c, ps in patterns.items()]
    )


def incident_metrics(incidents: DataFrame, models: DataFrame, areas: DataFrame, seismic: DataFrame) -> DataFrame:
    """Casualties, blast strength, destroyed structures, damage and the seismic flag per incident.

    `models` as from `blast_model`; `seismic` has `incident_id, is_seismic_event`.
    """
    base = incidents.groupBy("incident_id").agg(
        F.max("fatalities").alias("fatalities_count"),
        F.max("injuries").alias("injuries_count"),
        F.max(N.first_number(F.col("material_damage"))).alias("economic_damage"),
    )
    blast = models.groupBy("incident_id").agg(
        *[F.max(c).alias(c) for c in ("blast_pressure_mpa", "blast_wave_speed_mps", "affected_area_length_m")]
    )
    destroyed = areas.groupBy("incident_id").agg(
        F.count_if(F.col("is_primary_blast_zone") == 0).cast("int").alias("destroyed_structures_count")
    )
    shaken = seismic.groupBy("incident_id").agg(F.max("is_seismic_event").alias("is_seismic_event"))
    joined = base
    for side in (blast, destroyed, shaken):  # a row an incident: by the size of their files Spark would send millions through the driver
        joined = joined.join(side.hint("merge"), "incident_id", "left")
    return joined.select(
        "incident_id",
        "fatalities_count",
        "injuries_count",
        "blast_pressure_mpa",
        "blast_wave_speed_mps",
        "affected_area_length_m",
        F.coalesce("destroyed_structures_count", F.lit(0)).alias("destroyed_structures_count"),
        "economic_damage",
        F.coalesce("is_seismic_event", F.lit(0)).alias("is_seismic_event"),
    )
