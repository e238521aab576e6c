"""The registered queries: the contract, and a cross-section against their SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
from suite.check import TABLES, compare

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "clean_text extract_numbers parse_date shift_class sentences pipe_table first_match section_state timestamp_blocks route_fallback "
    "lookup_composite keyword_facts semantic_facts near_event_join grants_expand row_filter processing_summary distinct_join assign_ids "
    "running_depth cap_per_group dedupe_first merge_last_nonnull sensor_critical gas_conclusion haversine fire_metrics csv_alias "
    "json_roundtrip append_partitioned rollback query_history sql_rollup job_gas_analysis job_employee job_sensor_record stream_sensor_critical"
).split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_contract(spark):
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names and len(names) >= 130
    flagship = entry.entry(spark)
    assert flagship.columns == ["incident_id", "sensor_type", "readings", "critical", "warned", "poor_quality"]
    assert flagship.count() == 25


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, con, name):
    status, _, note = compare(spark, con, entry.registered()[name], SF)
    assert status == "OK", note
