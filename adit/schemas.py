"""Fixed target schemas: 25 incident tables, 3 metrics tables and the log tables.

Column names, order and types must equal what downstream SQL already reads.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Table name -> columns in order.
TABLE_COLUMNS: dict[str, str] = {
    "affected_areas": (
        "area_id string, incident_id string, premise_id string, damage_type string, damage_description "
        "string, is_primary_blast_zone int, geo_metca string, source_file string"
    ),
    "air_analysis": (
        "sample_id string, incident_id string, sample_point string, sample_dttm string, co2_percent "
        "double, o2_percent double, ch4_percent double, co_percent double, h2_percent double, analyst "
        "string, analyst_laboratory string, r1_co2_o2_ratio double, r2_co_o2_ratio double, "
        "r3_co_co2_ratio double, conclusion string, source_file string, _notice_num string"
    ),
    "chronology_incident": (
        "event_id string, incident_id string, event_dttm string, event_type string, action_description "
        "string, temperature_c double, pressure_mmHg double, humidity_percent double, source string, "
        "location string, persons string, speaker string, source_file string"
    ),
    "company_description": (
        "company_id string, company_name string, mine_name string, year_commissioned int, "
        "annual_production_tons double, actual_production_tons double, depth_m double, employees_count "
        "int, gas_hazard_category string, outburst_hazard string, source_file string, description string, "
        "avg_daily_load_lava_48 double, avg_daily_load_lava_42 double, production_9months string"
    ),
    "employee": (
        "employee_id string, lastname string, firstname string, middlename string, birth_date string, "
        "position string, department string, status_at_incident string, injury_type string, source_file "
        "string"
    ),
    "equipment": (
        "equipment_id string, equipment_type string, model string, serial_number string, manufacturer "
        "string, year_of_manufacture int, technical_condition string, spark_safety_class string, "
        "location_at_incident string, manufacturer_requirements string, source_file string"
    ),
    "equipment_certificate": (
        "certificate_id string, equipment_id string, certificate_number string, certificate_type string, "
        "issuing_body string, issue_date string, expiry_date string, is_valid_at_incident int, "
        "source_file string"
    ),
    "equipment_issue_log": (
        "issue_id string, incident_id string, equipment_name string, equipment_type string, "
        "inventory_number string, quantity int, unit string, issued_to string, employee_id string, "
        "position string, issue_date string, shift string, return_date string, is_returned int, issued_by "
        "string, purpose string, notes string, source_file string"
    ),
    "equipment_maintenance": (
        "maintenance_id string, equipment_id string, maintenance_date string, shift string, "
        "operation_type string, performed_by string, anomaly_notes string, is_completed int, source_file "
        "string, _equipment_model string"
    ),
    "expert_dictionary": (
        "expert_id string, expert_lastname string, expert_firstname string, expert_middlename string, "
        "profession string, category string, expiry_date string, source_file string"
    ),
    "gas_analysis": (
        "measurement_id string, incident_id string, location string, measurement_dttm string, ch4_percent "
        "double, air_velocity_mps double, measurement_height_cm double, is_anomaly int, note string, "
        "source_file string"
    ),
    "geological_structure": (
        "structure_id string, mine_name string, panel_name string, layer_name string, depth_from_m "
        "double, depth_to_m double, rock_type string, thickness_m double, gas_content_m3_per_ton double, "
        "description string, is_working_layer int, is_satellite int, source_file string"
    ),
    "hypotesis_prove_facts": (
        "fact_id string, hypotesis_id string, source_name string, is_prove int, fact_text string, "
        "match_type string, keyword string, source_file string"
    ),
    "incident_description": (
        "incident_id string, incident_date string, incident_time string, mine_name string, incident_type "
        "string, fatalities int, injuries int, material_damage string, brief_description string, "
        "extracted_locations string, extracted_entities string, source_file string"
    ),
    "inspection_description": (
        "fact_id string, incident_id string, inspection_date string, fact_description string, "
        "inspector_name string, location string, condition_description string, violations_found string, "
        "equipment_name string, source_file string"
    ),
    "premise": (
        "premise_id string, premise_name string, premise_type string, x_coordinate double, y_coordinate "
        "double, level_m double, length_m double, cross_section_m2 double, company_id string, source_file "
        "string"
    ),
    "premise_parameters": (
        "param_id string, incident_id string, location string, measurement_date string, param_type "
        "string, inert_dust_applied_kg double, noncombustible_content_percent double, "
        "normative_noncombustible_percent double, is_compliant int, dust_removal_water_m3 double, "
        "dust_removal_frequency string, water_spray_present int, water_spray_flow_l_min double, "
        "air_flow_m3_min double, air_velocity_mps double, cross_section_m2 double, "
        "ch4_concentration_percent double, leakage_coefficient double, distribution_coefficient double, "
        "gas_flow_m3_min double, ch4_flow_m3_min double, vacuum_pressure_mmH2O double, "
        "degassing_efficiency_percent double, source_file string"
    ),
    "regulatory_document": (
        "doc_id string, doc_name string, doc_number string, issue_date string, effective_date string, "
        "normative_value string, section string, source_file string"
    ),
    "seismic_event": (
        "event_id string, event_dttm string, latitude double, longitude double, depth_km double, "
        "magnitude double, energy_class double, source string, source_file string, distance_to_mine_km "
        "double"
    ),
    "sensor_record": (
        "record_id string, incident_id string, sensor_id string, sensor_type string, record_dttm string, "
        "value double, unit string, is_critical int, data_quality_flag int, x_coordinate double, "
        "y_coordinate double, source_file string"
    ),
    "sensor_reestr": (
        "sensor_id string, sensor_type string, model string, location string, measurement_range string, "
        "unit string, last_calibration_date string, battery_life_hours double, "
        "actual_battery_time_at_incident double, source_file string"
    ),
    "witness_statement": (
        "statement_id string, incident_id string, witness_name string, statement_datetime string, "
        "testimony_text string, source_file string, extracted_persons string, extracted_locations string, "
        "extracted_organizations string, extracted_facts string, extracted_events string"
    ),
    "expert_conclusion": (
        "conclusion_id string, incident_id string, conclusion_date string, expert_id string, "
        "fire_origin_location string, blast_epicenter_location string, scenario_description string, "
        "root_cause string, contributing_factors string, is_confirmed int, report_id string, "
        "confirmed_hypotesis_id string, source_file string"
    ),
    "hypotesis": (
        "hypothesis_id string, incident_id string, hypothesis_type string, description string, "
        "confidence_score double, is_confirmed int, actual_flag int, source_file string"
    ),
    "recommended_actions": (
        "measure_id string, conclusion_id string, measure_type string, description string, "
        "responsible_party string, implementation_deadline string, status string, source_file string"
    ),
    "fire_metrics": (
        "metric_id string, incident_id string, r1_co2_o2_ratio double, r2_co_o2_ratio double, "
        "r3_co_co2_ratio double, critical_r1_threshold double, is_oxidation_detected int, "
        "fire_duration_minutes int, fire_spread_speed_mps double, max_co_ppm double, calculation_date "
        "timestamp, source_file string"
    ),
    "ventilation_metrics": (
        "metric_id string, incident_id string, air_velocity_min_mps double, air_velocity_norm_mps double, "
        "velocity_deficit_percent double, leakage_coefficient double, distribution_coefficient double, "
        "is_ventilation_valid int, calculation_date timestamp, source_file string"
    ),
    "incident_metrics": (
        "metric_id string, incident_id string, fatalities_count int, injuries_count int, "
        "blast_pressure_mpa double, blast_wave_speed_mps double, affected_area_length_m double, "
        "destroyed_structures_count int, economic_damage double, is_seismic_event int, calculation_date "
        "timestamp, source_file string"
    ),
}

# Tables partitioned by incident_id; all others are unpartitioned.
PARTITIONED_TABLES = (
    "affected_areas",
    "air_analysis",
    "chronology_incident",
    "equipment_issue_log",
    "gas_analysis",
    "incident_description",
    "inspection_description",
    "premise_parameters",
    "sensor_record",
    "witness_statement",
    "expert_conclusion",
    "hypotesis",
    "fire_metrics",
    "ventilation_metrics",
    "incident_metrics",
)

# Columns of the log tables.
LOG_COLUMNS: dict[str, str] = {
    "table_metadata": (
        "table_name string, catalog_name string, schema_name string, description string, "
        "created_at timestamp, updated_at timestamp, is_active boolean"
    ),
    "query_history": (
        "user_id bigint, username string, query_text string, table_name string, executed_at timestamp, "
        "execution_time_ms bigint, row_count bigint, status string, error_message string"
    ),
    "table_change_log": (
        "table_name string, user_id bigint, username string, action string, executed_at timestamp, "
        "snapshot_before bigint, snapshot_after bigint, details string"
    ),
}

# Identifier prefix of each extracted table.
ID_PREFIXES: dict[str, tuple[str, str]] = {
    "affected_areas": ("area_id", "AREA"),
    "air_analysis": ("sample_id", "AIR"),
    "chronology_incident": ("event_id", "EVENT"),
    "company_description": ("company_id", "COMP"),
    "employee": ("employee_id", "EMP"),
    "equipment": ("equipment_id", "EQ"),
    "equipment_certificate": ("certificate_id", "CERT"),
    "equipment_issue_log": ("issue_id", "ISSUE"),
    "equipment_maintenance": ("maintenance_id", "MT"),
    "expert_dictionary": ("expert_id", "EXP"),
    "gas_analysis": ("measurement_id", "GAS"),
    "geological_structure": ("structure_id", "GEO"),
    "hypotesis_prove_facts": ("fact_id", "FACT"),
    "inspection_description": ("fact_id", "INSP"),
    "premise": ("premise_id", "PREM"),
    "premise_parameters": ("param_id", "PREM_PARAM"),
    "regulatory_document": ("doc_id", "DOC"),
    "seismic_event": ("event_id", "SEIS"),
    "sensor_record": ("record_id", "SR"),
    "witness_statement": ("statement_id", "WIT"),
}


def table_schema(table: str) -> T.StructType:
    columns = TABLE_COLUMNS.get(table) or LOG_COLUMNS[table]
    return T.StructType.fromDDL(columns)
