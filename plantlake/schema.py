"""Column types of the plant tables (DDL strings, accepted by every reader)."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the plant model.
PLANT_TABLES: dict[str, str] = {
    "dim_refineries": """
        refinery_id string, refinery_name string, location_city string, location_state string,
        location_country string, latitude double, longitude double, capacity_bpd int,
        complexity_index double, commissioned_date date, operator_name string,
        is_active boolean, last_turnaround_date date""",
    "dim_processing_units": """
        unit_id string, refinery_id string, unit_name string, unit_type string, unit_subtype string,
        capacity_bpd int, design_efficiency double, installation_date date,
        last_maintenance_date date, maintenance_interval_days int, manufacturer string,
        model_number string, is_active boolean""",
    "dim_storage_tanks": """
        tank_id string, refinery_id string, tank_name string, tank_type string, product_type string,
        capacity_barrels int, min_operating_level double, max_operating_level double,
        diameter_feet double, height_feet double, material string, has_heating boolean,
        has_mixer boolean, last_inspection_date date, is_active boolean""",
    "dim_crude_types": """
        crude_type_id string, crude_name string, crude_abbreviation string, origin_country string,
        origin_region string, api_gravity_typical double, sulfur_content_typical double,
        classification string, sweetness string, benchmark_price_differential double""",
    "dim_products": """
        product_id string, product_name string, product_category string, product_grade string,
        density_min double, density_max double, sulfur_max_ppm int, typical_yield_pct double,
        unit_of_measure string""",
    "dim_sensors": """
        sensor_id string, unit_id string, refinery_id string, sensor_name string, sensor_type string,
        measurement_unit string, min_value double, max_value double, warning_low double,
        warning_high double, critical_low double, critical_high double,
        reading_interval_seconds int, manufacturer string, model string, installation_date date,
        calibration_date date, is_active boolean""",
    "fact_sensor_readings": """
        reading_id string, sensor_id string, unit_id string, refinery_id string,
        reading_timestamp timestamp, reading_value double, reading_quality string,
        is_interpolated boolean, event_time timestamp, processing_time timestamp""",
    "fact_crude_shipments": """
        shipment_id string, refinery_id string, crude_type_id string, supplier_id string,
        vessel_name string, transport_mode string, origin_port string, shipment_date date,
        arrival_date date, expected_arrival_date date, volume_barrels int,
        api_gravity_actual double, sulfur_content_actual double, water_content_pct double,
        price_per_barrel double, total_cost double, destination_tank_id string, status string,
        created_at timestamp, updated_at timestamp""",
    "fact_quality_tests": """
        test_id string, refinery_id string, sample_source_type string, sample_source_id string,
        tank_id string, test_datetime timestamp, test_type string, technician_id string,
        api_gravity double, sulfur_content_pct double, water_sediment_pct double,
        viscosity_cst double, pour_point_f double, reid_vapor_pressure double,
        octane_number double, cetane_number double, flash_point_f double,
        test_result_status string, notes string""",
    "fact_tank_inventory": """
        inventory_id string, tank_id string, refinery_id string, measurement_timestamp timestamp,
        volume_barrels int, fill_percentage double, temperature_f double,
        water_bottom_inches double, product_type string, crude_type_id string, product_id string,
        measurement_method string, is_verified boolean""",
    "fact_production_output": """
        output_id string, unit_id string, refinery_id string, production_hour timestamp,
        input_volume_barrels int, input_crude_type_id string, output_product_id string,
        output_volume_barrels int, yield_percentage double, energy_consumed_mmbtu double,
        operating_temperature_f double, operating_pressure_psi double, downtime_minutes int,
        quality_grade string, shift_id string""",
}

# Fields of one live reading as it arrives on the feed; times are ISO-8601 text.
READING_RECORD = """
    reading_id string, sensor_id string, unit_id string, refinery_id string, sensor_type string,
    measurement_unit string, reading_timestamp string, reading_value double,
    reading_quality string, is_anomaly boolean, is_interpolated boolean, event_time string,
    processing_time string"""


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def table_schema(name: str) -> T.StructType:
    return struct(PLANT_TABLES[name])


def column_names(name: str) -> list[str]:
    return table_schema(name).fieldNames()
