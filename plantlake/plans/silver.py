"""Cleansed datasets. Inputs may be batch frames or streams; dimensions are batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plantlake.functions import rules
from plantlake.operators.enrich import enrich_left, star_enrich, union_feeds
from plantlake.operators.project import active_only, derive_columns, stamped, valid_rows

SENSOR_LIMITS = ["warning_low", "warning_high", "critical_low", "critical_high"]
READING_COLUMNS = ["reading_id", "sensor_id", "unit_id", "refinery_id", "reading_timestamp",
                   "reading_value", "reading_quality", "event_time", "processing_time"]
HOURS_PER_DAY = 24.0


def silver_readings(feeds: list[DataFrame], sensors: DataFrame, null_flag_as_false: bool = False,
                    stamp: bool = True, **lookup_options) -> DataFrame:
    """Readings of active sensors from all feeds, classified against their limits."""
    columns = [c for c in READING_COLUMNS if c in feeds[0].columns]
    rows = union_feeds(*[f.select(*columns) for f in feeds])
    known = ["sensor_type", "measurement_unit", *SENSOR_LIMITS]
    joined = active_only(enrich_left(rows, sensors, "sensor_id",
                                     [*known, "min_value", "max_value", "is_active"], **lookup_options))
    status = rules.threshold_status("reading_value", *SENSOR_LIMITS)
    flag = rules.out_of_range("reading_value", "min_value", "max_value", null_flag_as_false)
    tail = [c for c in ("event_time", "processing_time") if c in columns]
    head = [c for c in columns if c not in tail]
    out = joined.select(*head, *known, status.alias("alert_status"), flag.alias("is_out_of_range"), *tail)
    return stamped(out, "silver_processed_at") if stamp else out


def silver_shipments(shipments: DataFrame, sites: DataFrame, crudes: DataFrame,
                     stamp: bool = True, **lookup_options) -> DataFrame:
    """Shipments with site and feed-grade attributes, quality variance, delay and unit cost."""
    joined = star_enrich(shipments, [
        (sites, "refinery_id", {"refinery_name": "refinery_name", "location_city": "location_city",
                                "location_state": "location_state", "capacity_bpd": "refinery_capacity_bpd"}),
        (crudes, "crude_type_id", {"crude_name": "crude_name", "classification": "crude_classification",
                                   "sweetness": "crude_sweetness",
                                   "api_gravity_typical": "api_gravity_typical",
                                   "sulfur_content_typical": "sulfur_content_typical"}),
    ], **lookup_options)
    out = derive_columns(joined, {
        "api_gravity_variance": rules.variance("api_gravity_actual", "api_gravity_typical"),
        "sulfur_variance": rules.variance("sulfur_content_actual", "sulfur_content_typical"),
        "days_delayed": rules.days_delayed("arrival_date", "expected_arrival_date"),
        "cost_per_barrel": rules.safe_ratio("total_cost", "volume_barrels"),
    })
    return stamped(out, "silver_processed_at") if stamp else out


def silver_production(production: DataFrame, units: DataFrame, sites: DataFrame, products: DataFrame,
                      crudes: DataFrame, stamp: bool = True, **lookup_options) -> DataFrame:
    """Production rows with four dimensions and the derived ratios."""
    joined = star_enrich(production, [
        (units, "unit_id", {"unit_name": "unit_name", "unit_type": "unit_type",
                            "design_efficiency": "design_efficiency", "capacity_bpd": "unit_capacity_bpd"}),
        (sites, "refinery_id", ["refinery_name"]),
        (products, {"output_product_id": "product_id"}, ["product_name", "product_category"]),
        (crudes, {"input_crude_type_id": "crude_type_id"}, ["crude_name"]),
    ], **lookup_options)
    out = derive_columns(joined, {
        "efficiency_ratio": rules.safe_ratio("yield_percentage", "design_efficiency"),
        "capacity_utilization": rules.safe_ratio("output_volume_barrels",
                                                 F.col("unit_capacity_bpd") / HOURS_PER_DAY),
        "energy_per_barrel": rules.safe_ratio("energy_consumed_mmbtu", "output_volume_barrels"),
    })
    return stamped(out, "silver_processed_at") if stamp else out


def silver_tank_inventory(inventory: DataFrame, stamp: bool = True) -> DataFrame:
    """Valid tank snapshots with level band, attention flag and free capacity."""
    rows = valid_rows(inventory, "volume_barrels", "fill_percentage")
    out = derive_columns(rows, {
        "inventory_status": rules.fill_band("fill_percentage"),
        "requires_attention": rules.needs_attention("fill_percentage", "water_bottom_inches"),
        "available_capacity_barrels": rules.available_capacity("fill_percentage", "volume_barrels"),
    })
    return stamped(out, "processed_at") if stamp else out
