from plantlake.functions.rules import (  # noqa: F401
    anomaly_rate,
    available_capacity,
    clamp,
    days_delayed,
    fill_band,
    health_score,
    inventory_status,
    maintenance_status,
    needs_attention,
    operating_status,
    out_of_range,
    quality_label,
    safe_ratio,
    threshold_status,
    value_when,
    variance,
)
