from meterlake.functions.columns import (  # noqa: F401
    as_timestamp,
    coerce_numeric,
    composite_id,
    composite_id_strict,
    day_range,
    day_type,
    half_hour_slot,
    per_device,
    safe_double,
    slot_to_hhmm,
    try_double,
)
