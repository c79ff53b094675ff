from meterlake.operators.gold import (  # noqa: F401
    build_gold_load_profile,
    build_gold_peak,
    build_gold_peak_ranked,
    peak_rank,
    peak_rows,
)
from meterlake.operators.quality import apply_zscore_quality_flag, feeder_baseline, gold_input  # noqa: F401
from meterlake.operators.silver import (  # noqa: F401
    build_silver,
    calendar_columns,
    geometry_xy,
    with_strict_composite_id,
)
