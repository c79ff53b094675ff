from meterlake.sources.bronze import (  # noqa: F401
    date_range_slice,
    parquet_profile,
    preview,
    read_bronze,
    readings_at_instant,
    run_date_slice,
    silver_profile,
    source_date_profile,
)
from meterlake.sources.fixtures import readings  # noqa: F401
