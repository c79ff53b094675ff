from meterlake.streaming.incremental import start_incremental_transform, touched_days  # noqa: F401
