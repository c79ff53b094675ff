from meterlake.sinks.writers import (  # noqa: F401
    export_json,
    overwrite_partition,
    overwrite_partitions,
    partition_days,
    partition_path,
    register_tables,
    run_sql,
    table_catalog,
    write_run_log,
)
