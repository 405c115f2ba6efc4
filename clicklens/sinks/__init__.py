from clicklens.sinks.writers import (
    as_jdbc_table,
    console,
    jdbc_append,
    latest_per_key,
    read_batch,
    read_batches,
    replace_partitions,
    replace_table,
    write_batch,
)

__all__ = ["as_jdbc_table", "console", "jdbc_append", "latest_per_key", "read_batch", "read_batches", "replace_partitions", "replace_table",
           "write_batch"]
