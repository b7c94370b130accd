"""Writers."""

from fumarole.sinks.writers import (
    as_stored, load_model, save_model, save_table, write_csv, write_json, write_parquet,
    write_partitioned,
)

__all__ = [
    "as_stored", "load_model", "save_model", "save_table", "write_csv", "write_json",
    "write_parquet", "write_partitioned",
]
