from .tables import (append, append_batch, create_table, latest_version, load_insert_ignore, load_upsert, materialise,
                     month_folders, read_conflicts, read_table, register_table, superseded, write_csv, write_version)

__all__ = ["append", "append_batch", "create_table", "latest_version", "load_insert_ignore", "load_upsert", "materialise",
           "month_folders", "read_conflicts", "read_table", "register_table", "superseded", "write_csv", "write_version"]
