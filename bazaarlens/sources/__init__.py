from bazaarlens.sources import schemas
from bazaarlens.sources.readers import (
    CLEAN_NAMES,
    clean,
    file_headers,
    list_tables,
    publish,
    read_csv,
    read_tables,
    register_tables,
    split_rejected,
    write_rejected,
)
from bazaarlens.sources.shared import new_folder, shared_dir

__all__ = [
    "CLEAN_NAMES",
    "clean",
    "file_headers",
    "list_tables",
    "new_folder",
    "publish",
    "read_csv",
    "read_tables",
    "register_tables",
    "schemas",
    "shared_dir",
    "split_rejected",
    "write_rejected",
]
