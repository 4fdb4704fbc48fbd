from tallyworks.sources.readers import read_csv, read_jdbc, read_partition, xml_rows
from tallyworks.sources.sinks import (
    commit_tables,
    committed_tables,
    committed_versions,
    drop_old_versions,
    partitioned_table,
    replace_partition,
    replace_partitions,
    rows_to_xml,
    save_intermediate,
    scratch_dir,
)
from tallyworks.sources.tables import Tables

__all__ = [
    "Tables",
    "commit_tables",
    "committed_tables",
    "committed_versions",
    "drop_old_versions",
    "read_csv",
    "read_jdbc",
    "read_partition",
    "partitioned_table",
    "replace_partition",
    "replace_partitions",
    "rows_to_xml",
    "save_intermediate",
    "scratch_dir",
    "xml_rows",
]
