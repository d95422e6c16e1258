"""Sources (delimited text with quarantine) and sinks (contracts, publish)."""

from tallymart.sources.delimited import (
    failed_sources,
    ingest_report,
    quarantine,
    read_delimited,
    rejected_lines,
    stage_delimited,
    with_provenance,
)
from tallymart.sources.sink import conform, publish, publish_clustered, publish_partitions, read_table, recover_table

__all__ = [
    "conform",
    "failed_sources",
    "ingest_report",
    "publish",
    "publish_clustered",
    "publish_partitions",
    "quarantine",
    "read_delimited",
    "read_table",
    "recover_table",
    "rejected_lines",
    "stage_delimited",
    "with_provenance",
]
