"""Sources and sinks: the events adapter, tab-delimited loading, task
parameters, and the idempotent result writer."""

from roadlens.sources.events import area_from_region, passes_from_events, read_passes
from roadlens.sources.catalog import load_catalog, save_flow_catalog
from roadlens.sources.commit import commit_results, committed, publish, read_committed, recover
from roadlens.sources.files import load_tsv, read_flow_catalog, read_flow_table, read_tsv, write_tsv
from roadlens.sources.sink import read_result, write_jdbc, write_result
from roadlens.sources.tasks import parse_task_params, task_params

__all__ = [
    "area_from_region", "passes_from_events", "read_passes",
    "load_catalog", "read_flow_catalog", "save_flow_catalog",
    "commit_results", "committed", "publish", "read_committed", "recover",
    "load_tsv", "read_flow_table", "read_tsv", "write_tsv",
    "read_result", "write_jdbc", "write_result",
    "parse_task_params", "task_params",
]
