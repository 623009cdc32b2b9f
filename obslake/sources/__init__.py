from obslake.sources.files import list_files, list_incoming, reader_paths
from obslake.sources.observations import read_inferred, read_observations, read_rows
from obslake.sources.refined import query_refined, read_refined

__all__ = [
    "list_files",
    "list_incoming",
    "query_refined",
    "read_inferred",
    "read_observations",
    "read_refined",
    "read_rows",
    "reader_paths",
]
