"""Station observations on Spark: files in, one typed table, and its extremes."""

from obslake.operators import (
    Measure,
    check_headers,
    column_profile,
    hottest_answer,
    hottest_records,
    infer_types,
    late_records,
    max_temperature,
    running_answer_log,
    screen_files,
    to_canonical,
    union_by_name,
    union_by_position,
    with_lineage,
)
from obslake.plans import (
    ClaimLog,
    Lake,
    answer_or_default,
    append_refined,
    batch_ingest,
    changed_folders,
    compact_ledger,
    current_answers,
    drop_refined,
    ensure_database,
    ingest_ledger,
    lake_hottest_records,
    lake_maximum,
    merge_small_files,
    publish_answers,
    record_answers,
    resume_batches,
    return_to_incoming,
)
from obslake.session import build_session, work_dir
from obslake.sources import (
    list_incoming,
    query_refined,
    read_inferred,
    read_observations,
    read_refined,
    read_rows,
)
from obslake.streaming import stream_hottest, stream_improvements, stream_ingest

__all__ = [
    "ClaimLog",
    "Lake",
    "Measure",
    "answer_or_default",
    "append_refined",
    "batch_ingest",
    "build_session",
    "changed_folders",
    "check_headers",
    "column_profile",
    "compact_ledger",
    "current_answers",
    "drop_refined",
    "ensure_database",
    "hottest_answer",
    "hottest_records",
    "infer_types",
    "ingest_ledger",
    "lake_hottest_records",
    "lake_maximum",
    "late_records",
    "list_incoming",
    "merge_small_files",
    "max_temperature",
    "publish_answers",
    "query_refined",
    "read_inferred",
    "read_observations",
    "read_refined",
    "read_rows",
    "record_answers",
    "resume_batches",
    "return_to_incoming",
    "running_answer_log",
    "screen_files",
    "stream_hottest",
    "stream_improvements",
    "stream_ingest",
    "to_canonical",
    "union_by_name",
    "union_by_position",
    "with_lineage",
    "work_dir",
]
