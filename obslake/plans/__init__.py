from obslake.plans.answers import (
    answer_or_default,
    answers_sql,
    current_answers,
    publish_answers,
    record_answers,
)
from obslake.plans.claims import Claim, ClaimLog
from obslake.plans.folders import changed_folders
from obslake.plans.ingest import batch_ingest, ingest_files, resume_batches, return_to_incoming
from obslake.plans.lake import Lake, Load, append_refined, drop_refined, ensure_database, read_table
from obslake.plans.ledger import compact_ledger, ingest_ledger
from obslake.plans.merging import merge_small_files
from obslake.plans.zones import lake_hottest_records, lake_maximum

__all__ = [
    "Claim",
    "ClaimLog",
    "Lake",
    "Load",
    "answer_or_default",
    "answers_sql",
    "append_refined",
    "batch_ingest",
    "changed_folders",
    "compact_ledger",
    "current_answers",
    "drop_refined",
    "ensure_database",
    "ingest_files",
    "ingest_ledger",
    "lake_hottest_records",
    "lake_maximum",
    "merge_small_files",
    "publish_answers",
    "read_table",
    "record_answers",
    "resume_batches",
    "return_to_incoming",
]
