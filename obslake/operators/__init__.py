from obslake.operators.extremes import hottest_answer, hottest_records, max_temperature, top_reading
from obslake.operators.improvements import running_answer_log
from obslake.operators.inference import infer_types, read_as
from obslake.operators.lateness import late_records
from obslake.operators.lineage import utc_stamp, with_lineage
from obslake.operators.measure import Measure
from obslake.operators.profile import column_profile
from obslake.operators.quality import (
    assess,
    check_headers,
    quarantined,
    screen_files,
    to_canonical,
)
from obslake.operators.setops import union_by_name, union_by_position

__all__ = [
    "Measure",
    "assess",
    "check_headers",
    "column_profile",
    "hottest_answer",
    "hottest_records",
    "infer_types",
    "late_records",
    "max_temperature",
    "quarantined",
    "read_as",
    "running_answer_log",
    "screen_files",
    "to_canonical",
    "top_reading",
    "union_by_name",
    "union_by_position",
    "utc_stamp",
    "with_lineage",
]
