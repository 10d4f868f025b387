from millrace.operators.aggregate import key_counts, reduce_by_key, totals_by_key
from millrace.operators.casts import cast_cases, cast_summary, fitting, try_target
from millrace.operators.dedupe import dedupe, dedupe_any
from millrace.operators.fold import fold_by_key
from millrace.operators.metrics import stage_row_counts
from millrace.operators.project import (
    default_time,
    fill_defaults,
    rename,
    require_not_null,
    select_columns,
    stamp,
    to_target,
    with_ones,
)
from millrace.operators.quality import (
    ORDER_RULES,
    Check,
    ColumnRule,
    ValidationError,
    Violation,
    failure_cases,
    failure_summary,
    greater_than,
    validate,
    watch,
)
from millrace.operators.sums import exact_sums
from millrace.operators.text import split_words, word_count, words

__all__ = [
    "ORDER_RULES",
    "Check",
    "ColumnRule",
    "ValidationError",
    "Violation",
    "cast_cases",
    "cast_summary",
    "dedupe",
    "dedupe_any",
    "default_time",
    "exact_sums",
    "failure_cases",
    "failure_summary",
    "fill_defaults",
    "fitting",
    "fold_by_key",
    "greater_than",
    "key_counts",
    "reduce_by_key",
    "rename",
    "require_not_null",
    "select_columns",
    "split_words",
    "stage_row_counts",
    "stamp",
    "to_target",
    "totals_by_key",
    "try_target",
    "validate",
    "watch",
    "with_ones",
    "word_count",
    "words",
]
