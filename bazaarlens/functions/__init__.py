from bazaarlens.functions.dates import as_day, day_of, each_day, within_days
from bazaarlens.functions.numbers import (
    fixed_text,
    last_admitted_rank,
    ratio,
    threshold_text,
)
from bazaarlens.functions.statuses import StatusLabels, status_rank

__all__ = [
    "StatusLabels",
    "as_day",
    "day_of",
    "each_day",
    "fixed_text",
    "last_admitted_rank",
    "ratio",
    "status_rank",
    "threshold_text",
    "within_days",
]
