from shelfwise.functions.dates import days_before, month_start, previous_month_start
from shelfwise.functions.predicates import (
    alive, between, by_entities, by_prefix, exclude_vertical, in_month, non_key, not_dark,
    online, primary_rows, require, rolling, successful,
)
from shelfwise.functions.scalars import (
    field, in_euros, lower_not_like, or_default, platform_of, round2, safe_divide, sum_money,
    targeted_usecase1, targeted_usecase2, times, weighted_est_revenue,
)

__all__ = [
    "alive", "between", "by_entities", "by_prefix", "days_before", "exclude_vertical", "field",
    "in_euros", "in_month", "lower_not_like", "month_start", "non_key", "not_dark", "online", "or_default",
    "platform_of", "previous_month_start", "primary_rows", "require", "rolling", "round2",
    "safe_divide", "successful", "sum_money", "targeted_usecase1", "targeted_usecase2", "times",
    "weighted_est_revenue",
]
