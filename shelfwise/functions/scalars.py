"""Column expressions. All are built-ins, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.config import PLATFORMS

# Default targeting limits.
MIN_SCORE = 50.0
MATURITY_FACTOR = 0.8
MISSING_THRESHOLD = 999999
MIN_UPLIFT_PCT = 1.0


def safe_divide(num: Column, den: Column) -> Column:
    """Double quotient; NULL where the divisor is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def or_default(c: Column, default) -> Column:
    return F.coalesce(c, F.lit(default))


def round2(c: Column) -> Column:
    """Round half away from zero at two decimals, once, on the decimal digits of the double."""
    return F.round(c.cast("decimal(38,15)"), 2).cast("double")


#: Euro amounts while they are added: fifteen decimals keep the digits of any double from 10 up.
MONEY = "decimal(38,15)"


def sum_money(c: Column) -> Column:
    """Sum of euro amounts as a decimal, the same for every task order and partitioning.

    Sums of sums stay decimal; ``in_euros`` makes the double that is shown or divided.
    """
    return F.sum(c.cast(MONEY))


def in_euros(c: Column) -> Column:
    return c.cast("double")


def times(amount: Column, factor: Column) -> Column:
    """A decimal amount by a small whole number, without losing decimals."""
    return amount.cast("decimal(30,15)") * factor.cast("decimal(7,0)")


def lower_not_like(c: Column, fragment: str) -> Column:
    """True where the lower-cased text lacks ``fragment``; NULL stays NULL."""
    return ~F.contains(F.lower(c), F.lit(fragment))


def field(path: str) -> Column:
    """Nested field by dotted path."""
    return F.col(path)


def weighted_est_revenue(rev_per_session: Column, sessions: Column) -> Column:
    return round2(rev_per_session * or_default(sessions, 0))


def _maturity_bar(threshold: Column, factor: float, missing: int) -> Column:
    return F.lit(float(factor)) * or_default(threshold, missing)


def targeted_usecase1(
    score: Column, skus: Column, threshold: Column, pct: Column, *,
    min_score: float = MIN_SCORE, factor: float = MATURITY_FACTOR,
    missing: int = MISSING_THRESHOLD, min_pct: float = MIN_UPLIFT_PCT,
) -> Column:
    """Healthy, broad enough, and with a gap that matters to its turnover."""
    bar = _maturity_bar(threshold, factor, missing)
    hit = (score >= min_score) & (or_default(skus, 0) >= bar) & (pct >= min_pct)
    return or_default(hit, False)


def targeted_usecase2(
    score: Column, skus: Column, threshold: Column, *,
    min_score: float = MIN_SCORE, factor: float = MATURITY_FACTOR,
    missing: int = MISSING_THRESHOLD,
) -> Column:
    """Healthy, but with too few active products."""
    bar = _maturity_bar(threshold, factor, missing)
    return or_default((score >= min_score) & (or_default(skus, 0) < bar), False)


def platform_of(entity: Column) -> Column:
    """Preset a market belongs to; NULL for unknown markets."""
    expr = F
    for name, markets in PLATFORMS.items():
        expr = expr.when(entity.isin(*markets), F.lit(name))
    return expr
