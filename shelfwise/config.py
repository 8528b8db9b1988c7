"""Job parameters: market presets, time windows and thresholds."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, timedelta

# The market codes each preset selects.
PLATFORMS: dict[str, tuple[str, ...]] = {
    "py": (
        "PY_AR", "PY_CL", "PY_PE", "PY_VE", "PY_DO", "PY_UY", "PY_PY", "PY_EC",
        "PY_BO", "PY_CR", "PY_HN", "PY_SV", "PY_GT", "PY_NI", "AP_PA",
    ),
    "tb": ("TB_AE", "TB_QA", "TB_JO", "TB_KW", "TB_OM", "TB_BH", "TB_IQ", "HF_EG"),
    "hs": ("HS_SA",),
    "gv": (
        "GV_IT", "GV_ES", "GV_PT", "GV_UA", "GV_PL", "GV_RO", "GV_GE", "GV_KZ",
        "GV_HR", "GV_RS", "GV_BG", "GV_MA", "GV_CI", "GV_KE", "GV_UG", "GV_AM",
        "GV_BA", "GV_ME", "GV_KG", "GV_MD", "GV_NG", "GV_TN",
    ),
    "pd": (
        "FP_PK", "FP_BD", "FP_MY", "FP_PH", "FP_SG", "FP_KH", "FP_MM", "FP_LA",
        "FP_HK", "FP_TW", "DJ_CZ", "NP_HU", "OP_SE", "FO_NO", "MJM_AT", "YS_TR",
    ),
    "ef": ("EF_GR", "FY_CY"),
}


def previous_month(as_of: date) -> date:
    """First day of the calendar month before ``as_of``."""
    return (as_of.replace(day=1) - timedelta(days=1)).replace(day=1)


def _month_end(first: date) -> date:
    return (first + timedelta(days=31)).replace(day=1) - timedelta(days=1)


@dataclass(frozen=True)
class Period:
    """The three windows of a run. All bounds are inclusive."""

    report_month: date
    active_from: date
    active_to: date
    orders_from: date
    orders_to: date

    @classmethod
    def month(cls, any_day: date) -> Period:
        """Vendors, availability and orders all from one calendar month."""
        first = any_day.replace(day=1)
        last = _month_end(first)
        return cls(first, first, last, first, last)

    @classmethod
    def rolling(cls, as_of: date, orders_month: date, days: int = 30) -> Period:
        """Vendors of last month, availability of the last ``days`` days, orders of a named month."""
        first = orders_month.replace(day=1)
        return cls(
            previous_month(as_of),
            as_of - timedelta(days=days - 1),
            as_of,
            first,
            _month_end(first),
        )


@dataclass(frozen=True)
class GapParams:
    """Everything a gap run can be asked to do differently."""

    period: Period
    entities: tuple[str, ...] | None = None  # None = all markets
    order_vertical_exclude: str | None = None
    min_avg_revenue: float = 100.0
    min_avg_qty: float = 1.0  # exclusive
    min_chains: int = 2
    top_products: int = 10
    gaps_per_vendor: int = 3
    min_score: float = 50.0
    maturity_factor: float = 0.8
    missing_threshold: int = 999999
    min_uplift_pct: float = 1.0

    def with_(self, **changes) -> GapParams:
        return replace(self, **changes)

    @classmethod
    def preset(cls, platform: str, period: Period, **changes) -> GapParams:
        return cls(period=period, entities=PLATFORMS[platform], **changes)
