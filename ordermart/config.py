"""Parameters of the jobs; defaults are the reference's values."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class CleanParams:
    start_date: str = "2022-01-01"      # valid order_date window, inclusive
    end_date: str = "2024-12-31"
    iqr_factor: float = 3.0             # bounds = Q1 - k*IQR, Q3 + k*IQR
    quantile_method: str = "exact"      # "exact" (bounded-memory exact) | "approx" (GK sketch)
    approx_relative_error: float = 0.01
    strip_all_offsets: bool = False     # also strip "-HH:MM" (reference strips only "+HH:MM" and "Z")
    max_broadcast_rows: int = 1_000_000  # dimension broadcast only below this checked size


@dataclass(frozen=True)
class MartParams:
    top_n: int = 10
    alert_drop_pct: float = 20.0
    alert_type: str = "revenue_drop"
    # KPI distinct customers: exact (shuffles every distinct id) or an HLL++ sketch with this
    # relative standard deviation (a few KB per task) for very high cardinality
    approx_customers_rsd: float | None = None


@dataclass(frozen=True)
class ForecastParams:
    split_year: int = 2024              # train: year < split_year, test: year == split_year
    reg_param: float = 0.1
    elastic_net: float = 0.0
    max_iter: int = 50
    scaler_fit_on: str = "train"        # "train" (no leak) | "all" (reference behaviour)


@dataclass(frozen=True)
class Params:
    clean: CleanParams = CleanParams()
    marts: MartParams = MartParams()
    forecast: ForecastParams = ForecastParams()


REFERENCE = Params()

# The driver tables span 1995-01..2001-08, so the fixture runs on a window that fits them.
FIXTURE = Params(
    clean=replace(CleanParams(), start_date="1996-01-01", end_date="2000-12-31"),
    forecast=replace(ForecastParams(), split_year=2000),
)
