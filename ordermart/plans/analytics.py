"""Step 2 and 3 over one pipeline: marts (written once) and the forecast run."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from ordermart.operators import forecast as M
from ordermart.operators import marts as A
from ordermart.operators.joins import hot_keys
from ordermart.plans.clean import OrderPipeline
from ordermart.session import MATERIALIZE_LOCK, committed, fingerprint, scratch_path
from ordermart.sources.tables import write_bucketed, write_mart

MART_NAMES = ("seller_monthly", "revenue_by_category", "monthly_trend", "top_products",
              "kpi_summary", "seller_alerts")


class Analytics:
    """Lazy marts over a pipeline's ``sales`` frame; ``build`` writes them as Parquet."""

    def __init__(self, pipe: OrderPipeline, run_tag: str = ""):
        self.pipe = pipe
        self.run_tag = run_tag
        self.params = pipe.params
        self._forecast: M.ForecastRun | None = None

    @property
    def spark(self):
        return self.pipe.spark

    def sales(self) -> DataFrame:
        return self.pipe.sales()

    def completed(self) -> DataFrame:
        return A.completed_orders(self.sales())

    def revenue_by_category(self) -> DataFrame:
        return A.revenue_by_category(self.completed())

    def monthly_trend(self) -> DataFrame:
        return A.monthly_trend(self.completed())

    def top_products(self) -> DataFrame:
        return A.top_products(self.completed(), self.params.marts.top_n)

    def seller_monthly(self) -> DataFrame:
        return A.seller_monthly(self.sales())

    def cube(self) -> DataFrame:
        """The stored seller x month aggregate."""
        with MATERIALIZE_LOCK:
            return stored_cube(self.spark, self.sales(), self.marts_root, skip_committed=True)

    def sales_by_seller(self, max_share: float = 0.1) -> DataFrame:
        """``sales`` bucketed and sorted by seller, written once; ``sales`` itself where a seller holds
        ``max_share`` or more of all orders, which would make one bucket that large."""
        with MATERIALIZE_LOCK:
            buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions", "200"))
            name = "sales_by_seller_" + fingerprint(self.pipe.processed_path, buckets, self.run_tag)
            if not self.spark.catalog.tableExists(name):
                if hot_keys(self.sales(), "seller_id", "order_id", max_share, buckets):
                    return self.sales()
                path = scratch_path(self.spark, "bucketed", f"{name}-{uuid.uuid4().hex}")
                write_bucketed(self.sales(), name, path, "seller_id", ["year_month"], buckets)
            return self.spark.table(name)

    def customer_bitmaps(self) -> DataFrame:
        """The stored customer sets of each month."""
        with MATERIALIZE_LOCK:
            return stored_bitmaps(self.spark, self.sales(), self.marts_root, skip_committed=True)

    def kpi_summary(self) -> DataFrame:
        return A.kpi_summary_from_cube(self.cube(), A.customers_of(self.customer_bitmaps()))

    def seller_alerts(self, monthly: DataFrame | None = None) -> DataFrame:
        m = self.params.marts
        return A.seller_alerts(monthly if monthly is not None else self.seller_monthly(),
                               m.alert_drop_pct, m.alert_type)

    # --- written marts ------------------------------------------------------------
    @property
    def marts_root(self) -> str:
        return scratch_path(self.spark, "marts", fingerprint(self.pipe.processed_path, self.params,
                                                               self.run_tag))

    def build(self) -> dict[str, str]:
        """Write all step-2 marts (once) under ``marts_root``; see ``write_marts``."""
        with MATERIALIZE_LOCK:
            return write_marts(self.spark, self.sales(), self.marts_root, self.params, skip_committed=True)

    def mart(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.build()[name])

    # --- forecast -----------------------------------------------------------------
    def features(self) -> DataFrame:
        return M.feature_frame(self.mart("seller_monthly"))

    def forecast(self) -> M.ForecastRun:
        if self._forecast is None:
            self._forecast = M.fit_forecast(self.features(), self.params.forecast)
        return self._forecast

    def predictions(self) -> DataFrame:
        return M.seller_predictions(self.forecast())


def stored_cube(spark, sales: DataFrame, root: str, skip_committed: bool = False, path: str | None = None) -> DataFrame:
    path = path or f"{root}/_seller_month_cube"
    if not (skip_committed and committed(spark, path)):
        A.seller_month_cube(sales).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stored_bitmaps(spark, sales: DataFrame, root: str, skip_committed: bool = False) -> DataFrame:
    """Numbers of the customers, then their monthly bitmaps: both written, the numbers once."""
    numbers, path = f"{root}/_customer_numbers", f"{root}/_customer_bitmaps"
    if not (skip_committed and committed(spark, path)):
        done = A.completed_orders(sales)
        if not (skip_committed and committed(spark, numbers)):
            A.numbered_customers(done).write.mode("overwrite").parquet(numbers)
        A.customer_bitmaps(done, spark.read.parquet(numbers)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_marts(spark, sales: DataFrame, root: str, params, skip_committed: bool = False,
                cube_path: str | None = None) -> dict[str, str]:
    """Write the six step-2 marts under ``root``.

    The fact is scanned for the seller x month cube (exact revenue, status counts, distinct customers,
    active days), which the seller-month, category, month and KPI marts re-aggregate; for the product
    totals; and for the distinct customers: their monthly bitmaps (two pruned scans, kept beside the
    marts for later KPIs), or one sketch where ``approx_customers_rsd`` asks for it.  seller_alerts
    reads the written seller_monthly; marts that need nothing of each other are written at once.
    """
    root = root.rstrip("/")
    paths = {name: f"{root}/{name}" for name in MART_NAMES}
    missing = [n for n in MART_NAMES if not (skip_committed and committed(spark, paths[n]))]
    if not missing:
        return paths
    cube = stored_cube(spark, sales, root, skip_committed, cube_path)
    m = params.marts

    def customers() -> DataFrame:
        if m.approx_customers_rsd is None:
            return A.customers_of(stored_bitmaps(spark, sales, root, skip_committed))
        return A.approx_customers(sales, m.approx_customers_rsd)

    builders = {
        "seller_monthly": lambda: A.seller_monthly_from_cube(cube),
        "revenue_by_category": lambda: A.revenue_by_category_from_cube(cube),
        "monthly_trend": lambda: A.monthly_trend_from_cube(cube),
        "top_products": lambda: A.top_products(A.completed_orders(sales), m.top_n),
        "kpi_summary": lambda: A.kpi_summary_from_cube(cube, customers()),
        "seller_alerts": lambda: A.seller_alerts(spark.read.parquet(f"{root}/seller_monthly"),
                                                 m.alert_drop_pct, m.alert_type),
    }
    def write(names) -> None:
        for name in names:
            if name in missing:
                write_mart(builders[name](), root, name)

    # marts that do not read each other are written side by side: their small jobs share the cluster
    chains = [("seller_monthly", "seller_alerts"), ("revenue_by_category",), ("monthly_trend",), ("top_products",), ("kpi_summary",)]
    with ThreadPoolExecutor(len(chains)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(partial(write, names))) for names in chains]:
            done.result()
    return paths


_ANALYTICS: dict = {}


def analytics(pipe: OrderPipeline) -> Analytics:
    key = id(pipe)
    with MATERIALIZE_LOCK:
        if key not in _ANALYTICS:
            _ANALYTICS[key] = Analytics(pipe)
        return _ANALYTICS[key]


__all__ = ["Analytics", "analytics", "write_marts", "MART_NAMES"]
