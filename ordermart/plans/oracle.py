"""DuckDB SQL that recomputes every query from the driver tables, for the correctness gate.

Each query is ``WITH <shared chain> SELECT ...``; the chain re-derives the fixture feeds
straight from ``orders`` (skipping the JSON round trip), then cleans them with the same
rules as the Spark plans.  Money and ratio columns follow the same exact-decimal and
HALF_UP rounding rules as ``ordermart.functions.money``.
"""

from __future__ import annotations

from ordermart.config import FIXTURE, Params
from ordermart.constants import (
    CATEGORIES, FEATURE_COLUMNS, LABEL_COLUMN, LOWEST_TIER, N_PRODUCTS, N_SELLERS, REGIONS, STATUS_ALIASES, TIER_LIMITS,
    UNKNOWN_STATUS,
)


def rnd(expr: str, n: int) -> str:
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(28,10)), {n}) AS DOUBLE)"


def msum(expr: str) -> str:
    return f"CAST(ROUND({exact_sum(expr)}, 2) AS DOUBLE)"


def exact_sum(expr: str) -> str:
    return f"SUM(CAST(({expr}) AS DECIMAL(28,6)))"


def mavg(expr: str, n: int = 2) -> str:
    return rnd(f"CAST({exact_sum(expr)} AS DOUBLE) / COUNT({expr})", n)


def padded(number: str, width: int) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"lpad({text}, CAST(greatest(length({text}), {width}) AS INTEGER), '0')"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case_list(key: str, values) -> str:
    whens = " ".join(f"WHEN {i} THEN {q(v)}" for i, v in enumerate(values))
    return f"CASE {key} {whens} END"


def status_case(col: str) -> str:
    whens = " ".join(
        f"WHEN {col} IN ({', '.join(q(a) for a in aliases)}) THEN {q(canon)}"
        for canon, aliases in STATUS_ALIASES)
    return f"CASE {whens} ELSE {q(UNKNOWN_STATUS)} END"


def category_expr(col: str) -> str:
    arr = "[" + ", ".join(q(c) for c in CATEGORIES) + "]"
    return f"{arr}[CAST(('0x' || substr(md5({col}), 1, 8))::UBIGINT % {len(CATEGORIES)} AS INTEGER) + 1]"


def product_expr(col: str) -> str:
    return (f"'P' || lpad(CAST(('0x' || substr(md5({col}), 1, 8))::UBIGINT % {N_PRODUCTS} + 1 AS VARCHAR), 5, '0')")


def text(expr: str, kind: str) -> str:
    """A column as text that does not depend on the engine: numbers with four decimals."""
    if kind == "text":
        return f"CAST({expr} AS VARCHAR)"
    return f"CAST(CAST(ROUND(CAST({expr} AS DECIMAL(28,10)), 4) AS DECIMAL(28,4)) AS VARCHAR)"


def base_ctes(params: Params = FIXTURE) -> list[tuple[str, str]]:
    c = params.clean
    tier = (f"CASE WHEN i <= {TIER_LIMITS[0][0]} THEN {q(TIER_LIMITS[0][1])} "
            f"WHEN i <= {TIER_LIMITS[1][0]} THEN {q(TIER_LIMITS[1][1])} ELSE {q(LOWEST_TIER)} END")
    cols = ("order_id, seller_id, status, customer_id, region, total_amount, order_ts, "
            "order_date, data_source")
    return [
        ("b", """SELECT o_orderkey AS k, o_custkey AS ck, CAST(o_orderdate AS TIMESTAMP) AS od,
                 CAST(o_totalprice AS DOUBLE) AS px,
                 CASE WHEN o_orderkey % 5 < 3 THEN 'app' ELSE 'web' END AS src,
                 CASE WHEN o_orderkey % 10 = 9 THEN 201 + o_custkey // 3
                   ELSE 1 + (o_orderkey * 7 + o_custkey) % 200 END AS seller_no,
                 (o_orderkey * 31 + o_custkey) % 100 AS h
                 FROM orders"""),
        ("copies", """SELECT *, 0 AS cp FROM b
                      UNION ALL SELECT *, 1 AS cp FROM b WHERE k % 100 IN (42, 43, 44)"""),
        ("raw", f"""SELECT CAST(k AS VARCHAR) AS order_id, src,
            'S' || {padded('seller_no', 3)} AS seller_id,
            {_case_list('(seller_no - 1) % 5', REGIONS)} AS rgn,
            CASE WHEN k % 50 = 0 THEN NULL
              WHEN h < 68 THEN CASE ck % 5 WHEN 0 THEN 'completed' WHEN 1 THEN 'done'
                   WHEN 2 THEN 'success' WHEN 3 THEN 'paid'
                   ELSE (CASE WHEN src = 'app' THEN 'COMPLETED' ELSE 'complete' END) END
              WHEN h < 83 THEN CASE ck % 3 WHEN 0 THEN 'pending' WHEN 1 THEN 'processing'
                   ELSE 'in_progress' END
              WHEN h < 93 THEN CASE ck % 2 WHEN 0 THEN 'cancelled'
                   ELSE (CASE WHEN src = 'app' THEN 'CANCEL' ELSE 'cancel' END) END
              WHEN h < 98 THEN CASE ck % 2 WHEN 0 THEN 'returned' ELSE 'refund' END
              ELSE CASE ck % 2 WHEN 0 THEN 'unknown' ELSE 'other' END END AS st,
            CASE WHEN k % 33 = 5 THEN NULL ELSE 'C' || {padded('ck', 6)} END AS cust,
            CASE WHEN k % 25 = 3 OR (cp = 1 AND k % 100 = 43) THEN NULL
                 WHEN k % 100 = 7 THEN -px
                 WHEN k % 200 = 11 THEN CAST(CAST(px AS DECIMAL(18,2)) * 20 AS DOUBLE)
                 WHEN k % 16 = 5 THEN CAST(CAST(px AS DECIMAL(28,6)) + CAST(0.0049 AS DECIMAL(28,6)) AS DOUBLE)
                 ELSE px END AS amt,
            CASE WHEN cp = 1 AND k % 100 <> 42 THEN od + INTERVAL 1 HOUR ELSE od END AS ts,
            (cp = 1 AND k % 100 = 42) AS flag,
            ck % 10 AS tz
            FROM copies"""),
        ("raw_app", "SELECT * FROM raw WHERE src = 'app'"),
        ("raw_web", "SELECT * FROM raw WHERE src = 'web'"),
        ("app_rows", f"""SELECT order_id, seller_id, {status_case('st')} AS status,
            cust AS customer_id, CASE WHEN cust IS NULL THEN NULL ELSE rgn END AS region,
            amt AS total_amount, ts AS order_ts, CAST(ts AS DATE) AS order_date,
            'app' AS data_source FROM raw_app WHERE NOT flag"""),
        ("web_rows", f"""SELECT order_id, seller_id, {status_case('st')} AS status,
            COALESCE(cust, 'UNKNOWN') AS customer_id, rgn AS region,
            amt AS total_amount, ts AS order_ts, CAST(ts AS DATE) AS order_date,
            'web' AS data_source FROM raw_web WHERE NOT flag"""),
        ("combined", f"SELECT {cols} FROM app_rows UNION ALL SELECT {cols} FROM web_rows"),
        ("deduped", f"""SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY order_id
              ORDER BY (total_amount IS NULL) ASC, order_ts DESC NULLS LAST, data_source ASC,
              total_amount DESC NULLS LAST, seller_id ASC NULLS FIRST, status ASC NULLS FIRST,
              customer_id ASC NULLS FIRST, region ASC NULLS FIRST) AS rn FROM combined) t
            WHERE rn = 1"""),
        ("valid", f"""SELECT * FROM deduped WHERE order_date >= DATE '{c.start_date}'
              AND order_date <= DATE '{c.end_date}' AND total_amount > 0"""),
        ("quartiles", """SELECT quantile_cont(total_amount, 0.25) AS q1,
              quantile_cont(total_amount, 0.75) AS q3 FROM valid
              WHERE total_amount IS NOT NULL AND total_amount > 0"""),
        ("bounds", f"""SELECT q1, q3, q3 - q1 AS iqr, q1 - {float(c.iqr_factor)} * (q3 - q1) AS lower_bound,
              q3 + {float(c.iqr_factor)} * (q3 - q1) AS upper_bound FROM quartiles"""),
        ("clean", """SELECT * FROM valid WHERE total_amount IS NULL OR total_amount
              BETWEEN (SELECT lower_bound FROM bounds) AND (SELECT upper_bound FROM bounds)"""),
        ("sellers", f"""SELECT 'S' || {padded('i', 3)} AS seller_id, {tier} AS seller_type,
              {_case_list('(i - 1) % 5', REGIONS)} AS seller_region FROM range(1, {N_SELLERS + 1}) t(i)"""),
        ("enriched", """SELECT c.order_id, c.seller_id, c.status, c.customer_id,
              COALESCE(c.region, s.seller_region) AS region, c.total_amount, c.order_ts, c.order_date,
              s.seller_type, c.data_source FROM clean c LEFT JOIN sellers s ON c.seller_id = s.seller_id"""),
        ("processed", """SELECT order_id, seller_id, status, customer_id, region, total_amount, order_ts,
              order_date, seller_type, strftime(order_date, '%Y-%m') AS year_month,
              CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month,
              data_source FROM enriched"""),
        ("sales", f"""SELECT *, {category_expr('seller_id')} AS category,
              {product_expr('order_id')} AS product_id FROM processed"""),
        ("completed", "SELECT * FROM sales WHERE status = 'completed'"),
    ]


def with_chain(select_sql: str, extra: list[tuple[str, str]] | None = None,
               params: Params = FIXTURE) -> str:
    ctes = base_ctes(params) + list(extra or [])
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes)
    return f"WITH {body}\n{select_sql}"


# --- mart chains (the reference's own formulation, independent of the Spark folding) ---

def seller_monthly_ctes(src: str = "sales", p: str = "sm") -> list[tuple[str, str]]:
    return [
        (f"{p}_base", f"""SELECT seller_id, year_month, seller_type,
              {msum('total_amount')} AS monthly_revenue,
              {mavg('total_amount')} AS avg_order_value,
              COUNT(DISTINCT customer_id) AS unique_customers,
              COUNT(DISTINCT order_date) AS active_days
            FROM {src} WHERE status = 'completed' GROUP BY seller_id, year_month, seller_type"""),
        (f"{p}_cancel", f"""SELECT seller_id, year_month,
              {rnd("CAST(SUM(CASE WHEN status = 'cancelled' THEN 1 ELSE 0 END) AS DOUBLE) / CAST(NULLIF(COUNT(order_id), 0) AS DOUBLE) * 100", 4)} AS cancel_rate
            FROM {src} GROUP BY seller_id, year_month"""),
        (f"{p}_joined", f"""SELECT b.*, c.cancel_rate FROM {p}_base b
            LEFT JOIN {p}_cancel c ON b.seller_id = c.seller_id AND b.year_month = c.year_month"""),
        (f"{p}_lags", f"""SELECT *,
              lag(monthly_revenue, 1) OVER w AS lag1_revenue,
              lag(monthly_revenue, 2) OVER w AS lag2_revenue,
              lag(monthly_revenue, 3) OVER w AS lag3_revenue,
              lead(monthly_revenue, 1) OVER w AS next_month_revenue
            FROM {p}_joined WINDOW w AS (PARTITION BY seller_id ORDER BY year_month)"""),
        (f"{p}_monthly", f"""SELECT seller_id, year_month, seller_type, monthly_revenue, avg_order_value,
              cancel_rate, unique_customers, active_days, lag1_revenue, lag2_revenue, lag3_revenue,
              CASE WHEN lag1_revenue IS NOT NULL AND lag2_revenue IS NOT NULL AND lag3_revenue IS NOT NULL
                   THEN {rnd('(lag1_revenue + lag2_revenue + lag3_revenue) / 3', 2)} END AS revenue_ma3,
              CASE WHEN lag1_revenue IS NOT NULL
                   THEN {rnd('(monthly_revenue - lag1_revenue) / NULLIF(lag1_revenue, 0) * 100', 4)} END AS growth_rate,
              next_month_revenue,
              CAST(substr(year_month, 1, 4) AS INTEGER) AS year,
              CAST(substr(year_month, 6, 2) AS INTEGER) AS month
            FROM {p}_lags"""),
    ]


def mart_ctes(params: Params = FIXTURE) -> list[tuple[str, str]]:
    m = params.marts
    return seller_monthly_ctes("sales", "sm") + [
        ("seller_monthly", "SELECT * FROM sm_monthly"),
        ("revenue_by_category", f"""SELECT category, {msum('total_amount')} AS total_revenue,
              COUNT(order_id) AS order_count, {mavg('total_amount')} AS avg_revenue
            FROM completed GROUP BY category"""),
        ("monthly_totals", f"""SELECT year_month, {msum('total_amount')} AS total_revenue,
              COUNT(order_id) AS order_count FROM completed GROUP BY year_month"""),
        ("monthly_trend", f"""SELECT year_month, total_revenue, order_count,
              {rnd('(total_revenue - lag(total_revenue, 1) OVER (ORDER BY year_month)) / NULLIF(lag(total_revenue, 1) OVER (ORDER BY year_month), 0) * 100', 2)} AS mom_growth_pct
            FROM monthly_totals"""),
        ("product_totals", f"""SELECT product_id, COUNT(order_id) AS order_count,
              {msum('total_amount')} AS total_revenue FROM completed GROUP BY product_id"""),
        ("top_products", f"""SELECT CAST(row_number() OVER (ORDER BY order_count DESC, product_id) AS INTEGER) AS rank,
              product_id, 'Product ' || product_id AS product_name, order_count, total_revenue
            FROM (SELECT * FROM product_totals ORDER BY order_count DESC, product_id LIMIT {m.top_n}) t"""),
        ("alert_base", f"""SELECT seller_id, year_month, lag1_revenue AS prev_revenue, monthly_revenue AS curr_revenue,
              CASE WHEN lag1_revenue IS NOT NULL AND lag1_revenue > 0
                   THEN {rnd('(lag1_revenue - monthly_revenue) / lag1_revenue * 100', 2)} END AS drop_pct
            FROM seller_monthly"""),
        ("seller_alerts", f"""SELECT seller_id, year_month, {q(m.alert_type)} AS alert_type, prev_revenue,
              curr_revenue, drop_pct FROM alert_base WHERE drop_pct > {float(m.alert_drop_pct)}"""),
        ("kpi", f"""SELECT
              COALESCE({msum("CASE WHEN status = 'completed' THEN total_amount END")}, 0.0) AS total_gmv,
              COUNT(CASE WHEN status = 'completed' THEN 1 END) AS total_orders,
              (SELECT COUNT(*) FROM (SELECT DISTINCT customer_id FROM completed) d) AS unique_customers,
              (SELECT COUNT(*) FROM (SELECT DISTINCT seller_id FROM completed) d) AS active_sellers,
              COUNT(*) AS total_all,
              COUNT(CASE WHEN status = 'cancelled' THEN 1 END) AS cancelled
            FROM sales"""),
        ("kpi_wide", f"""SELECT total_gmv, total_orders, unique_customers, active_sellers,
              CASE WHEN total_orders > 0 THEN {rnd('total_gmv / CAST(total_orders AS DOUBLE)', 2)} ELSE 0.0 END AS avg_order_value,
              CASE WHEN total_all > 0 THEN {rnd('CAST(cancelled AS DOUBLE) / CAST(total_all AS DOUBLE) * 100', 4)} ELSE 0.0 END AS cancel_rate
            FROM kpi"""),
        ("kpi_summary", " UNION ALL ".join(
            f"SELECT '{k}' AS metric_name, CAST({k} AS DOUBLE) AS metric_value FROM kpi_wide"
            for k in ("total_gmv", "total_orders", "unique_customers", "active_sellers",
                      "avg_order_value", "cancel_rate"))),
    ]


def with_marts(select_sql: str, extra: list[tuple[str, str]] | None = None,
               params: Params = FIXTURE) -> str:
    return with_chain(select_sql, mart_ctes(params) + list(extra or []), params)


# --- forecast: the ridge regression solved in SQL ----------------------------------------

FEATURE_SQL = """SELECT *, CAST(CASE seller_type WHEN 'high_performer' THEN 2.0 WHEN 'average_seller' THEN 1.0
    ELSE 0.0 END AS DOUBLE) AS seller_type_enc FROM (SELECT * REPLACE (
      COALESCE(lag1_revenue, 0.0) AS lag1_revenue, COALESCE(lag2_revenue, 0.0) AS lag2_revenue,
      COALESCE(lag3_revenue, 0.0) AS lag3_revenue, COALESCE(revenue_ma3, 0.0) AS revenue_ma3,
      COALESCE(growth_rate, 0.0) AS growth_rate, COALESCE(cancel_rate, 0.0) AS cancel_rate)
    FROM seller_monthly) s WHERE next_month_revenue IS NOT NULL AND month IS NOT NULL
      AND monthly_revenue IS NOT NULL AND avg_order_value IS NOT NULL AND unique_customers IS NOT NULL
      AND active_days IS NOT NULL"""


def forecast_ctes(params: Params = FIXTURE) -> list[tuple[str, str]]:
    """Features, their moments on the training years, the normal equations of the ridge regression on
    standardised columns (one aggregate of all products), their solution by elimination (12 recursive
    steps), coefficients, test predictions and metrics."""
    f, y, p = FEATURE_COLUMNS, LABEL_COLUMN, params.forecast
    n = len(f)
    moments = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS mean_{i}, stddev_pop(CAST({c} AS DOUBLE)) AS std_{i}"
                        for i, c in enumerate([*f, y]))
    scaled = ", ".join(f"COALESCE((CAST({c} AS DOUBLE) - mean_{i}) / NULLIF(std_{i}, 0), 0.0) AS z{i}"
                       for i, c in enumerate([*f, y]))
    rows = ", ".join("[" + ", ".join(
        f"SUM(z{i} * z{j}) / COUNT(*)" + (f" + {p.reg_param} / MAX(std_{n})" if i == j else "") for j in range(n + 1)) + "]"
        for i in range(n))
    step = ("list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / r[k]) "
            "ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END)")
    weights = ", ".join(f"w[{i + 1}] AS w{i}" for i in range(n))
    predicted = f"mean_{n} + std_{n} * (" + " + ".join(
        f"w{i} * COALESCE((CAST({c} AS DOUBLE) - mean_{i}) / NULLIF(std_{i}, 0), 0.0)" for i, c in enumerate(f)) + ")"
    coefficients = " UNION ALL ".join(
        f"SELECT {i} AS place, {q(c)} AS feature, CASE WHEN std_{i} > 0 THEN w{i} * std_{n} * sqrt(n / (n - 1.0)) ELSE 0.0 END "
        f"AS exact FROM model" for i, c in enumerate(f))

    def metrics(where: str, name: str) -> str:
        e = f"predicted - {y}"
        return (f"SELECT sqrt(avg(({e}) * ({e}))) AS {name}rmse, avg(abs({e})) AS {name}mae, "
                f"1 - SUM(({e}) * ({e})) / (var_pop(CAST({y} AS DOUBLE)) * COUNT(*)) AS {name}r2, COUNT(*) AS {name}n "
                f"FROM scored WHERE {where}")
    return [
        ("features", FEATURE_SQL),
        ("train", f"SELECT * FROM features WHERE year < {p.split_year}"),
        ("moments", f"SELECT {moments}, CAST(COUNT(*) AS DOUBLE) AS n FROM train"),
        ("scaled", f"SELECT {scaled}, std_{n} FROM train, moments"),
        ("gram", f"SELECT [{rows}] AS m FROM scaled"),
        ("solved", f"SELECT 1 AS k, m FROM gram UNION ALL SELECT k + 1, {step} FROM solved WHERE k <= {n}"),
        ("model", f"SELECT {weights}, moments.* FROM (SELECT list_transform(m, lambda r: r[{n + 1}]) AS w FROM solved "
                  f"WHERE k = {n + 1}) s, moments"),
        ("coefficients", coefficients),
        ("scored", f"SELECT features.*, {predicted} AS predicted FROM features, model"),
        ("predictions", f"""SELECT seller_id, year_month, {y} AS actual_revenue, {rnd('predicted', 2)} AS predicted_revenue
            FROM scored WHERE year = {p.split_year}"""),
        ("metrics", f"""SELECT {rnd('rmse', 4)} AS rmse, {rnd('mae', 4)} AS mae, {rnd('r2', 6)} AS r2,
            {rnd('train_rmse', 4)} AS train_rmse, train_n AS n_train, n AS n_test
            FROM ({metrics(f'year = {p.split_year}', '')}) a, ({metrics(f'year < {p.split_year}', 'train_')}) b"""),
        ("importance", f"""SELECT feature, {rnd('exact', 4)} AS coefficient,
            CAST(row_number() OVER (ORDER BY abs(exact) DESC, feature) AS INTEGER) AS abs_rank FROM coefficients"""),
        ("residuals", """SELECT *, (predicted_revenue - actual_revenue) / NULLIF(actual_revenue, 0) * 100 AS residual_pct
            FROM predictions"""),
        ("chosen", """SELECT r.*, s.seller_type FROM residuals r LEFT JOIN sellers s ON r.seller_id = s.seller_id
            WHERE r.seller_id IN (SELECT DISTINCT seller_id FROM predictions ORDER BY seller_id LIMIT 3)"""),
    ]


def gram_term(name: str) -> str:
    """A column of the Gram matrix in SQL; the intercept's is 1."""
    return "1" if name == "one" else name


def with_forecast(select_sql: str, params: Params = FIXTURE) -> str:
    return with_marts(select_sql, forecast_ctes(params), params).replace("WITH ", "WITH RECURSIVE ", 1)
