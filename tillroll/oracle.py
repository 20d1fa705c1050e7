"""Oracle SQL (DuckDB dialect) for every registered query.

The driver runs these against the same parquet tables registered as views and
compares them with the Spark results. They restate the model mapping and each
operator independently in SQL; they are a test oracle, not used by the library.
Money sums are exact DECIMAL(20,6) sums, doubles are published with
``round(x * 10^d) / 10^d``, exactly as the Spark side does.
"""

from __future__ import annotations


def r(expr: str, digits: int = 2) -> str:
    # "+ 0.0" turns a rounded -0.0 into 0.0, as Spark's decimal rounding does.
    s = f"1{'0' * digits}.0"
    return f"(round(({expr}) * {s}) / {s} + CAST(0 AS DOUBLE))"


def msum(expr: str) -> str:
    return f"CAST(sum(CAST({expr} AS DECIMAL(20,6))) AS DOUBLE)"


def mavg(expr: str) -> str:
    return f"({msum(expr)} / CAST(count({expr}) AS DOUBLE))"


def _star(suffix: str = "") -> str:
    return f"""
transactions{suffix} AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS transaction_id,
         o_custkey AS customer_id,
         l_partkey AS product_id,
         CAST(trunc(l_quantity) AS INTEGER) AS quantity,
         l_extendedprice / NULLIF(l_quantity, 0) AS unit_price,
         l_extendedprice * l_discount AS discount_amount,
         l_extendedprice * (CAST(1 AS DOUBLE) - l_discount) AS total_amount,
         o_orderdate AS transaction_date,
         CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending'
              WHEN 'P' THEN 'Processing' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
customers{suffix} AS (
  SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS customer_segment,
         n_name AS country,
         CASE WHEN c_acctbal < 0 THEN '18-24' WHEN c_acctbal < 2500 THEN '25-34'
              WHEN c_acctbal < 5000 THEN '35-44' WHEN c_acctbal < 7500 THEN '45-54'
              ELSE '55+' END AS age_group,
         CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS registration_date
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
products{suffix} AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         list_extract(string_split(p_name, ' '), 2) AS subcategory, p_brand AS brand,
         p_retailprice AS price, p_retailprice * CAST(0.6 AS DOUBLE) AS cost
  FROM part)"""


ENRICHED = """
enriched AS (
  SELECT t.*, c.customer_segment, c.country, c.age_group, c.registration_date,
         p.category, p.subcategory, p.brand, p.cost,
         CAST(year(t.transaction_date) AS INTEGER) AS year,
         CAST(month(t.transaction_date) AS INTEGER) AS month,
         CAST(quarter(t.transaction_date) AS INTEGER) AS quarter,
         CAST(dayofweek(t.transaction_date) + 1 AS INTEGER) AS day_of_week,
         CAST(hour(t.transaction_date) AS INTEGER) AS hour,
         t.total_amount - t.quantity * p.cost AS profit_amount,
         CASE WHEN t.total_amount > 0
              THEN (t.total_amount - t.quantity * p.cost) / t.total_amount * CAST(100 AS DOUBLE)
              ELSE CAST(0 AS DOUBLE) END AS profit_margin,
         CAST(date_diff('day', CAST(c.registration_date AS DATE),
                   CAST(t.transaction_date AS DATE)) AS INTEGER) AS customer_tenure_days
  FROM transactions t
  LEFT JOIN customers c ON t.customer_id = c.customer_id
  LEFT JOIN products p ON t.product_id = p.product_id
  WHERE t.status = 'Completed')
"""

MODEL = _star() + "," + ENRICHED


def with_model(body: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {MODEL}{extra}\n{body}"


def _pct_change(cur: str, prev: str) -> str:
    return f"(CAST({cur} AS DOUBLE) - {prev}) / NULLIF({prev}, 0) * CAST(100 AS DOUBLE)"


def _round_select(cols: list[tuple[str, str, int | None]]) -> str:
    """cols: (expression, alias, digits or None for non-double)."""
    parts = []
    for expr, alias, digits in cols:
        parts.append(f"{r(expr, digits) if digits is not None else expr} AS {alias}")
    return ",\n       ".join(parts)


ENRICHED_COLS = [
    ("transaction_id", None), ("customer_id", None), ("product_id", None), ("quantity", None),
    ("unit_price", 6), ("discount_amount", 6), ("total_amount", 6), ("transaction_date", None),
    ("status", None), ("customer_segment", None), ("country", None), ("age_group", None),
    ("registration_date", None), ("category", None), ("subcategory", None), ("brand", None),
    ("cost", 6), ("year", None), ("month", None), ("quarter", None), ("day_of_week", None),
    ("hour", None), ("profit_amount", 6), ("profit_margin", 6), ("customer_tenure_days", None),
]


def sql_enriched_transactions() -> str:
    sel = _round_select([(c, c, d) for c, d in ENRICHED_COLS])
    return with_model(f"SELECT {sel}\nFROM enriched")


def sql_monthly_series() -> str:
    m = f"""monthly AS (
  SELECT year, month, {msum('total_amount')} AS monthly_revenue,
         {msum('profit_amount')} AS monthly_profit,
         count(transaction_id) AS monthly_transactions,
         count(DISTINCT customer_id) AS monthly_active_customers,
         count(DISTINCT product_id) AS monthly_products_sold
  FROM enriched GROUP BY year, month)"""
    body = f"""SELECT year, month, {r('monthly_revenue')} AS monthly_revenue,
       {r('monthly_profit')} AS monthly_profit, monthly_transactions,
       monthly_active_customers, monthly_products_sold,
       {r(_pct_change('monthly_revenue', 'lag(monthly_revenue) OVER (ORDER BY year, month)'))} AS mom_revenue_growth,
       {r(_pct_change('monthly_active_customers', 'lag(monthly_active_customers) OVER (ORDER BY year, month)'))} AS mom_customer_growth
FROM monthly"""
    return with_model(body, m)


def _by_period(column: str, name: str) -> str:
    levels = [("day", "CAST(transaction_date AS DATE)"), *[
        (lv, f"CAST(date_trunc('{lv}', transaction_date) AS DATE)") for lv in ("month", "quarter", "year")],
        ("all", "CAST(NULL AS DATE)")]
    return with_model("\nUNION ALL ".join(
        f"SELECT '{lv}' AS period_level, {start} AS period_start, count(DISTINCT {column}) AS {name} "
        f"FROM enriched GROUP BY 1, 2" for lv, start in levels))


def sql_active_customers_by_period() -> str:
    return _by_period("customer_id", "active_customers")


def sql_products_sold_by_period() -> str:
    return _by_period("product_id", "products_sold")


def sql_weekday_series() -> str:
    d = f"""daily AS (
  SELECT year, month, day_of_week, {msum('total_amount')} AS daily_revenue,
         {msum('profit_amount')} AS daily_profit,
         count(transaction_id) AS daily_transactions,
         count(DISTINCT customer_id) AS daily_unique_customers,
         {mavg('total_amount')} AS daily_avg_order_value
  FROM enriched GROUP BY year, month, day_of_week)"""
    w = "OVER (PARTITION BY day_of_week ORDER BY year, month)"
    body = f"""SELECT year, month, day_of_week, {r('daily_revenue')} AS daily_revenue,
       {r('daily_profit')} AS daily_profit, daily_transactions, daily_unique_customers,
       {r('daily_avg_order_value')} AS daily_avg_order_value,
       {r(_pct_change('daily_revenue', f'lag(daily_revenue) {w}'))} AS revenue_growth_rate
FROM daily"""
    return with_model(body, d)




def D(x) -> str:
    return f"CAST({x} AS DOUBLE)"


def _sel(cols: list[tuple[str, int | None]], src: str = "") -> str:
    p = f"{src}." if src else ""
    return ",\n       ".join(f"{r(p + c, d)} AS {c}" if d is not None else f"{p}{c} AS {c}"
                             for c, d in cols)


# --- customers ----------------------------------------------------------------
LIFETIME_CTES = [
    f"""per_customer AS (
  SELECT customer_id, {msum('total_amount')} AS total_spent,
         {mavg('total_amount')} AS avg_order_value,
         {msum('profit_amount')} AS total_profit_generated,
         count(transaction_id) AS total_orders,
         count(DISTINCT product_id) AS unique_products_purchased,
         count(DISTINCT category) AS categories_explored,
         max(transaction_date) AS last_purchase_date, min(transaction_date) AS first_purchase_date,
         max(customer_segment) AS customer_segment, max(country) AS country,
         max(age_group) AS age_group
  FROM enriched GROUP BY customer_id)""",
    """lt1 AS (
  SELECT p.*, CAST(date_diff('day', CAST(last_purchase_date AS DATE),
                        CAST((SELECT max(transaction_date) FROM enriched) AS DATE)) AS INTEGER) AS days_since_last_purchase,
         CAST(date_diff('day', CAST(first_purchase_date AS DATE), CAST(last_purchase_date AS DATE)) AS INTEGER) AS customer_lifespan_days
  FROM per_customer p)""",
    """lt2 AS (
  SELECT lt1.*, CASE WHEN customer_lifespan_days > 0
                     THEN total_orders / (customer_lifespan_days / CAST(30 AS DOUBLE))
                     ELSE CAST(total_orders AS DOUBLE) END AS purchase_frequency
  FROM lt1)""",
    """lifetime AS (
  SELECT lt2.*, avg_order_value * purchase_frequency * (customer_lifespan_days / CAST(365 AS DOUBLE)) AS estimated_clv
  FROM lt2)""",
    """clv_cuts AS (
  SELECT quantile_disc(estimated_clv, 0.8) AS p80, quantile_disc(estimated_clv, 0.6) AS p60,
         quantile_disc(estimated_clv, 0.4) AS p40 FROM lifetime)""",
    """clv AS (
  SELECT l.*, CASE WHEN estimated_clv >= p80 THEN 'Champions'
                   WHEN estimated_clv >= p60 THEN 'Loyal Customers'
                   WHEN estimated_clv >= p40 THEN 'Potential Loyalists'
                   ELSE 'New Customers' END AS clv_segment
  FROM lifetime l, clv_cuts)""",
    """churn AS (
  SELECT c.*,
    CASE WHEN days_since_last_purchase > 90 THEN 'High' WHEN days_since_last_purchase > 60 THEN 'Medium'
         WHEN days_since_last_purchase > 30 THEN 'Low' ELSE 'Very Low' END AS days_since_last_purchase_risk,
    CASE WHEN total_orders = 1 THEN 'High' WHEN total_orders <= 3 THEN 'Medium' ELSE 'Low' END AS frequency_risk,
    CASE WHEN categories_explored = 1 THEN 'High' WHEN categories_explored <= 2 THEN 'Medium'
         ELSE 'Low' END AS engagement_risk
  FROM clv c)""",
    """churn2 AS (
  SELECT churn.*, CAST((CASE WHEN days_since_last_purchase_risk = 'High' THEN 3 ELSE 0 END)
                  + (CASE WHEN frequency_risk = 'High' THEN 2 ELSE 0 END)
                  + (CASE WHEN engagement_risk = 'High' THEN 1 ELSE 0 END) AS INTEGER) AS churn_risk_score
  FROM churn)""",
    """churn3 AS (
  SELECT churn2.*, CASE WHEN churn_risk_score >= 4 THEN 'Critical' WHEN churn_risk_score >= 2 THEN 'High'
                        WHEN churn_risk_score >= 1 THEN 'Medium' ELSE 'Low' END AS churn_risk_level
  FROM churn2)""",
    """churn4 AS (
  SELECT churn3.*, CASE churn_risk_level
      WHEN 'Critical' THEN 'Immediate personal outreach + special offer'
      WHEN 'High' THEN 'Targeted email campaign + discount'
      WHEN 'Medium' THEN 'Newsletter + product recommendations'
      ELSE 'Standard marketing communications' END AS recommended_intervention
  FROM churn3)""",
]

LIFETIME_COLS = [
    ("customer_id", None), ("total_spent", 2), ("avg_order_value", 2),
    ("total_profit_generated", 2), ("total_orders", None), ("unique_products_purchased", None),
    ("categories_explored", None), ("last_purchase_date", None), ("first_purchase_date", None),
    ("customer_segment", None), ("country", None), ("age_group", None),
    ("days_since_last_purchase", None), ("customer_lifespan_days", None),
    ("purchase_frequency", 2), ("estimated_clv", 2),
]
CHURN_COLS = [("days_since_last_purchase_risk", None), ("frequency_risk", None),
              ("engagement_risk", None), ("churn_risk_score", None), ("churn_risk_level", None),
              ("recommended_intervention", None)]


def sql_customer_lifetime() -> str:
    return with_model(f"SELECT {_sel(LIFETIME_COLS)}\nFROM lifetime", *LIFETIME_CTES)


def sql_clv_segments() -> str:
    return with_model(f"SELECT {_sel(LIFETIME_COLS + [('clv_segment', None)])}\nFROM clv",
                      *LIFETIME_CTES)


def sql_churn_indicators() -> str:
    cols = LIFETIME_COLS + [("clv_segment", None)] + CHURN_COLS
    return with_model(f"SELECT {_sel(cols)}\nFROM churn4", *LIFETIME_CTES)


# --- RFM ----------------------------------------------------------------------
RFM_CTES = [
    f"""rfm_per AS (
  SELECT customer_id, max(transaction_date) AS last_ts, count(transaction_id) AS frequency,
         {msum('total_amount')} AS monetary
  FROM enriched GROUP BY customer_id)""",
    """rfm_base AS (
  SELECT customer_id,
         CAST(date_diff('day', CAST(last_ts AS DATE), CAST((SELECT max(transaction_date) FROM enriched) AS DATE)) AS INTEGER) AS recency,
         frequency, monetary
  FROM rfm_per)""",
    """rfm_q AS (
  SELECT quantile_disc(recency, [0.2, 0.4, 0.6, 0.8]) AS rq,
         quantile_disc(frequency, [0.2, 0.4, 0.6, 0.8]) AS fq,
         quantile_disc(monetary, [0.2, 0.4, 0.6, 0.8]) AS mq
  FROM rfm_base)""",
    """rfm_scored AS (
  SELECT b.*,
    CASE WHEN recency <= rq[1] THEN 5 WHEN recency <= rq[2] THEN 4 WHEN recency <= rq[3] THEN 3
         WHEN recency <= rq[4] THEN 2 ELSE 1 END AS r_score,
    CASE WHEN frequency >= fq[4] THEN 5 WHEN frequency >= fq[3] THEN 4 WHEN frequency >= fq[2] THEN 3
         WHEN frequency >= fq[1] THEN 2 ELSE 1 END AS f_score,
    CASE WHEN monetary >= mq[4] THEN 5 WHEN monetary >= mq[3] THEN 4 WHEN monetary >= mq[2] THEN 3
         WHEN monetary >= mq[1] THEN 2 ELSE 1 END AS m_score
  FROM rfm_base b, rfm_q)""",
    """rfm_seg AS (
  SELECT s.*,
    CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
         WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal Customers'
         WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customers'
         WHEN r_score >= 3 AND f_score <= 2 AND m_score >= 3 THEN 'Potential Loyalists'
         WHEN r_score <= 2 AND f_score >= 3 AND m_score >= 3 THEN 'At Risk'
         WHEN r_score <= 2 AND f_score <= 2 AND m_score >= 3 THEN 'Cannot Lose Them'
         WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Hibernating'
         ELSE 'Others' END AS rfm_segment,
    concat(r_score, f_score, m_score) AS rfm_score
  FROM rfm_scored s)""",
    """rfm_final AS (
  SELECT rfm_seg.*, CASE rfm_segment
      WHEN 'Champions' THEN 'Reward them. They can become advocates.'
      WHEN 'Loyal Customers' THEN 'Upsell higher value products.'
      WHEN 'New Customers' THEN 'Provide onboarding support.'
      WHEN 'At Risk' THEN 'Send personalized reactivation campaigns.'
      WHEN 'Cannot Lose Them' THEN 'Win them back via renewals or newer products.'
      ELSE 'Re-engage with special offers.' END AS recommended_action
  FROM rfm_seg)""",
]


def sql_rfm_base() -> str:
    return with_model(f"SELECT customer_id, recency, frequency, {r('monetary')} AS monetary\n"
                      f"FROM rfm_base", *RFM_CTES[:2])


def sql_rfm_quintiles() -> str:
    parts = []
    for dim, lst in (("recency", "rq"), ("frequency", "fq"), ("monetary", "mq")):
        for i, p in enumerate((0.2, 0.4, 0.6, 0.8), start=1):
            parts.append(f"SELECT '{dim}' AS dimension, {r(D(p))} AS quantile, "
                         f"{r(D(f'{lst}[{i}]'))} AS cut_point FROM rfm_q")
    return with_model("\nUNION ALL ".join(parts), *RFM_CTES[:3])


def sql_rfm_segments() -> str:
    cols = [("customer_id", None), ("recency", None), ("frequency", None), ("monetary", 2),
            ("r_score", None), ("f_score", None), ("m_score", None), ("rfm_segment", None),
            ("rfm_score", None), ("recommended_action", None)]
    return with_model(f"SELECT {_sel(cols)}\nFROM rfm_final", *RFM_CTES)


def sql_rfm_segment_distribution() -> str:
    return with_model("SELECT rfm_segment, count(*) AS customer_count FROM rfm_final "
                      "GROUP BY rfm_segment", *RFM_CTES)


# --- products -----------------------------------------------------------------
PRODUCT_CTES = [f"""pm AS (
  SELECT product_id, category, subcategory, brand,
         CAST(sum(quantity) AS BIGINT) AS total_units_sold,
         {msum('total_amount')} AS total_revenue, {msum('profit_amount')} AS total_profit,
         count(transaction_id) AS total_transactions, count(DISTINCT customer_id) AS unique_customers,
         {mavg('total_amount')} AS avg_transaction_value, {mavg('profit_margin')} AS avg_profit_margin
  FROM enriched GROUP BY product_id, category, subcategory, brand)""",
                """pm2 AS (
  SELECT pm.*, total_revenue / NULLIF(unique_customers, 0) AS revenue_per_customer,
         CAST(total_units_sold AS DOUBLE) / NULLIF(total_transactions, 0) AS units_per_transaction,
         CAST(row_number() OVER (PARTITION BY category ORDER BY total_revenue DESC NULLS LAST,
                                 product_id ASC NULLS LAST) AS INTEGER) AS category_revenue_rank
  FROM pm)"""]


def sql_product_performance() -> str:
    cols = [("product_id", None), ("category", None), ("subcategory", None), ("brand", None),
            ("total_units_sold", None), ("total_revenue", 2), ("total_profit", 2),
            ("total_transactions", None), ("unique_customers", None),
            ("avg_transaction_value", 2), ("avg_profit_margin", 2), ("revenue_per_customer", 2),
            ("units_per_transaction", 2), ("category_revenue_rank", None)]
    return with_model(f"SELECT {_sel(cols)}, category_revenue_rank <= 5 AS is_top_performer\n"
                      f"FROM pm2", *PRODUCT_CTES)


def sql_top_products() -> str:
    return with_model(f"""SELECT product_id, category, {r('revenue')} AS revenue FROM (
  SELECT product_id, category, {msum('total_amount')} AS revenue
  FROM enriched GROUP BY product_id, category)
ORDER BY revenue DESC, product_id ASC LIMIT 10""")


# --- cohorts ------------------------------------------------------------------
def months_between(a: str, b: str) -> str:
    whole = f"CAST((year({a}) - year({b})) * 12 + month({a}) - month({b}) AS DOUBLE)"
    secs = (f"((day({a}) - day({b})) * 86400 + (epoch_us({a}) // 1000000) % 86400 "
            f"- (epoch_us({b}) // 1000000) % 86400)")
    frac = f"round({whole} + {secs} / CAST(2678400 AS DOUBLE), 8)"
    same = (f"day({a}) = day({b}) OR (day({a}) = day(last_day({a})) "
            f"AND day({b}) = day(last_day({b})))")
    return f"(CASE WHEN {same} THEN {whole} ELSE {frac} END)"


def _cohort(whole_months: bool) -> str:
    period = months_between("e.transaction_date", "f.first_purchase_date")
    if whole_months:
        period = f"CAST(floor({period}) AS DOUBLE)"
    ctes = [
        """first_p AS (
  SELECT customer_id, min(transaction_date) AS first_purchase_date,
         strftime(min(transaction_date), '%Y-%m') AS cohort_month
  FROM enriched WHERE customer_id IS NOT NULL GROUP BY customer_id)""",
        f"""cdata AS (
  SELECT e.customer_id, e.total_amount, f.cohort_month, {period} AS period_number
  FROM enriched e JOIN first_p f ON e.customer_id = f.customer_id)""",
        f"""cm AS (
  SELECT cohort_month, period_number, count(DISTINCT customer_id) AS customers_in_period,
         {msum('total_amount')} AS revenue_in_period, {mavg('total_amount')} AS avg_order_value_in_period
  FROM cdata GROUP BY cohort_month, period_number)""",
        """cs AS (SELECT cohort_month, customers_in_period AS cohort_size FROM cm WHERE period_number = 0)""",
    ]
    pdig = 2 if whole_months else 8
    body = f"""SELECT cm.cohort_month, {r('cm.period_number', pdig)} AS period_number,
       cm.customers_in_period, {r('cm.revenue_in_period')} AS revenue_in_period,
       {r('cm.avg_order_value_in_period')} AS avg_order_value_in_period, cs.cohort_size,
       {r(f"{D('cm.customers_in_period')} / NULLIF(cs.cohort_size, 0) * CAST(100 AS DOUBLE)")} AS retention_rate
FROM cm JOIN cs ON cm.cohort_month = cs.cohort_month"""
    return with_model(body, *ctes)


def sql_cohort_retention() -> str:
    return _cohort(False)


def sql_cohort_retention_whole_months() -> str:
    return _cohort(True)


# --- baskets ------------------------------------------------------------------
def sql_baskets() -> str:
    return with_model(f"""SELECT customer_id, transaction_date, {r(msum('total_amount'))} AS basket_value,
       count(product_id) AS basket_size, count(DISTINCT product_id) AS distinct_items
FROM enriched GROUP BY customer_id, transaction_date""")


def sql_basket_items() -> str:
    return with_model("""SELECT customer_id, transaction_date, product_id, count(*) AS item_count
FROM enriched WHERE product_id IS NOT NULL GROUP BY customer_id, transaction_date, product_id""")


def _pairs(item: str, min_support: float, info: bool) -> str:
    ctes = [
        f"""bitems AS (
  SELECT customer_id, transaction_date, {item} AS item, count(*) AS c
  FROM enriched WHERE {item} IS NOT NULL GROUP BY customer_id, transaction_date, {item})""",
        """btotal AS (SELECT count(*) AS n FROM (SELECT DISTINCT customer_id, transaction_date FROM enriched))""",
        """bpairs AS (
  SELECT a.item AS product_1, b.item AS product_2, CAST(sum(a.c * b.c) AS BIGINT) AS pair_count
  FROM bitems a JOIN bitems b ON a.customer_id = b.customer_id
   AND a.transaction_date = b.transaction_date AND a.item < b.item
  GROUP BY a.item, b.item)""",
        f"""bsup AS (
  SELECT product_1, product_2, pair_count, {D('pair_count')} / (SELECT n FROM btotal) AS support
  FROM bpairs WHERE {D('pair_count')} / (SELECT n FROM btotal) >= {D(repr(min_support))})""",
    ]
    sel = f"s.product_1, s.product_2, s.pair_count, {r('s.support', 8)} AS support"
    if not info:
        return with_model(f"SELECT {sel} FROM bsup s", *ctes)
    ctes.append("pinfo AS (SELECT DISTINCT product_id, category, brand FROM enriched)")
    return with_model(f"""SELECT {sel}, i1.category AS category_1, i1.brand AS brand_1,
       i2.category AS category_2, i2.brand AS brand_2
FROM bsup s JOIN pinfo i1 ON i1.product_id = s.product_1 JOIN pinfo i2 ON i2.product_id = s.product_2""",
                      *ctes)


def sql_basket_pairs() -> str:
    return _pairs("product_id", 0.0004, True)


def sql_basket_brand_pairs() -> str:
    return _pairs("brand", 0.02, False)


# --- data quality -------------------------------------------------------------
STAR_COLUMNS = {
    "transactions": [("transaction_id", "string"), ("customer_id", "bigint"),
                     ("product_id", "bigint"), ("quantity", "int"), ("unit_price", "double"),
                     ("discount_amount", "double"), ("total_amount", "double"),
                     ("transaction_date", "timestamp_ntz"), ("status", "string")],
    "customers": [("customer_id", "bigint"), ("first_name", "string"),
                  ("customer_segment", "string"), ("country", "string"), ("age_group", "string"),
                  ("registration_date", "date")],
    "products": [("product_id", "bigint"), ("product_name", "string"), ("category", "string"),
                 ("subcategory", "string"), ("brand", "string"), ("price", "double"),
                 ("cost", "double")],
}
NUMERIC = ("int", "bigint", "float", "double")
NUMERIC_RE = r"^\d+\.?\d*$"


def _pct(part: str, whole: str) -> str:
    return f"{D(part)} / NULLIF({whole}, 0) * CAST(100 AS DOUBLE)"


def _nulls_select(t: str) -> str:
    parts = []
    for c, _ in STAR_COLUMNS[t]:
        parts.append(f"""SELECT '{t}' AS dataset, '{c}' AS column_name,
       CAST(count_if({c} IS NULL) AS BIGINT) AS null_count,
       {r(_pct(f'count_if({c} IS NULL)', 'count(*)'))} AS null_percentage FROM {t}""")
    return "\nUNION ALL ".join(parts)


def sql_dq_nulls() -> str:
    body = "\nUNION ALL ".join(_nulls_select(t) for t in STAR_COLUMNS)
    return with_model(f"""SELECT dataset, column_name, null_count, null_percentage,
       coalesce(null_percentage <= {D(repr(0.05 * 100.0))}, true) AS passed
FROM ({body})""")


def _dups_select(t: str) -> str:
    return f"""SELECT '{t}' AS dataset, total_rows, unique_rows, total_rows - unique_rows AS duplicate_count,
       {r(_pct('total_rows - unique_rows', 'total_rows'))} AS duplicate_percentage
FROM (SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS unique_rows
      FROM {t})"""


def sql_dq_duplicates() -> str:
    body = "\nUNION ALL ".join(_dups_select(t) for t in STAR_COLUMNS)
    return with_model(f"""SELECT *, coalesce(duplicate_percentage <= {D(repr(0.01 * 100.0))}, true) AS passed
FROM ({body})""")


def _strings_select(t: str) -> list[str]:
    parts = []
    for c, typ in STAR_COLUMNS[t]:
        if typ == "string":
            parts.append(f"""SELECT '{t}' AS dataset, '{c}' AS column_name, count({c}) AS non_null_count,
       CAST(count_if({c} IS NOT NULL AND NOT regexp_matches({c}, '{NUMERIC_RE}')) AS BIGINT) AS non_numeric_count
FROM {t}""")
    return parts


def sql_dq_numeric_strings() -> str:
    body = "\nUNION ALL ".join(p for t in STAR_COLUMNS for p in _strings_select(t))
    return with_model(f"""SELECT *, non_null_count > 0 AND non_numeric_count = 0 AS looks_numeric,
       NOT (non_null_count > 0 AND non_numeric_count = 0) AS passed
FROM ({body})""")


def _outlier_select(t: str) -> list[str]:
    parts = []
    for c, typ in STAR_COLUMNS[t]:
        if typ in NUMERIC:
            x = D(c)
            parts.append(f"""SELECT '{t}' AS dataset, '{c}' AS column_name, s.mean, s.stddev,
       s.mean - CAST(3.0 AS DOUBLE) * s.stddev AS lo, s.mean + CAST(3.0 AS DOUBLE) * s.stddev AS hi,
       (SELECT CAST(count_if({x} < s.mean - CAST(3.0 AS DOUBLE) * s.stddev
                        OR {x} > s.mean + CAST(3.0 AS DOUBLE) * s.stddev) AS BIGINT) FROM {t}) AS outlier_count,
       s.nn
FROM (SELECT avg({x}) AS mean, stddev_samp({x}) AS stddev, count({c}) AS nn FROM {t}) s""")
    return parts


def _outliers_body() -> str:
    return "\nUNION ALL ".join(p for t in STAR_COLUMNS for p in _outlier_select(t))


def sql_dq_outliers() -> str:
    return with_model(f"""SELECT dataset, column_name, {r('mean')} AS mean, {r('stddev')} AS stddev,
       {r(r('lo'))} AS lower_bound, {r(r('hi'))} AS upper_bound, outlier_count,
       {r(r(_pct('outlier_count', 'nn')))} AS outlier_percentage, true AS passed
FROM ({_outliers_body()}) WHERE stddev IS NOT NULL AND stddev > 0""")


def sql_dq_report() -> str:
    def long(src: str, check: str, col: str, metrics: list[str], passed: str = "passed") -> str:
        return "\nUNION ALL ".join(
            f"SELECT dataset, '{check}' AS check_name, {col} AS column_name, '{m}' AS metric, "
            f"{r(D(m))} AS value, {passed} AS passed FROM {src}" for m in metrics)

    nulls = f"""dqn AS (SELECT *, coalesce(null_percentage <= {D(repr(5.0))}, true) AS passed FROM (
{chr(10).join(['UNION ALL ' + _nulls_select(t) if i else _nulls_select(t) for i, t in enumerate(STAR_COLUMNS)])}))"""
    dups = f"""dqd AS (SELECT *, coalesce(duplicate_percentage <= {D(repr(1.0))}, true) AS passed FROM (
{chr(10).join(['UNION ALL ' + _dups_select(t) if i else _dups_select(t) for i, t in enumerate(STAR_COLUMNS)])}))"""
    strs = f"""dqs AS (SELECT *, NOT (non_null_count > 0 AND non_numeric_count = 0) AS passed FROM (
{chr(10).join(['UNION ALL ' + p if i else p for i, p in enumerate(p for t in STAR_COLUMNS for p in _strings_select(t))])}))"""
    outs = f"""dqo AS (SELECT dataset, column_name, outlier_count,
       {r(_pct('outlier_count', 'nn'))} AS outlier_percentage, {r('lo')} AS lower_bound,
       {r('hi')} AS upper_bound, true AS passed
FROM ({_outliers_body()}) WHERE stddev IS NOT NULL AND stddev > 0)"""
    ri = """dqi AS (SELECT 'transactions' AS dataset, CAST(count_if(customer_id IS NULL) AS BIGINT) AS null_customer_ids,
       count_if(customer_id IS NULL) = 0 AS passed FROM transactions)"""
    body = "\nUNION ALL ".join([
        long("dqn", "null_values", "column_name", ["null_count", "null_percentage"]),
        long("dqd", "duplicates", "CAST(NULL AS VARCHAR)",
             ["total_rows", "unique_rows", "duplicate_count", "duplicate_percentage"]),
        long("dqs", "data_types", "column_name", ["non_null_count", "non_numeric_count"]),
        long("dqo", "outliers", "column_name",
             ["outlier_count", "outlier_percentage", "lower_bound", "upper_bound"]),
        long("dqi", "referential_integrity", "'customer_id'", ["null_customer_ids"]),
    ])
    return with_model(body, nulls, dups, strs, outs, ri)


def _ri(child_key: str, parent: str, relation: str) -> str:
    return with_model(f"""SELECT '{relation}' AS relation, '{child_key}' AS key, count(*) AS distinct_keys,
       CAST(count_if(p._hit IS NULL) AS BIGINT) AS orphan_keys, count_if(p._hit IS NULL) = 0 AS passed
FROM (SELECT DISTINCT {child_key} FROM transactions) c
LEFT JOIN (SELECT DISTINCT {child_key} AS _pk, true AS _hit FROM {parent}) p
  ON c.{child_key} IS NOT DISTINCT FROM p._pk""")


def sql_ri_customers() -> str:
    return _ri("customer_id", "customers", "transactions->customers")


def sql_ri_products() -> str:
    return _ri("product_id", "products", "transactions->products")


def sql_cleanse() -> str:
    return with_model("""SELECT DISTINCT customer_id, first_name,
       coalesce(customer_segment, 'Unknown') AS customer_segment,
       coalesce(country, 'Not Specified') AS country, age_group, registration_date
FROM customers""")


def sql_cleanse_transactions() -> str:
    cols = [("transaction_id", None), ("customer_id", None), ("product_id", None), ("quantity", None),
            ("unit_price", 6), ("discount_amount", 6), ("total_amount", 6), ("transaction_date", None),
            ("status", None)]
    return with_model(f"""SELECT {_sel(cols)}
FROM (SELECT DISTINCT * FROM transactions) c""")


def sql_cleanse_products() -> str:
    cols = [("product_id", None), ("product_name", None), ("category", None), ("subcategory", None),
            ("brand", None), ("price", 6), ("cost", 6)]
    return with_model(f"""SELECT {_sel(cols)}
FROM (SELECT DISTINCT * FROM products) c""")


def sql_freshness() -> str:
    asof = "TIMESTAMP '2024-02-01 00:00:00'"

    def one(ds, col, src):
        hours = f"(epoch_us({asof}) - epoch_us(max({col}))) / CAST(3600000000 AS DOUBLE)"
        return (f"SELECT '{ds}' AS dataset, '{col.strip(chr(34))}' AS column_name, max({col}) AS latest, "
                f"{r(hours)} AS hours_old, coalesce({hours} <= {D('48.0')}, false) AS is_fresh FROM {src}")
    return with_model(one("transactions", "transaction_date", "transactions") + "\nUNION ALL "
                      + one("logs", '"timestamp"', "logs"), LOGS_CTE)


def sql_dq_verdict() -> str:
    return f"""SELECT dataset, bool_and(passed) AS passed FROM ({sql_dq_report()}) GROUP BY dataset"""


# --- faulty inputs ------------------------------------------------------------
def _hit(key: str, salt: int, per_thousand: int) -> str:
    return f"({_mixed(key, salt)} % 1000 < {per_thousand})"


def _mixed(key: str, salt: int) -> str:
    return f"((({key} % 2147483647) * 48271 + {salt * 69621}) % 2147483647)"


def _twice(again: str) -> str:
    return f"unnest(CASE WHEN {again} THEN [0, 1] ELSE [0] END)"


_TX_KEY = "(CAST(split_part(transaction_id, '-', 1) AS BIGINT) * 8 + CAST(split_part(transaction_id, '-', 2) AS BIGINT))"

DIRTY = _star("_clean") + f""",
transactions AS (
  SELECT * EXCLUDE (again) FROM (
    SELECT transaction_id,
           CASE WHEN {_hit(_TX_KEY, 1, 70)} THEN NULL
                WHEN {_hit(_TX_KEY, 2, 10)} THEN customer_id + 1000000000 ELSE customer_id END AS customer_id,
           product_id, quantity, unit_price, discount_amount,
           CASE WHEN {_hit(_TX_KEY, 3, 3)} THEN total_amount * CAST(50 AS DOUBLE) ELSE total_amount END AS total_amount,
           transaction_date + to_seconds(CAST({_mixed(_TX_KEY, 4)} % 86400 AS INTEGER)) AS transaction_date,
           status, {_twice(_hit(_TX_KEY, 5, 20))} AS again
    FROM transactions_clean)),
customers AS (
  SELECT * EXCLUDE (again) FROM (
    SELECT customer_id, first_name,
           CASE WHEN NOT {_hit('customer_id', 6, 80)} THEN customer_segment END AS customer_segment,
           CASE WHEN NOT {_hit('customer_id', 7, 60)} THEN country END AS country,
           age_group, registration_date, {_twice(_hit('customer_id', 8, 30))} AS again
    FROM customers_clean)),
products AS (
  SELECT * EXCLUDE (again) FROM (
    SELECT product_id, product_name,
           CASE WHEN NOT {_hit('product_id', 10, 70)} THEN category END AS category,
           (product_id % 97) || '.5' AS subcategory, brand, price, cost,
           {_twice(_hit('product_id', 11, 20))} AS again
    FROM products_clean WHERE NOT {_hit('product_id', 9, 25)}))"""

_CLEANSED = """,
transactions AS (SELECT DISTINCT * FROM transactions_dirty),
customers AS (
  SELECT DISTINCT customer_id, first_name, coalesce(customer_segment, 'Unknown') AS customer_segment,
         coalesce(country, 'Not Specified') AS country, age_group, registration_date FROM customers_dirty),
products AS (SELECT DISTINCT * FROM products_dirty),"""


def _on_dirty(sql: str) -> str:
    """The same statement over the faulty star."""
    return sql.replace(f"WITH {MODEL}", f"WITH {DIRTY}", 1)


def _on_cleansed(sql: str) -> str:
    """The same statement over the faulty star after cleansing."""
    dirty = DIRTY
    for t in STAR_COLUMNS:
        dirty = dirty.replace(f"\n{t} AS (", f"\n{t}_dirty AS (")
    return sql.replace(f"WITH {MODEL}", f"WITH {dirty}{_CLEANSED}{ENRICHED}", 1)


def sql_dirty_dq_nulls() -> str:
    return _on_dirty(sql_dq_nulls())


def sql_dirty_dq_duplicates() -> str:
    return _on_dirty(sql_dq_duplicates())


def sql_dirty_dq_numeric_strings() -> str:
    return _on_dirty(sql_dq_numeric_strings())


def sql_dirty_dq_outliers() -> str:
    return _on_dirty(sql_dq_outliers())


def sql_dirty_dq_report() -> str:
    return _on_dirty(sql_dq_report())


def sql_dirty_dq_verdict() -> str:
    return _on_dirty(sql_dq_verdict())


def sql_dirty_ri_customers() -> str:
    return _on_dirty(sql_ri_customers())


def sql_dirty_ri_products() -> str:
    return _on_dirty(sql_ri_products())


def sql_dirty_cleanse() -> str:
    return _on_dirty(sql_cleanse())


def sql_dirty_cleanse_transactions() -> str:
    return _on_dirty(sql_cleanse_transactions())


def sql_dirty_cleanse_products() -> str:
    return _on_dirty(sql_cleanse_products())


def sql_dirty_enriched() -> str:
    return _on_cleansed(sql_enriched_transactions())


def sql_dirty_executive_totals() -> str:
    return _on_cleansed(sql_executive_totals())


# --- summary ------------------------------------------------------------------
TOTALS_CTE = f"""totals AS (
  SELECT {msum('total_amount')} AS total_revenue, {msum('profit_amount')} AS total_profit,
         count(transaction_id) AS total_transactions, count(DISTINCT customer_id) AS active_customers,
         count(DISTINCT product_id) AS products_sold, {mavg('total_amount')} AS avg_order_value
  FROM enriched)"""


def sql_executive_totals() -> str:
    return with_model(f"""SELECT {r('total_revenue')} AS total_revenue, {r('total_profit')} AS total_profit,
       total_transactions, active_customers, products_sold, {r('avg_order_value')} AS avg_order_value
FROM totals""", TOTALS_CTE)


def sql_executive_summary() -> str:
    rows = [("Total Revenue", "total_revenue", "currency"), ("Total Profit", "total_profit", "currency"),
            ("Active Customers", "active_customers", "count"),
            ("Average Order Value", "avg_order_value", "currency")]
    body = "\nUNION ALL ".join(
        f"SELECT '{n}' AS metric_name, {r(D(c))} AS metric_value, '{k}' AS metric_type FROM totals"
        for n, c, k in rows)
    return with_model(body, TOTALS_CTE)


ENRICHED_TYPES = (STAR_COLUMNS["transactions"]
                  + [("customer_segment", "string"), ("country", "string"), ("age_group", "string"),
                     ("registration_date", "date"), ("category", "string"),
                     ("subcategory", "string"), ("brand", "string"), ("cost", "double"),
                     ("year", "int"), ("month", "int"), ("quarter", "int"), ("day_of_week", "int"),
                     ("hour", "int"), ("profit_amount", "double"), ("profit_margin", "double"),
                     ("customer_tenure_days", "int")])
TYPE_BYTES = {"string": 50, "int": 4, "bigint": 8, "double": 8, "timestamp_ntz": 8, "date": 8}


def sql_dataset_profile() -> str:
    specs = [("transactions", "raw/transactions", STAR_COLUMNS["transactions"], ""),
             ("customers", "raw/customers", STAR_COLUMNS["customers"], ""),
             ("products", "raw/products", STAR_COLUMNS["products"], ""),
             ("enriched", "processed/enriched_transactions", ENRICHED_TYPES, "year,month")]
    parts = []
    for src, path, cols, parts_cols in specs:
        per_row = sum(TYPE_BYTES[t] for _, t in cols)
        names = ",".join(c for c, _ in cols)
        parts.append(f"""SELECT '{path}' AS dataset_path, count(*) AS record_count,
       CAST({len(cols)} AS INTEGER) AS column_count, '{names}' AS column_names,
       'parquet' AS file_format, '{parts_cols}' AS partition_columns,
       round(CAST(count(*) * {per_row} AS DOUBLE) / CAST(1048576 AS DOUBLE) * CAST(100 AS DOUBLE))
         / CAST(100 AS DOUBLE) AS size_estimate_mb
FROM {src}""")
    return with_model("\nUNION ALL ".join(parts))


# --- error logs ---------------------------------------------------------------
LOG_MESSAGES = [
    ("OutOfMemoryError", "java.lang.OutOfMemoryError: Java heap space"),
    ("OutOfMemoryError", "Executor lost: out of memory while building hash table"),
    ("RuntimeError", "Metaspace limit reached while loading classes"),
    ("ClientError", "S3 request failed for the output prefix"),
    ("PermissionError", "Access denied when writing the partition folder"),
    ("ConnectionError", "Connection refused by the catalog host"),
    ("ValueError", "Data quality threshold exceeded for transactions"),
    ("AnalysisException", "Schema mismatch on column total_amount"),
    ("Py4JJavaError", "Null pointer while resolving customer segment"),
    ("OutOfMemoryError", "Out of memory during data quality scan"),
    ("TimeoutError", "Read timeout after 30 seconds on the lookup service"),
    ("FileNotFoundError", "Input file not found: daily extract"),
]


def _lst(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


LOGS_CTE = f"""logs AS (
  SELECT event_id AS error_id, ts AS "timestamp", event_type AS component,
         {_lst(t for t, _ in LOG_MESSAGES)}[event_id % {len(LOG_MESSAGES)} + 1] AS error_type,
         {_lst(m for _, m in LOG_MESSAGES)}[event_id % {len(LOG_MESSAGES)} + 1] AS error_message
  FROM events)"""
CLASSIFIED_CTE = """classified AS (
  SELECT logs.*,
    CASE WHEN contains(lower(error_message), 'out of memory') OR contains(lower(error_message), 'java heap space')
              OR contains(lower(error_message), 'metaspace') THEN 'CRITICAL'
         WHEN contains(lower(error_message), 's3') OR contains(lower(error_message), 'access denied')
              OR contains(lower(error_message), 'connection refused') THEN 'HIGH'
         WHEN contains(lower(error_message), 'data quality') OR contains(lower(error_message), 'schema mismatch')
              OR contains(lower(error_message), 'null pointer') THEN 'MEDIUM'
         ELSE 'LOW' END AS severity,
    CASE WHEN contains(lower(error_message), 'memory') THEN 'memory_error'
         WHEN contains(lower(error_message), 's3') THEN 's3_access_error'
         WHEN contains(lower(error_message), 'timeout') THEN 'network_timeout'
         WHEN contains(lower(error_message), 'data quality') THEN 'data_quality_failure'
         ELSE NULL END AS recovery_route,
    CASE error_type
         WHEN 'OutOfMemoryError' THEN 'Increase Spark executor memory; Reduce data partition size; Use more efficient serialization'
         WHEN 'ConnectionError' THEN 'Check network connectivity; Verify service endpoints; Implement retry logic'
         WHEN 'FileNotFoundError' THEN 'Verify file paths and permissions; Check if data source is available; Implement fallback data sources'
         ELSE 'Contact system administrator' END AS suggestions
  FROM logs)"""


def sql_log_severity() -> str:
    return with_model("SELECT * FROM classified", LOGS_CTE, CLASSIFIED_CTE)


def sql_log_alerts() -> str:
    return with_model("SELECT * FROM classified WHERE severity = 'CRITICAL' OR recovery_route IS NULL",
                      LOGS_CTE, CLASSIFIED_CTE)


def sql_log_summary() -> str:
    return with_model("""SELECT 'total' AS dimension, 'all' AS key, count(*) AS error_count FROM classified
UNION ALL SELECT 'error_type', error_type, count(*) FROM classified GROUP BY error_type
UNION ALL SELECT 'severity', severity, count(*) FROM classified GROUP BY severity
UNION ALL SELECT 'most_recent_error',
  (SELECT error_message FROM classified ORDER BY "timestamp" DESC, error_id DESC LIMIT 1),
  CAST(NULL AS BIGINT)""", LOGS_CTE, CLASSIFIED_CTE)


def sql_log_trend() -> str:
    return with_model("""SELECT period_start, error_count, previous_count,
  CASE WHEN previous_count IS NULL THEN 'Insufficient data'
       WHEN error_count > previous_count THEN 'Increasing'
       WHEN error_count < previous_count THEN 'Decreasing' ELSE 'Stable' END AS trend
FROM (SELECT period_start, error_count, lag(error_count) OVER (ORDER BY period_start) AS previous_count
      FROM (SELECT date_trunc('day', "timestamp") AS period_start, count(*) AS error_count
            FROM classified GROUP BY 1))""", LOGS_CTE, CLASSIFIED_CTE)


# --- text files with bad records --------------------------------------------------
RECORDS = f"""records AS (
  SELECT CASE WHEN NOT {_hit('product_id', 23, 15)} THEN CAST(product_id AS VARCHAR) END AS product_id,
         product_name, category, subcategory, brand, price, cost,
         CAST(DATE '2000-01-01' + CAST(product_id % 3000 AS INTEGER) AS DATE) AS launch_date,
         {_hit('product_id', 21, 30)} AS bad_price, {_hit('product_id', 22, 20)} AS cut_off
  FROM products)"""


def _round_trip(partial: str) -> str:
    return with_model(f"""SELECT product_id, product_name,
       CASE WHEN NOT cut_off THEN category END AS category, CASE WHEN NOT cut_off THEN subcategory END AS subcategory,
       CASE WHEN NOT cut_off THEN brand END AS brand,
       {r('CASE WHEN NOT cut_off AND NOT bad_price THEN price END', 6)} AS price,
       {r('CASE WHEN NOT cut_off THEN cost END', 6)} AS cost,
       CASE WHEN NOT cut_off THEN launch_date END AS launch_date
FROM records WHERE product_id IS NOT NULL AND (NOT cut_off OR {partial})""", RECORDS)


def sql_csv_round_trip() -> str:
    return _round_trip("true")


def sql_json_round_trip() -> str:
    return _round_trip("false")     # of a cut JSON text no field is read


def _quarantined(cut_off_name: str) -> str:
    return with_model(f"""SELECT CASE WHEN cut_off OR bad_price THEN 'malformed' ELSE 'missing key' END AS reason,
       CASE WHEN cut_off THEN 'cut off' WHEN bad_price THEN 'bad price' ELSE 'missing key' END AS kind,
       count(*) AS records, count(*) AS with_file, count(*) AS with_text,
       count(CASE WHEN cut_off THEN {cut_off_name} ELSE product_name END) AS with_name,
       count(CASE WHEN NOT cut_off AND NOT bad_price THEN price END) AS with_price
FROM records WHERE cut_off OR bad_price OR product_id IS NULL GROUP BY ALL""", RECORDS)


def sql_csv_quarantine() -> str:
    return _quarantined("product_name")


def sql_json_quarantine() -> str:
    return _quarantined("NULL")


def sql_bucketed_status_totals() -> str:
    return with_model(f"""SELECT status, CAST(year(transaction_date) AS INTEGER) AS year, count(*) AS transactions,
       {r(msum('total_amount'))} AS revenue, count(DISTINCT customer_id) AS customers
FROM transactions GROUP BY ALL""")


def sql_bucketed_enriched() -> str:
    return sql_enriched_transactions()


# --- published tables -------------------------------------------------------------
PUBLISHED = [       # dataset, zone, partition columns of the statement's rows
    ("enriched_transactions", "processed", ("year", "month"), sql_enriched_transactions),
    ("customer_metrics", "curated", ("customer_segment",), sql_clv_segments),
    ("product_metrics", "curated", ("category",), sql_product_performance),
    ("rfm_analysis", "curated", ("rfm_segment",), sql_rfm_segments),
    ("cohort_analysis", "curated", ("cohort_month",), sql_cohort_retention),
    ("executive_summary", "curated", (), sql_executive_summary),
    ("weekday_metrics", "curated", (), sql_weekday_series),
    ("monthly_metrics", "curated", (), sql_monthly_series),
    ("market_basket_analysis", "curated", (), lambda: _pairs("product_id", 0.01, True)),
    ("churn_indicators", "curated", ("churn_risk_level",), sql_churn_indicators),
]


def sql_published_catalog() -> str:
    parts = []
    for name, zone, columns, body in PUBLISHED:
        keys = f"count(DISTINCT ({', '.join(columns)},))" if columns else "CAST(count(*) > 0 AS BIGINT)"
        parts.append(f"""SELECT '{name}' AS dataset, '{zone}' AS zone, {keys} AS partitions,
       count(*) AS record_count, count(*) AS footer_rows, CAST(1 AS BIGINT) AS data_versions, true AS verified
FROM ({body()})""")
    return "\nUNION ALL ".join(parts)


def sql_published_months() -> str:
    amount = "total_amount * CASE year WHEN 1995 THEN CAST(2 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END"
    return with_model(f"""SELECT year, month, count(*) AS transactions, {r(msum(amount))} AS revenue,
       max(transaction_date) AS latest
FROM enriched GROUP BY year, month""")


def registry() -> dict[str, str]:
    return {name[4:]: fn() for name, fn in globals().items()
            if name.startswith("sql_") and callable(fn)}
