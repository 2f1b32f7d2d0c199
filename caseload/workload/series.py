"""Change, share, rolling and reconciliation metrics on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import effective_dated_label
from ..functions.scalars import ratio
from ..operators.metrics import (
    change_columns,
    cut_evenly,
    mean_of_present,
    period_change,
    prior_values,
    rolling_mean,
    share_of,
    stock_flow_variance,
    variance_vs_reported,
)
from ..operators.rows import drop_listed
from .tables import div0, money_sum, month_of, supplied_parts, table

# Two of the five priorities make up the total that shares refer to.
COMPONENTS = ["1-URGENT", "2-HIGH"]


def series_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value by month and priority: change, and share of the component priorities."""
    series = (
        table(spark, sf_dir, "orders")
        .groupBy(month_of("o_orderdate").alias("report_month"), "o_orderpriority")
        .agg(money_sum("o_totalprice").alias("order_value"))
    )
    shared = share_of(
        series,
        "order_value",
        {"pct_of_total": ["report_month"]},
        component=F.col("o_orderpriority").isin(COMPONENTS),
    )
    return period_change(shared, "order_value", "report_month", ["o_orderpriority"])


SERIES_TREND = f"""
WITH series AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month, o_orderpriority,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS order_value
  FROM orders GROUP BY ALL
), totals AS (
  SELECT report_month, sum(order_value) AS total FROM series
  WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY report_month
), lagged AS (
  SELECT *, lag(order_value) OVER (PARTITION BY o_orderpriority ORDER BY report_month) AS prior
  FROM series
)
SELECT l.report_month, o_orderpriority, order_value,
       {div0("order_value", "total")} AS pct_of_total,
       order_value - prior AS mom_change,
       {div0("order_value - prior", "prior")} AS mom_change_pct
FROM lagged l LEFT JOIN totals t ON l.report_month = t.report_month
"""


def two_level_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month, nation and segment: shares of the nation and of the segment."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation")
    )
    series = (
        table(spark, sf_dir, "orders")
        .select("o_custkey", month_of("o_orderdate").alias("report_month"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("report_month", "c_nationkey", "c_mktsegment")
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )
    shared = share_of(
        series,
        "n_orders",
        {
            "pct_of_nation_total": ["report_month", "c_nationkey"],
            "pct_of_segment_total": ["report_month", "c_mktsegment"],
        },
        component=F.col("c_mktsegment") != "MACHINERY",
        component_shares=["pct_of_nation_total"],
    )
    changed = period_change(shared, "n_orders", "report_month", ["c_mktsegment", "c_nationkey"])
    return changed.join(nations, "c_nationkey", "left")


TWO_LEVEL_SHARE = f"""
WITH series AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month, c_nationkey,
         c_mktsegment, CAST(count(*) AS BIGINT) AS n_orders
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
), nation_totals AS (
  SELECT report_month, c_nationkey, sum(n_orders) AS nation_total FROM series
  WHERE c_mktsegment <> 'MACHINERY' GROUP BY ALL
), segment_totals AS (
  SELECT report_month, c_mktsegment, sum(n_orders) AS segment_total FROM series GROUP BY ALL
), lagged AS (
  SELECT *, lag(n_orders) OVER (
    PARTITION BY c_mktsegment, c_nationkey ORDER BY report_month) AS prior
  FROM series
)
SELECT l.report_month, l.c_nationkey, n_name AS nation, l.c_mktsegment, n_orders,
       n_orders - prior AS mom_change,
       {div0("n_orders - prior", "prior")} AS mom_change_pct,
       {div0("n_orders", "nation_total")} AS pct_of_nation_total,
       {div0("n_orders", "segment_total")} AS pct_of_segment_total
FROM lagged l
LEFT JOIN nation_totals nt ON l.report_month = nt.report_month AND l.c_nationkey = nt.c_nationkey
LEFT JOIN segment_totals st
  ON l.report_month = st.report_month AND l.c_mktsegment = st.c_mktsegment
LEFT JOIN nation ON n_nationkey = l.c_nationkey
"""


def timeliness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by month, flag and status: timely fraction, its change, mean and variance."""
    line = ["l_returnflag", "l_linestatus"]
    series = (
        table(spark, sf_dir, "lineitem")
        .groupBy(month_of("l_shipdate").alias("report_month"), *line)
        .agg(
            F.count(F.lit(1)).alias("disposed"),
            F.count_if(F.col("l_discount") <= 0.05).alias("timely"),
        )
        .withColumn("untimely", F.col("disposed") - F.col("timely"))
        .withColumn("pct_timely", ratio("timely", "disposed"))
        .withColumn("src_percent", F.floor(F.col("pct_timely") * 1000) / F.lit(1000.0))
        .withColumn("pct_timely_variance", variance_vs_reported("pct_timely", "src_percent"))
    )
    changed = period_change(
        series, "pct_timely", "report_month", line, change="mom_change_pct_timely", pct=None
    )
    return rolling_mean(changed, "pct_timely", "rolling_3m_pct_timely", "report_month", line)


TIMELINESS = f"""
WITH counted AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS report_month, l_returnflag,
         l_linestatus, CAST(count(*) AS BIGINT) AS disposed,
         CAST(count(*) FILTER (WHERE l_discount <= 0.05) AS BIGINT) AS timely
  FROM lineitem GROUP BY ALL
), rated AS (
  SELECT *, disposed - timely AS untimely, {div0("timely", "disposed")} AS pct_timely FROM counted
), reported AS (
  SELECT *, floor(pct_timely * 1000) / 1000.0 AS src_percent FROM rated
)
SELECT *, pct_timely - src_percent AS pct_timely_variance,
       pct_timely - lag(pct_timely) OVER w AS mom_change_pct_timely,
       avg(pct_timely) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3m_pct_timely
FROM reported
WINDOW w AS (PARTITION BY l_returnflag, l_linestatus ORDER BY report_month)
"""


def staged_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by day and flag, in the percentage form with NULL over a zero."""
    taxed = F.col("l_tax") >= 0.08
    days = (
        drop_listed(table(spark, sf_dir, "lineitem"), "l_returnflag", ["A"])
        .groupBy(
            F.col("l_shipdate").cast("date").alias("report_day"),
            F.trim("l_returnflag").alias("flag"),
        )
        .agg(
            F.count_if(taxed).alias("disposed"),
            F.count_if(taxed & (F.col("l_discount") <= 0.05)).alias("timely"),
        )
    )
    return days.select(
        "*",
        (F.col("disposed") - F.col("timely")).alias("untimely"),
        ratio("timely", "disposed", on_zero="null", scale=100, digits=2).alias("pct_timely"),
    )


STAGED_PERCENT = """
WITH days AS (
  SELECT CAST(l_shipdate AS DATE) AS report_day, trim(l_returnflag) AS flag,
         CAST(count(*) FILTER (WHERE l_tax >= 0.08) AS BIGINT) AS disposed,
         CAST(count(*) FILTER (WHERE l_tax >= 0.08 AND l_discount <= 0.05) AS BIGINT) AS timely
  FROM lineitem WHERE trim(l_returnflag) NOT IN ('A') GROUP BY ALL
)
SELECT *, disposed - timely AS untimely,
       round(CAST(timely AS DOUBLE) / nullif(CAST(disposed AS DOUBLE), 0) * 100, 2) AS pct_timely
FROM days
"""


def stock_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day: users as the stock, sign-ups in, errors out, purchases as renewals."""
    of_type = {"new_enrollment": "signup", "disenrollment": "error", "renewals": "purchase"}
    days = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("ts").cast("date").alias("report_day"))
        .agg(
            F.count_distinct("user_id").alias("caseload"),
            *[F.count_if(F.col("event_type") == t).alias(name) for name, t in of_type.items()],
        )
    )
    changed = period_change(
        days,
        "caseload",
        "report_day",
        change="change_caseload",
        pct="change_pct_caseload",
        single_series=True,
    )
    rated = changed.withColumns(
        {
            "net_enrollment": F.col("new_enrollment") - F.col("disenrollment"),
            "renewal_rate": ratio("renewals", "caseload"),
            "disenrollment_rate": ratio("disenrollment", "caseload"),
        }
    )
    return stock_flow_variance(
        rated, "caseload", "new_enrollment", "disenrollment", "report_day", single_series=True
    )


STOCK_FLOW = f"""
WITH days AS (
  SELECT CAST(ts AS DATE) AS report_day, CAST(count(DISTINCT user_id) AS BIGINT) AS caseload,
         CAST(count(*) FILTER (WHERE event_type = 'signup') AS BIGINT) AS new_enrollment,
         CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS disenrollment,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS renewals
  FROM events GROUP BY ALL
), lagged AS (
  SELECT *, lag(caseload) OVER (ORDER BY report_day) AS prior FROM days
)
SELECT report_day, caseload, new_enrollment, disenrollment, renewals,
       caseload - prior AS change_caseload,
       {div0("caseload - prior", "prior")} AS change_pct_caseload,
       new_enrollment - disenrollment AS net_enrollment,
       {div0("renewals", "caseload")} AS renewal_rate,
       {div0("disenrollment", "caseload")} AS disenrollment_rate,
       {div0("caseload - (prior + new_enrollment - disenrollment)", "caseload")}
         AS caseload_reconciliation_variance_pct
FROM lagged
"""


def single_series_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity by month, as one series, with the counting method in force."""
    months = (
        table(spark, sf_dir, "lineitem")
        .groupBy(month_of("l_shipdate").alias("report_month"))
        .agg(F.sum("l_quantity").alias("caseload"))
    )
    labelled = months.withColumn(
        "count_methodology",
        effective_dated_label("report_month", "point_in_time", [("1998-06-01", "daily_average")]),
    )
    return period_change(
        labelled,
        "caseload",
        "report_month",
        change="mom_change_caseload",
        pct="mom_change_pct_caseload",
        single_series=True,
    )


SINGLE_SERIES_TREND = f"""
WITH months AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS report_month,
         sum(l_quantity) AS caseload
  FROM lineitem GROUP BY ALL
), lagged AS (
  SELECT *, lag(caseload) OVER (ORDER BY report_month) AS prior FROM months
)
SELECT report_month, caseload,
       CASE WHEN report_month >= DATE '1998-06-01' THEN 'daily_average' ELSE 'point_in_time' END
         AS count_methodology,
       caseload - prior AS mom_change_caseload,
       {div0("caseload - prior", "prior")} AS mom_change_pct_caseload
FROM lagged
"""


def market_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity by supplier, brand and type."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return (
        supplied_parts(spark, sf_dir)
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_suppkey", "p_brand", "p_type")
        .agg(F.sum("quantity").alias("quantity"))
    )


def market_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier's share of a brand and type, and of the brand."""
    shares = {"share_of_type": ["p_brand", "p_type"], "share_of_brand": ["p_brand"]}
    return share_of(market_cells(spark, sf_dir), "quantity", shares)


MARKET_SHARE = f"""
WITH cells AS (
  SELECT l_suppkey, p_brand, p_type, sum(l_quantity) AS quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL
), type_totals AS (
  SELECT p_brand, p_type, sum(quantity) AS type_total FROM cells GROUP BY ALL
), brand_totals AS (
  SELECT p_brand, sum(quantity) AS brand_total FROM cells GROUP BY ALL
)
SELECT c.*, {div0("quantity", "type_total")} AS share_of_type,
       {div0("quantity", "brand_total")} AS share_of_brand
FROM cells c
LEFT JOIN type_totals t ON c.p_brand = t.p_brand AND c.p_type = t.p_type
LEFT JOIN brand_totals b ON c.p_brand = b.p_brand
"""


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change and rolling mean from event to event, not grouped to a calendar.

    A series here is as long as its share of the events, so it is worked on in pieces.
    """
    order, back = ["ts", "event_id"], ["before_1", "before_2"]
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    cut = cut_evenly(events, order)
    held = prior_values(cut, "value", back, order, ["event_type"], piece=F.col("piece"))
    return held.select(
        "event_id",
        "event_type",
        "value",
        *change_columns("value", "before_1", "change", "change_pct"),
        mean_of_present(["before_2", "before_1", "value"]).alias("rolling_3"),
    )


EVENT_CHANGES = f"""
WITH lagged AS (
  SELECT *, lag(value) OVER w AS b1, lag(value, 2) OVER w AS b2 FROM events
  WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
)
SELECT event_id, event_type, value, value - b1 AS change,
       {div0("value - b1", "b1")} AS change_pct,
       (coalesce(b2, 0.0) + coalesce(b1, 0.0) + coalesce(value, 0.0)) / nullif(
         CAST(b2 IS NOT NULL AS INT) + CAST(b1 IS NOT NULL AS INT)
         + CAST(value IS NOT NULL AS INT), 0) AS rolling_3
FROM lagged
"""

QUERIES = {
    "series_trend": (series_trend, SERIES_TREND),
    "two_level_share": (two_level_share, TWO_LEVEL_SHARE),
    "timeliness": (timeliness, TIMELINESS),
    "staged_percent": (staged_percent, STAGED_PERCENT),
    "stock_flow": (stock_flow, STOCK_FLOW),
    "single_series_trend": (single_series_trend, SINGLE_SERIES_TREND),
    "market_share": (market_share, MARKET_SHARE),
    "event_changes": (event_changes, EVENT_CHANGES),
}
