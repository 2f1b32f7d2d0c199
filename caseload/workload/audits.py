"""Data checks and profiles on the driver's tables, and the declared checks on the models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profiling
from ..operators.quality import (
    accepted_values,
    in_range,
    not_null,
    relationship,
    row_count,
    run_all,
    shares_sum_to_one,
    unique,
)
from ..operators.sketches import distinct_over, distinct_sketches, frequent_values
from ..plans import pipeline
from ..plans.checks import (
    ACCEPTED,
    AUDIT_COLUMN,
    FRACTIONS,
    GRAIN,
    ORIGINS,
    REQUIRED,
    REQUIRED_IN_REGIONS,
    SHARES,
    SINGLE,
    UNIQUE,
)
from ..plans.graph import Model
from ..plans.pipeline import GRAPH, MARTS, RAW, STAGING
from ..session import shared_folder
from ..sources.sinks import Outcome, raise_failed, with_audit_time
from .models import MART_SQL, STAGING_SQL
from .raw_tables import raw_tables
from .series import MARKET_SHARE, market_share
from .tables import cents, month_of, table

MODELS = {**STAGING_SQL, **MART_SQL}


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of every kind on orders, lines and customers; several of them fail."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    lines = table(spark, sf_dir, "lineitem")
    return run_all(
        {
            "orders": (
                orders,
                [
                    not_null("o_orderkey"),
                    not_null("o_custkey", where=F.col("o_orderstatus") == "F"),
                    accepted_values("o_orderstatus", ["O", "F"]),
                    in_range("o_totalprice", 1000, 400000),
                    unique("o_orderkey"),
                    unique("o_custkey"),
                    relationship("o_custkey", customers.where("c_acctbal > 0"), "c_custkey"),
                ],
            ),
            "lineitem": (
                lines,
                [
                    not_null("l_shipdate"),
                    accepted_values("l_linestatus", ["O", "F"]),
                    in_range("l_discount", 0.0, 0.05),
                    unique("l_orderkey", "l_linenumber"),
                    relationship("l_orderkey", orders, "o_orderkey"),
                ],
            ),
            "nation": (
                table(spark, sf_dir, "nation"),
                [row_count(25), not_null("n_name"), row_count(30)],
            ),
        }
    )


def _line(
    dataset: str, check: str, column: str, source: str, failed: str, rows: str = "count(*)"
) -> str:
    return (
        f"SELECT '{dataset}' AS dataset, '{check}' AS \"check\", '{column}' AS \"column\", "
        f"CAST({rows} AS BIGINT) AS n_rows, CAST({failed} AS BIGINT) AS n_failed FROM {source}"
    )


def _where(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def _duplicates(source: str, columns: list[str]) -> str:
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return (
        f"(SELECT count(*) FROM (SELECT 1 FROM {source} WHERE {present} "
        f"GROUP BY {', '.join(columns)} HAVING count(*) > 1))"
    )


def _report(lines: list[str]) -> str:
    return "SELECT *, n_failed = 0 AS passed FROM (" + " UNION ALL ".join(lines) + ")"


DQ_REPORT = _report(
    [
        _line("orders", "not_null", "o_orderkey", "orders", _where("o_orderkey IS NULL")),
        _line("orders", "not_null_where", "o_custkey", "orders",
              _where("o_orderstatus = 'F' AND o_custkey IS NULL")),
        _line("orders", "accepted_values", "o_orderstatus", "orders",
              _where("o_orderstatus NOT IN ('O', 'F')")),
        _line("orders", "in_range", "o_totalprice", "orders",
              _where("o_totalprice < 1000 OR o_totalprice > 400000")),
        _line("orders", "unique", "o_orderkey", "orders", _duplicates("orders", ["o_orderkey"])),
        _line("orders", "unique", "o_custkey", "orders", _duplicates("orders", ["o_custkey"])),
        _line("orders", "relationship", "o_custkey", "orders",
              _where("o_custkey IS NOT NULL AND o_custkey NOT IN "
                     "(SELECT c_custkey FROM customer WHERE c_acctbal > 0)")),
        _line("lineitem", "not_null", "l_shipdate", "lineitem", _where("l_shipdate IS NULL")),
        _line("lineitem", "accepted_values", "l_linestatus", "lineitem",
              _where("l_linestatus NOT IN ('O', 'F')")),
        _line("lineitem", "in_range", "l_discount", "lineitem",
              _where("l_discount < 0 OR l_discount > 0.05")),
        _line("lineitem", "unique", "l_orderkey, l_linenumber", "lineitem",
              _duplicates("lineitem", ["l_orderkey", "l_linenumber"])),
        _line("lineitem", "relationship", "l_orderkey", "lineitem",
              _where("l_orderkey NOT IN (SELECT o_orderkey FROM orders)")),
        _line("nation", "row_count", "", "nation", "abs(count(*) - 25)"),
        _line("nation", "not_null", "n_name", "nation", _where("n_name IS NULL")),
        _line("nation", "row_count", "", "nation", "abs(count(*) - 30)"),
    ]
)


def model_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks on the twelve models: declared, of the grain, and from the documentation.

    Each model is built once, in the order of the graph, from what was written of the models it reads,
    and checked as it was written.
    """
    folder = shared_folder(spark)

    def read(name: str) -> DataFrame:
        return raw_tables(spark, sf_dir, name) if name in RAW else spark.read.parquet(f"{folder}/{name}")

    def publish(model: Model, frame: DataFrame) -> Outcome:
        frame.write.parquet(f"{folder}/{model.name}")
        return Outcome(model.name, "loaded")

    raise_failed(GRAPH.build(read, publish))
    models = {name: read(name) for name in GRAPH.models}
    staged = {name: models[name] for name in STAGING}
    return run_all(
        {
            name: (with_audit_time(models[name], AUDIT_COLUMN), pipeline.model_checks(name, staged))
            for name in [*STAGING, *MARTS]
        }
    )


#: Spans of shipping days whose distinct orders are told from sketches by month.
SPANS = {
    "all": ("1900-01-01", "2100-01-01"),
    "year": ("1996-01-01", "1997-01-01"),
    "month": ("1997-03-01", "1997-04-01"),
}


def distinct_by_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders of three spans from sketches by month, kept in a table; and whether each is within
    two per cent of the exact number."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", month_of("l_shipdate").alias("month"))
    folder = shared_folder(spark)
    distinct_sketches(lines, "l_orderkey", ["month"]).write.parquet(folder)
    # A month belongs to several spans.
    spans = F.array(
        *[
            F.when((F.col("month") >= first) & (F.col("month") < end), F.lit(name))
            for name, (first, end) in SPANS.items()
        ]
    )

    def in_spans(df: DataFrame) -> DataFrame:
        return df.withColumn("span", F.explode(F.array_compact(spans)))

    told = distinct_over(in_spans(spark.read.parquet(folder)), ["span"])
    exact = in_spans(lines).groupBy("span").agg(F.count_distinct("l_orderkey").alias("exact"))
    off = F.abs(F.col("n_distinct") - F.col("exact"))
    return told.join(exact, "span").select(
        "span", "n_rows", F.col("exact").alias("n_orders"), (off <= 0.02 * F.col("exact")).alias("close")
    )


DISTINCT_BY_SPAN = " UNION ALL ".join(
    f"""
SELECT '{name}' AS span, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders, true AS close
FROM lineitem WHERE date_trunc('month', l_shipdate) >= DATE '{first}' AND date_trunc('month', l_shipdate) < DATE '{end}'
HAVING count(*) > 0"""
    for name, (first, end) in SPANS.items()
)


def frequent_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts on more than one in 1,500 lines, from a bounded summary, and whether its error holds."""
    found = frequent_values(table(spark, sf_dir, "lineitem"), "l_partkey", 1 / 1500)
    within = F.abs(F.col("estimate") - F.col("n_rows")) <= F.col("max_error")
    return found.select(F.col("value").alias("l_partkey"), "n_rows", within.alias("within"))


FREQUENT_PARTS = """
SELECT l_partkey, count(*) AS n_rows, true AS within FROM lineitem
GROUP BY l_partkey HAVING count(*) > (1.0::DOUBLE / 1500) * (SELECT count(*) FROM lineitem)
"""


def _model_lines(name: str) -> list[str]:
    model_of = f"(SELECT *, now() AS {AUDIT_COLUMN} FROM ({MODELS[name]}))"
    lines = [_line(name, "not_null", c, model_of, _where(f"{c} IS NULL")) for c in REQUIRED[name]]
    lines += [
        _line(name, "not_null_where", c, model_of, _where(f"is_geographic_region AND {c} IS NULL"))
        for c in REQUIRED_IN_REGIONS.get(name, [])
    ]
    lines += [
        _line(name, "accepted_values", c, model_of,
              _where(f"{c} NOT IN ({', '.join(repr(v) for v in values)})"))
        for c, values in ACCEPTED.get(name, {}).items()
    ]
    keys = ([["report_month"]] if name in UNIQUE else []) + ([GRAIN[name]] if name in GRAIN else [])
    lines += [
        _line(name, "unique", ", ".join(k), model_of, _duplicates(model_of, k)) for k in keys
    ]
    lines += [
        _line(name, "in_range", c, model_of, _where(f"{c} < 0 OR {c} > 1"))
        for c in FRACTIONS.get(name, [])
    ]
    lines += [_share_line(name, c, ", ".join(k), MODELS[name]) for c, k in SHARES.get(name, {}).items()]
    if name in ORIGINS:
        origin, keys = ORIGINS[name]
        same = " AND ".join(f"o.{k} = m.{k}" for k in keys)
        present = " AND ".join(f"m.{k} IS NOT NULL" for k in keys)
        lines.append(
            _line(name, "relationship", ", ".join(keys), f"{model_of} AS m",
                  _where(f"{present} AND NOT EXISTS (SELECT 1 FROM ({MODELS[origin]}) AS o WHERE {same})"))
        )
    lines += [
        _line(name, "single_value", c, model_of, f"greatest(count(DISTINCT {c}) - 1, 0)")
        for c in SINGLE.get(name, [])
    ]
    return lines


def _share_line(dataset: str, column: str, keys: str, source: str) -> str:
    sums = f"(SELECT count(*) AS n, sum({column}) AS share FROM ({source}) GROUP BY {keys})"
    failed = _where("abs(share - 1) > 1e-9")
    return _line(dataset, "shares_sum_to_one", column, sums, failed, "sum(n)")


MODEL_CHECKS = _report([line for name in MODELS for line in _model_lines(name)])


def shares_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of suppliers summed over what they are shares of, and checked to be one.

    The shares of brands are also summed over types, where they are not.
    """
    checks = [
        shares_sum_to_one("share_of_type", "p_brand", "p_type"),
        shares_sum_to_one("share_of_brand", "p_brand"),
        shares_sum_to_one("share_of_brand", "p_brand", "p_type"),
    ]
    return run_all({"market_share": (market_share(spark, sf_dir), checks)})


SHARES_SUM = _report(
    [
        _share_line("market_share", "share_of_type", "p_brand, p_type", MARKET_SHARE),
        _share_line("market_share", "share_of_brand", "p_brand", MARKET_SHARE),
        _share_line("market_share", "share_of_brand", "p_brand, p_type", MARKET_SHARE),
    ]
)


def fractional_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which measures of a line hold fractions, and since when; one changes its method."""
    lines = table(spark, sf_dir, "lineitem").select(
        month_of("l_shipdate").alias("report_month"),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        F.when(F.col("l_shipdate") >= "1998-06-01", F.col("l_quantity") / 2)
        .otherwise(F.col("l_quantity"))
        .alias("switched"),
    )
    return profiling.fractional_profile(lines, "report_month")


FRACTIONAL_PROFILE = """
WITH l AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m, l_quantity, l_extendedprice,
    l_discount,
    CASE WHEN l_shipdate >= DATE '1998-06-01' THEN l_quantity / 2 ELSE l_quantity END AS switched
  FROM lineitem
)
SELECT name AS "column", count(*) FILTER (WHERE value % 1 <> 0) > 0 AS fractional,
  min(m) FILTER (WHERE value % 1 <> 0) AS first_occurrence
FROM l UNPIVOT (value FOR name IN (l_quantity, l_extendedprice, l_discount, switched))
GROUP BY name
"""


def value_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequencies, group sizes, distinct counts and values outside a list, of documents.

    All but the distinct counts come from the sizes of the groups of both columns.
    """
    documents = table(spark, sf_dir, "documents").select("lang", "source", "doc_id")
    groups = profiling.group_sizes(documents, "lang", "source")
    languages = profiling.value_counts(groups, "lang", weight="count", ordered=False)
    sources = profiling.distinct_values(groups.where("count > 0"), "source", ordered=False)
    distinct = profiling.distinct_count(documents, "lang", "source", "doc_id")
    odd = languages.where(~F.col("lang").isin("en", "fr"))
    counts = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).alias("n")) for c in distinct.columns]
    )
    distinct = distinct.select(F.inline(counts))
    frames = [
        _profile("value_counts", languages, F.col("lang"), F.col("count")),
        _profile("distinct_values", sources, F.col("source"), F.lit(1).cast("bigint")),
        _profile("group_sizes", groups, F.concat_ws("/", "lang", "source"), F.col("count")),
        _profile("distinct_count", distinct, F.col("name"), F.col("n")),
        _profile("offending_values", odd, F.col("lang"), F.col("count")),
    ]
    return reduce(DataFrame.unionByName, frames)


def _profile(kind: str, df: DataFrame, value, count) -> DataFrame:
    return df.select(F.lit(kind).alias("profile"), value.alias("value"), count.alias("n"))


VALUE_PROFILE = """
SELECT 'value_counts' AS profile, lang AS value, CAST(count(*) AS BIGINT) AS n
  FROM documents WHERE lang IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'distinct_values', source, 1 FROM (SELECT DISTINCT source FROM documents)
UNION ALL SELECT 'group_sizes', concat_ws('/', lang, source), count(*)
  FROM documents GROUP BY lang, source
UNION ALL SELECT 'distinct_count', 'lang', count(DISTINCT lang) FROM documents
UNION ALL SELECT 'distinct_count', 'source', count(DISTINCT source) FROM documents
UNION ALL SELECT 'distinct_count', 'doc_id', count(DISTINCT doc_id) FROM documents
UNION ALL SELECT 'offending_values', lang, count(*)
  FROM documents WHERE lang NOT IN ('en', 'fr') GROUP BY lang
"""


def ratio_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value of open against finished orders in the last fifteen months."""
    status, value = F.col("o_orderstatus"), cents("o_totalprice")
    months = (
        table(spark, sf_dir, "orders")
        .groupBy(month_of("o_orderdate").alias("report_month"))
        .agg(
            F.sum(F.when(status == "O", value)).alias("open_cents"),
            F.sum(F.when(status == "F", value)).alias("finished_cents"),
        )
    )
    ratios = profiling.ratio_by_period(months, "open_cents", "finished_cents", "report_month")
    return profiling.last_rows(ratios, ["report_month"], 15)


RATIO_LAST_N = """
SELECT *, CAST(open_cents AS DOUBLE) / nullif(CAST(finished_cents AS DOUBLE), 0) AS ratio FROM (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (WHERE o_orderstatus = 'O')
      AS BIGINT) AS open_cents,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (WHERE o_orderstatus = 'F')
      AS BIGINT) AS finished_cents
  FROM orders GROUP BY ALL)
ORDER BY report_month DESC LIMIT 15
"""

def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and types of the lines, and how many rows have a value."""
    return profiling.profile_columns(table(spark, sf_dir, "lineitem"))


COLUMN_PROFILE = """
WITH d AS (
  SELECT column_name, CASE column_type
      WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
      ELSE lower(column_type) END AS type
  FROM (DESCRIBE SELECT * FROM lineitem)
), n AS (
  SELECT name, n_present FROM (SELECT count(COLUMNS(*)) FROM lineitem)
  UNPIVOT (n_present FOR name IN (COLUMNS(*)))
)
SELECT column_name AS "column", type, n_present,
  (SELECT count(*) FROM lineitem) - n_present AS n_missing
FROM d JOIN n ON name = column_name
"""


def first_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the first twelve months, by month."""
    months = profiling.group_sizes(
        table(spark, sf_dir, "lineitem").select(month_of("l_shipdate").alias("report_month")),
        "report_month",
    )
    return profiling.first_rows(months, ["report_month"], 12)


FIRST_MONTHS = """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS report_month,
  CAST(count(*) AS BIGINT) AS count
FROM lineitem GROUP BY ALL ORDER BY report_month LIMIT 12
"""

QUERIES = {
    "distinct_by_span": (distinct_by_span, DISTINCT_BY_SPAN),
    "frequent_parts": (frequent_parts, FREQUENT_PARTS),
    "dq_report": (dq_report, DQ_REPORT),
    "model_checks": (model_checks, MODEL_CHECKS),
    "shares_sum": (shares_sum, SHARES_SUM),
    "fractional_profile": (fractional_profile, FRACTIONAL_PROFILE),
    "value_profile": (value_profile, VALUE_PROFILE),
    "column_profile": (column_profile, COLUMN_PROFILE),
    "ratio_last_n": (ratio_last_n, RATIO_LAST_N),
    "first_months": (first_months, FIRST_MONTHS),
}
