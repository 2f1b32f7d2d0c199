"""Reshaping, labels, filters and cell functions on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import category_map, effective_dated_label, flag_in
from ..functions.names import month_from_name, normalise_columns, normalised, repaired_header
from ..functions.scalars import (
    clean_text,
    date_to_epoch_micros,
    epoch_micros_to_date,
    missing_to_null,
    round_to_long,
    strip,
)
from ..operators.as_of import label_as_of
from ..operators.reshape import union_by_name, wide_to_long
from ..operators.rows import drop_any_value, drop_listed, drop_value, keep_numeric_key, missing_rows
from .sheets import MONTH_IN_NAME
from .tables import cents, month_of, table


def wide_to_long_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value per month and status, side by side, made long; small cells are missing."""
    statuses = {"finished": "F", "open": "O", "pending": "P"}
    value = cents("o_totalprice")
    wide = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("report_day"))
        .agg(
            F.sum(value).alias("total"),
            *[
                F.sum(F.when(F.col("o_orderstatus") == status, value)).alias(name)
                for name, status in statuses.items()
            ],
        )
    )
    return wide_to_long(wide, ["report_day"], list(statuses), "status", "order_cents")


WIDE_TO_LONG = """
SELECT report_day, status, order_cents FROM (
  SELECT CAST(o_orderdate AS DATE) AS report_day,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (WHERE o_orderstatus = 'F')
      AS BIGINT) AS finished,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (WHERE o_orderstatus = 'O')
      AS BIGINT) AS open,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (WHERE o_orderstatus = 'P')
      AS BIGINT) AS pending
  FROM orders GROUP BY ALL)
UNPIVOT (order_cents FOR status IN (finished, open, pending))
"""


def category_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with the category of their type, where some types have none."""
    categories = {"small_ticket": ["SMALL", "PROMO"], "large_ticket": ["LARGE", "STANDARD"]}
    brands = ["Brand#1", "Brand#2", "Brand#3"]
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_type",
        category_map("p_type", categories).alias("category"),
        flag_in("p_brand", brands).alias("is_first_brand"),
        flag_in(F.when(F.col("p_size") > 5, F.col("p_brand")), brands).alias(
            "is_large_first_brand"
        ),
        (F.col("p_size") == 50).alias("is_largest"),
        F.lit("catalogue").alias("record_type"),
    )


CATEGORY_LABELS = """
SELECT p_partkey, p_type,
  CASE WHEN p_type IN ('SMALL', 'PROMO') THEN 'small_ticket'
       WHEN p_type IN ('LARGE', 'STANDARD') THEN 'large_ticket' END AS category,
  p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AS is_first_brand,
  p_size > 5 AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AS is_large_first_brand,
  p_size = 50 AS is_largest, 'catalogue' AS record_type
FROM part
"""


def effective_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month and priority with the method in force: three rules, one of them never."""
    series = table(spark, sf_dir, "orders").groupBy(
        month_of("o_orderdate").alias("report_month"), "o_orderpriority"
    )
    label = effective_dated_label(
        "report_month",
        "point_in_time",
        [("1998-08-01", "daily_average")],
        group="o_orderpriority",
        overrides={"1-URGENT": [], "2-HIGH": [("1998-09-01", "daily_average")]},
    )
    return series.agg(F.count(F.lit(1)).alias("n_orders")).withColumn("method", label)


def as_of_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the last urgent order of their customer, and the last large order of all, up to their
    day: breakpoints are rows, as many as there are such orders."""
    day = F.col("o_orderdate").cast("date")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice", day.alias("day")
    )
    step = [F.col("day").alias("effective_from"), F.col("o_orderkey").cast("string").alias("label")]
    urgent = orders.where("o_orderpriority = '1-URGENT'").select("o_custkey", *step)
    large = orders.where("o_totalprice >= 300000").select(*step)
    rows = orders.select("o_orderkey", "o_custkey", "day")
    labelled = label_as_of(rows, "day", urgent, ["o_custkey"], base="none", name="last_urgent")
    return label_as_of(labelled, "day", large, name="last_large")


AS_OF_LABELS = """
WITH o AS (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority, o_totalprice,
    CAST(o_orderkey AS VARCHAR) AS label
  FROM orders
),
u AS (SELECT o_custkey, day, max(label) AS label FROM o WHERE o_orderpriority = '1-URGENT' GROUP BY ALL),
l AS (SELECT day, max(label) AS label FROM o WHERE o_totalprice >= 300000 GROUP BY ALL)
SELECT o.o_orderkey, o.o_custkey, o.day, coalesce(u.label, 'none') AS last_urgent, l.label AS last_large
FROM o
ASOF LEFT JOIN u ON o.o_custkey = u.o_custkey AND o.day >= u.day
ASOF LEFT JOIN l ON o.day >= l.day
"""


EFFECTIVE_LABELS = """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month, o_orderpriority,
  CAST(count(*) AS BIGINT) AS n_orders,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'point_in_time'
       WHEN o_orderpriority = '2-HIGH' AND date_trunc('month', o_orderdate) >= DATE '1998-09-01'
         THEN 'daily_average'
       WHEN o_orderpriority <> '2-HIGH' AND date_trunc('month', o_orderdate) >= DATE '1998-08-01'
         THEN 'daily_average'
       ELSE 'point_in_time' END AS method
FROM orders GROUP BY ALL
"""


def epoch_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event days as epoch microseconds, and back."""
    micros = date_to_epoch_micros(F.col("ts").cast("date"))
    later = micros + F.col("event_id") % 86_400_000_000
    return table(spark, sf_dir, "events").select(
        "event_id", micros.alias("micros"), epoch_micros_to_date(later).alias("day")
    )


EPOCH_DATES = """
SELECT event_id, epoch_us(date_trunc('day', ts)) AS micros, CAST(ts AS DATE) AS day FROM events
"""


def numeric_key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose text key is a number; NaN, units and words are no keys."""
    number = F.regexp_extract("props", '"k": ([0-9]+)', 1)
    spelled = (
        F.when(F.col("event_type") == "view", number)
        .when(F.col("event_type") == "click", F.concat(F.lit("  "), number, F.lit(" ")))
        .when(F.col("event_type") == "signup", F.concat(number, F.lit("d")))
        .when(F.col("event_type") == "purchase", F.lit("NaN"))
        .otherwise(F.concat(number, F.lit(".0")))
    )
    keyed = table(spark, sf_dir, "events").select(
        "event_id", "event_type", spelled.alias("key"), round_to_long("value").alias("rounded"),
        missing_to_null("value").alias("value"),
    )
    return keep_numeric_key(keyed, "key")


NUMERIC_KEY_ROWS = """
SELECT event_id, event_type, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS key,
  CAST(round(value) AS BIGINT) AS rounded, value
FROM events WHERE event_type NOT IN ('signup', 'purchase')
  AND regexp_extract(props, '"k": ([0-9]+)', 1) <> ''
"""


def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations on one line, with their words counted."""
    cleaned = clean_text("text")
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.trim("role").alias("role"),
        cleaned.alias("cleaned"),
        F.size(F.split(F.lower(cleaned), " ")).cast("bigint").alias("n_words"),
        strip(F.replace("text", F.lit("."), F.lit("_"))).alias("underscored"),
    )


_WHITE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def _stripped(text: str) -> str:
    return f"regexp_replace({text}, '^{_WHITE}+|{_WHITE}+$', '', 'g')"


TEXT_CLEAN = f"""
SELECT conv_id, turn, trim(role) AS role, cleaned,
  CAST(len(string_split(lower(cleaned), ' ')) AS BIGINT) AS n_words, underscored
FROM (SELECT *, {_stripped("replace(text, chr(10), ' ')")} AS cleaned,
        {_stripped("replace(text, '.', '_')")} AS underscored FROM conversations)
"""


def exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines counted after filters that keep, or drop, rows with a missing value."""
    line = F.col("l_linenumber")
    spelled = table(spark, sf_dir, "lineitem").select(
        F.when(line == 1, "TOTAL").when(line == 2, None).otherwise("part").alias("level"),
        F.when(line == 3, None).otherwise(F.col("l_returnflag")).alias("program"),
        F.when(line == 4, None).otherwise(F.col("l_linestatus")).alias("sub_program"),
        F.when(line == 5, " MEPD ").when(F.col("l_quantity") < 5, None)
        .otherwise(F.concat(F.lit(" "), F.col("l_linestatus"))).alias("region"),
        F.when(F.col("l_tax") > 0, F.col("l_quantity")).alias("measure"),
    )
    kept = drop_value(spelled, "level", "TOTAL")
    kept = drop_any_value(kept, {"program": "A", "sub_program": "F"})
    kept = drop_listed(kept, "region", ["MEPD", "UNKNOWN"])
    return kept.groupBy("level", "program", "sub_program", "region").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("measure").alias("n_present"),
        F.sum("measure").alias("measure"),
    )


_SPELLED_LINES = """
  SELECT CASE l_linenumber WHEN 1 THEN 'TOTAL' WHEN 2 THEN NULL ELSE 'part' END AS level,
    CASE l_linenumber WHEN 3 THEN NULL ELSE l_returnflag END AS program,
    CASE l_linenumber WHEN 4 THEN NULL ELSE l_linestatus END AS sub_program,
    CASE WHEN l_linenumber = 5 THEN ' MEPD ' WHEN l_quantity < 5 THEN NULL
      ELSE ' ' || l_linestatus END AS region,
    CASE WHEN l_tax > 0 THEN l_quantity END AS measure
  FROM lineitem"""
EXCLUSIONS = f"""
SELECT level, program, sub_program, region, CAST(count(*) AS BIGINT) AS n_rows,
  CAST(count(measure) AS BIGINT) AS n_present, sum(measure) AS measure
FROM ({_SPELLED_LINES})
WHERE (level IS NULL OR level <> 'TOTAL')
  AND NOT (coalesce(program, '') = 'A' OR coalesce(sub_program, '') = 'F')
  AND trim(region) NOT IN ('MEPD', 'UNKNOWN')
GROUP BY ALL
"""


def missing_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label, by language and source."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    unlabelled = missing_rows(documents.join(labels, "doc_id", "left"), "quality")
    return unlabelled.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_missing"))


MISSING_MEASURES = """
SELECT lang, source, CAST(count(*) AS BIGINT) AS n_missing
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NULL GROUP BY ALL
"""


def stacked_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers under one another, columns aligned by name."""
    customers = table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("record_type"),
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
        F.col("s_suppkey").alias("key"),
        F.lit("supplier").alias("record_type"),
    )
    return union_by_name(customers, suppliers)


STACKED_UNION = """
SELECT 'customer' AS record_type, c_custkey AS key, c_name AS name, c_mktsegment AS segment,
  CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, NULL, s_acctbal FROM supplier
"""


def months_from_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File-like names built from order dates, read back strictly and leniently."""
    day = F.col("o_orderdate").cast("date")
    spelled = F.element_at(F.array(*[F.lit(m) for m in MONTH_IN_NAME]), F.month(day))
    strict = F.concat(F.lit("Enrollment-Final-"), F.initcap(spelled), F.lit("-"), F.year(day))
    long = F.concat(F.date_format(day, "MMMM"), F.lit("-"), F.year(day), F.lit(".xlsx"))
    prefix = F.when(F.year(day) == 1995, "summary-").otherwise("medicaid-")
    names = (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.concat(strict, F.lit(".xlsx")).alias("strict_name"),
            F.concat(F.lit("timeliness-"), prefix, long).alias("lenient_name"),
        )
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )
    return names.select(
        "strict_name",
        month_from_name("strict_name").alias("strict_month"),
        month_from_name("lenient_name", on_unknown="skip").alias("lenient_month"),
        "n_orders",
    )


_SHORT = "['" + "', '".join(m.title() for m in MONTH_IN_NAME) + "']"
MONTHS_FROM_NAMES = f"""
SELECT 'Enrollment-Final-' || {_SHORT}[month(m)] || '-' || year(m) || '.xlsx' AS strict_name,
  m AS strict_month, CASE WHEN year(m) <> 1995 THEN m END AS lenient_month, n_orders
FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
        CAST(count(*) AS BIGINT) AS n_orders
      FROM orders GROUP BY ALL)
"""


def header_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts as header cells, repaired and normalised, next to plain renaming."""
    headers = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.array(
            F.concat(F.lit(" "), F.initcap("p_name"), F.lit("*")),
            F.lit(None).cast("string"),
            F.concat(F.col("p_brand"), F.lit(" & "), F.col("p_type")),
            F.concat(F.lit("Children’s-"), F.col("p_type")),
            F.concat(F.col("p_brand"), F.lit(" & "), F.col("p_type")),
        ).alias("cells"),
    )
    names = F.transform(repaired_header(F.col("cells")), lambda c: normalised(c))
    basic = F.transform(repaired_header(F.col("cells")), lambda c: normalised(c, "basic"))
    spelled = headers.select(
        F.col("p_partkey").alias(" P_PartKey* "),
        F.array_join(names, "|").alias("Full Name"),
        F.array_join(basic, "|").alias("Basic-Name."),
    )
    return normalise_columns(spelled)


HEADER_NAMES = """
SELECT p_partkey,
  replace(lower(p_name), ' ', '_') || '|unnamed:_1|'
    || replace(lower(p_brand), ' ', '_') || '_and_' || lower(p_type) || '|childrens_'
    || lower(p_type) || '|' || replace(lower(p_brand), ' ', '_') || '_and_' || lower(p_type) || '_1'
    AS full_name,
  replace(lower(p_name), ' ', '_') || '*|unnamed:_1|'
    || lower(p_brand) || '_&_' || lower(p_type) || '|children’s-'
    || lower(p_type) || '|' || lower(p_brand) || '_&_' || lower(p_type) || '.1' AS basic_name_
FROM part
"""

QUERIES = {
    "wide_to_long": (wide_to_long_query, WIDE_TO_LONG),
    "category_labels": (category_labels, CATEGORY_LABELS),
    "as_of_labels": (as_of_labels, AS_OF_LABELS),
    "effective_labels": (effective_labels, EFFECTIVE_LABELS),
    "epoch_dates": (epoch_dates, EPOCH_DATES),
    "numeric_key_rows": (numeric_key_rows, NUMERIC_KEY_ROWS),
    "text_clean": (text_clean, TEXT_CLEAN),
    "exclusions": (exclusions, EXCLUSIONS),
    "missing_measures": (missing_measures, MISSING_MEASURES),
    "stacked_union": (stacked_union, STACKED_UNION),
    "month_from_name": (months_from_names, MONTHS_FROM_NAMES),
    "header_names": (header_names, HEADER_NAMES),
}
