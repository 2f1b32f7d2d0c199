"""The whole batch: landed sheets to raw tables, staging views, mart tables and checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import Check, run_all
from ..sources import grid as sheets
from ..sources.sinks import (
    Outcome,
    file_hashes,
    load_report,
    publish_changed,
    publish_table,
    publish_view,
    raise_failed,
    reasons_per_file,
    target_namespace,
    with_audit_time,
)
from ..sources.workbook import read_workbooks
from . import marts, raw, staging
from .checks import AUDIT_COLUMN, declared_checks, documented_checks, grain_checks
from .graph import Model, ModelGraph, together

RAW = {
    "enrollment_by_risk_group": raw.enrollment_by_risk_group,
    "chip_enrollment_detail": raw.chip_enrollment_detail,
    "htw_enrollment": raw.htw_enrollment,
    "enrollment_by_county": raw.enrollment_by_county,
    "timeliness_medicaid": raw.timeliness_medicaid,
    "mco_enrollment_by_sda": raw.mco_enrollment_by_sda,
}
# The sheets of the published workbooks, by name or place.
SHEETS: dict[str, str | int] = {
    "enrollment_by_risk_group": "Caseload by RG",
    "chip_enrollment_detail": "CHIP Regular Caseload",
    "htw_enrollment": "Summary",
    "enrollment_by_county": "Summary",
    "timeliness_medicaid": "Medicaid",
    "mco_enrollment_by_sda": 0,
}
STAGING = {
    "stg_enrollment_by_risk_group": (
        staging.stg_enrollment_by_risk_group,
        "enrollment_by_risk_group",
    ),
    "stg_enrollment_by_county": (staging.stg_enrollment_by_county, "enrollment_by_county"),
    "stg_chip_enrollment": (staging.stg_chip_enrollment, "chip_enrollment_detail"),
    "stg_htw_caseload": (staging.stg_htw_caseload, "htw_enrollment"),
    "stg_timeliness_medicaid": (staging.stg_timeliness_medicaid, "timeliness_medicaid"),
    "stg_mco_enrollment_by_sda": (staging.stg_mco_enrollment_by_sda, "mco_enrollment_by_sda"),
}
MARTS = {
    "mart_enrollment_trends": (marts.mart_enrollment_trends, "stg_enrollment_by_risk_group"),
    "mart_enrollment_by_county": (marts.mart_enrollment_by_county, "stg_enrollment_by_county"),
    "mart_timeliness_performance": (marts.mart_timeliness_performance, "stg_timeliness_medicaid"),
    "mart_chip_enrollment": (marts.mart_chip_enrollment, "stg_chip_enrollment"),
    "mart_htw_caseload": (marts.mart_htw_caseload, "stg_htw_caseload"),
    "mart_mco_enrollment": (marts.mart_mco_enrollment, "stg_mco_enrollment_by_sda"),
}


#: All models by name, over the raw tables.
GRAPH = ModelGraph(
    [Model(name, build, (source,), is_view=True) for name, (build, source) in STAGING.items()]
    + [Model(name, build, (source,)) for name, (build, source) in MARTS.items()],
    RAW,
)


def load_raw(
    spark: SparkSession,
    landing: Mapping[str, str],
    *,
    namespace: str = "raw",
    tolerate: bool = False,
    fiscal_year: int = raw.MCO_FISCAL_YEAR,
    workbooks: bool = False,
) -> DataFrame:
    """Replace the raw tables from landed sheets; `landing` maps a table to its folder.

    With `workbooks` the folders hold the published workbooks themselves, else their sheets as JSON
    lines. Each sheet is read once: its rows go to `<table>_rows`, by whether they are loaded, and with
    the reason where they are not; the table and the report come from there. A table that fails does not
    keep the others from loading. The failures are raised at the end, or with `tolerate` only reported.
    Returns the load report, per table and per file. `fiscal_year` is the year of the plan matrix, which
    its sheets don't tell.
    """
    database = target_namespace(namespace, "default")

    def load(table: str, path: str) -> Outcome:
        if workbooks:
            grid = read_workbooks(spark, path, SHEETS[table]).drop("sheet")
        else:
            grid = sheets.read_grid(spark, path)
        loaded = F.when(F.col("reason").isNull(), "loaded").otherwise("skipped")
        judged = RAW[table].judge(grid).withColumn("outcome", loaded)
        kept = publish_table(judged, f"{table}_rows", namespace=namespace, partition_by=["outcome"])
        if kept.status != "loaded":
            return replace(kept, table=table)
        rows = spark.table(f"`{database}`.`{table}_rows`").where("outcome = 'loaded'")
        given = {"fiscal_year": fiscal_year} if table == "mco_enrollment_by_sda" else {}
        frame = RAW[table].load(rows, **given)
        return publish_table(frame, table, namespace=namespace, audit_column="loaded_at")

    outcomes = together({table: partial(load, table, path) for table, path in landing.items()})
    if not tolerate:
        raise_failed(list(outcomes.values()))
    per_file = [
        reasons_per_file(spark.table(f"`{database}`.`{table}_rows`"), table)
        for table, outcome in outcomes.items()
        if outcome.status == "loaded"
    ]
    return reduce(DataFrame.unionByName, [load_report(spark, list(outcomes.values())), *per_file])


def load_restated(
    spark: SparkSession,
    landing: Mapping[str, str],
    *,
    namespace: str = "raw",
    tolerate: bool = False,
    fiscal_year: int = raw.MCO_FISCAL_YEAR,
    workbooks: bool = False,
) -> DataFrame:
    """Bring raw tables up to date by file: only files that are new or restated are read and loaded.

    Tables have a partition per file (see `publish_changed`) and are equal to those of a full load of
    the same folders, with `source_file` besides. Returns per table its outcome and the numbers of files
    that were new, restated, gone and kept; marts below a table with changes are built again by
    `build_models(changed=...)`.
    """

    def load(table: str, path: str) -> tuple[Outcome, dict[str, int]]:
        def rows_of(paths: list[str]) -> DataFrame:
            if workbooks:
                grid = read_workbooks(spark, paths, SHEETS[table]).drop("sheet")
            else:
                grid = sheets.read_grid(spark, paths)
            rows = RAW[table].judge(grid).where("reason IS NULL")
            given = {"fiscal_year": fiscal_year} if table == "mco_enrollment_by_sda" else {}
            return RAW[table].load(rows, keep=["source_file"], **given)

        files = file_hashes(spark, path, "*.xlsx" if workbooks else "*")
        return publish_changed(table, files, rows_of, namespace=namespace, audit_column="loaded_at")

    done = together({table: partial(load, table, path) for table, path in landing.items()})
    if not tolerate:
        raise_failed([outcome for outcome, _ in done.values()])
    rows = [(table, o.status, o.n_rows, o.message, *counts.values()) for table, (o, counts) in done.items()]
    columns = "table STRING, status STRING, n_rows BIGINT, message STRING, new INT, restated INT, gone INT, kept INT"
    return spark.createDataFrame(rows, columns)


def build_models(
    spark: SparkSession,
    *,
    raw_namespace: str = "raw",
    mart_namespace: str = "marts",
    only: Sequence[str] | None = None,
    changed: Sequence[str] | None = None,
) -> DataFrame:
    """Offer the staging views over the raw tables and replace the mart tables, in the graph's order.

    `only` names the marts to build, with the views that they read; `changed` the raw tables (or models)
    below which everything is built again, and nothing else. Returns the load report of the marts and
    raises if one of them failed.
    """
    names = set(GRAPH.models) if only is None else GRAPH.above(only)
    if changed is not None:
        names &= GRAPH.below(changed)
    source, target = (target_namespace(n, "default") for n in (raw_namespace, mart_namespace))
    views: dict[str, DataFrame] = {}

    def read(name: str) -> DataFrame:
        if name in RAW:
            return spark.table(f"`{source}`.`{name}`")
        if GRAPH.models[name].is_view:
            return views[name] if name in views else spark.table(name).drop(AUDIT_COLUMN)
        return spark.table(f"`{target}`.`{name}`")

    def publish(model: Model, frame: DataFrame) -> Outcome:
        if model.is_view:
            views[model.name] = frame
            publish_view(with_audit_time(frame, AUDIT_COLUMN), model.name)
            return Outcome(model.name, "loaded")
        return publish_table(frame, model.name, namespace=mart_namespace, audit_column=AUDIT_COLUMN)

    outcomes = GRAPH.build(read, publish, names)
    raise_failed(outcomes)
    return load_report(spark, [o for o in outcomes if not GRAPH.models[o.table].is_view])


def model_checks(name: str, staged: Mapping[str, DataFrame]) -> list[Check]:
    """The declared checks of a model, those of its grain, and what its documentation says."""
    return [*declared_checks(name), *grain_checks(name), *documented_checks(name, staged)]


def check_models(spark: SparkSession, *, mart_namespace: str = "marts") -> DataFrame:
    """The report of all checks on the staging views and the mart tables."""
    target = target_namespace(mart_namespace, "default")
    staged = {name: spark.table(name) for name in STAGING}
    models = staged | {name: spark.table(f"`{target}`.`{name}`") for name in MARTS}
    return run_all({name: (df, model_checks(name, staged)) for name, df in models.items()})
