"""The graph of models, on plain models and on the published ones, and atomic replacement."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from caseload.plans.graph import Model, ModelGraph, together
from caseload.plans.pipeline import GRAPH, MARTS, RAW, STAGING, build_models, load_raw
from caseload.session import shared_folder
from caseload.sources import sinks
from caseload.sources.sinks import Outcome, publish_table, published_versions, read_published
from landing import PLANS, land_all
from test_workbook import as_workbooks
from caseload.plans.pipeline import SHEETS


def model(name, *reads):
    return Model(name, lambda *frames: [name, *frames], reads)


DIAMOND = [model("d", "b", "c"), model("b", "a"), model("c", "a", "src2"), model("a", "src"), model("alone", "src2")]


def run(graph, names=None, failing=()):
    done, lock = {s: s for s in graph.sources}, threading.Lock()

    def publish(m, frame):
        if m.name in failing:
            raise ValueError(f"no {m.name}\nand more")
        with lock:
            done[m.name] = frame
        return Outcome(m.name, "loaded", 1)

    return graph.build(lambda n: done[n], publish, names, at_once=3), done


def test_models_are_built_after_what_they_read():
    graph = ModelGraph(DIAMOND, ["src", "src2"])
    for name, at in ((m.name, graph.order.index(m.name)) for m in DIAMOND):
        assert all(graph.order.index(r) < at for r in graph.models[name].reads if r in graph.models)
    outcomes, done = run(graph)
    assert [o.status for o in outcomes] == ["loaded"] * 5
    assert done["d"] == ["d", ["b", ["a", "src"]], ["c", ["a", "src"], "src2"]]


def test_what_lies_below_and_above():
    graph = ModelGraph(DIAMOND, ["src", "src2"])
    assert graph.below(["src2"]) == {"c", "d", "alone"}
    assert graph.below(["b"]) == {"b", "d"}
    assert graph.above(["c"]) == {"a", "c"}
    outcomes, done = run(ModelGraph(DIAMOND[3:], ["src", "src2"]), {"alone"})
    assert [o.table for o in outcomes] == ["alone"] and "a" not in done
    with pytest.raises(ValueError, match="unknown names: x"):
        graph.below(["x"])


def test_below_a_failure_models_are_skipped():
    outcomes, done = run(ModelGraph(DIAMOND, ["src", "src2"]), failing={"b"})
    assert {o.table: (o.status, o.message) for o in outcomes} == {
        "a": ("loaded", ""), "alone": ("loaded", ""), "c": ("loaded", ""),
        "b": ("failed", "no b"), "d": ("skipped", "not built: b"),
    }


def test_cycles_and_unknown_names_are_errors():
    with pytest.raises(ValueError, match="models read each other: .*a.*<-"):
        ModelGraph([model("a", "b"), model("b", "c"), model("c", "a")], [])
    with pytest.raises(ValueError, match="a reads unknown names: nowhere"):
        ModelGraph([model("a", "nowhere")], ["src"])
    with pytest.raises(ValueError, match="two models or sources are named a"):
        ModelGraph([model("a", "src"), model("a", "src")], ["src"])


def test_independent_models_are_built_at_the_same_time():
    meeting = threading.Barrier(2, timeout=20)
    models = [Model(n, lambda *_: meeting.wait(), ("src",)) for n in ("a", "b")]
    outcomes = ModelGraph(models, ["src"]).build(lambda n: n, lambda m, _: Outcome(m.name, "loaded"))
    assert [o.status for o in outcomes] == ["loaded"] * 2
    assert together({"x": lambda: 1, "y": lambda: 2}) == {"x": 1, "y": 2}


def test_the_published_graph():
    assert set(GRAPH.models) == {*STAGING, *MARTS} and GRAPH.sources == set(RAW)
    assert GRAPH.below(["htw_enrollment"]) == {"stg_htw_caseload", "mart_htw_caseload"}


def versions(spark, namespace):
    """Where the names of a namespace point to."""
    tables = [t.name for t in spark.catalog.listTables(f"`{namespace}`") if t.namespace and not t.isTemporary]
    return {t: sinks.current_version(spark, f"`{namespace}`.`{t}`")[1] for t in tables}


def test_one_changed_raw_table_rebuilds_what_lies_below_it(spark, tmp_path):
    folders = as_workbooks(tmp_path, SHEETS)
    report = load_raw(spark, folders, namespace="books", workbooks=True).collect()
    loaded = {r.table: r.n_rows for r in report if r.file is None}
    assert len(loaded) == 6 and loaded["mco_enrollment_by_sda"] == 7 * sum(1 if b == 4 else 4 for b in range(PLANS))
    assert ("htw.xlsx", "skipped", 1) in {(r.file, r.status, r.n_rows) for r in report}
    target = {"raw_namespace": "books", "mart_namespace": "book_marts"}
    assert len(build_models(spark, **target).collect()) == 6
    before = versions(spark, "BOOK_MARTS")
    load_raw(spark, {"htw_enrollment": folders["htw_enrollment"]}, namespace="books", workbooks=True)
    built = build_models(spark, **target, changed=["htw_enrollment"]).collect()
    assert [r.table for r in built] == ["mart_htw_caseload"]
    after = versions(spark, "BOOK_MARTS")
    assert {t for t in after if after[t] != before[t]} == {"mart_htw_caseload"}


def test_rows_of_a_sheet_are_kept_by_outcome(spark, tmp_path):
    folders = land_all(tmp_path)
    load_raw(spark, {"enrollment_by_county": folders["enrollment_by_county"]}, namespace="kept")
    rows = spark.table("KEPT.enrollment_by_county_rows")
    counts = {(r.outcome, r.reason): r["count"] for r in rows.groupBy("outcome", "reason").count().collect()}
    assert counts[("loaded", None)] == 3 * 255 and counts[("skipped", "not 11 columns")] == 1


def test_a_write_that_fails_half_way_leaves_the_old_rows(spark):
    good = spark.range(100).withColumn("x", F.col("id") * 2)
    half = good.repartition(4).withColumn("x", F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("x")))
    path = shared_folder(spark)
    for target in ({"path": path}, {"namespace": "atomic"}):
        assert publish_table(good, "t", **target).status == "loaded"
        held = read_published(spark, path) if "path" in target else spark.table("ATOMIC.t")
        assert publish_table(half, "t", **target).status == "failed"
        now = read_published(spark, path) if "path" in target else spark.table("ATOMIC.t")
        assert now.count() == 100 and now.agg(F.sum("x")).first()[0] == 9900
        # Another schema, and a reader of the version before goes on.
        assert publish_table(good.limit(3).select("id"), "t", **target).n_rows == 3
        assert held.agg(F.sum("x")).first()[0] == 9900
        now = read_published(spark, path) if "path" in target else spark.table("ATOMIC.t")
        assert (now.columns, now.count()) == (["id"], 3)
    assert [r.n_rows for r in published_versions(spark, path).collect()] == [3, 100]


def test_old_versions_can_be_dropped(spark):
    for n in (1, 2, 3, 4):
        publish_table(spark.range(n), "t", namespace="versions")
    folder, current = sinks.current_version(spark, "VERSIONS.t")
    assert len(sinks.drop_old_versions(spark, folder, current, keep=1)) == 2
    assert spark.table("VERSIONS.t").count() == 4
    assert sinks.drop_old_versions(spark, folder, current, keep=1) == []


def test_a_table_of_the_old_kind_is_replaced(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS OLDKIND")
    spark.range(5).write.saveAsTable("OLDKIND.t")
    assert publish_table(spark.range(2), "t", namespace="oldkind").status == "loaded"
    assert spark.table("OLDKIND.t").count() == 2
