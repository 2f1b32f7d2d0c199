"""Raw tables brought up to date by file: what changes, what stays, and that it equals a full load."""

from __future__ import annotations

import json

import pytest

from caseload.plans.pipeline import build_models, load_raw, load_restated
from caseload.sources.sinks import file_hashes
from landing import land_all
from test_workbook import as_workbooks
from caseload.plans.pipeline import SHEETS

COUNTY = "medicaid-enrollment-by-county-final-"


def counts(report):
    return {r.table: (r.status, r.new, r.restated, r.gone, r.kept) for r in report.collect()}


def rows(spark, table, without=("loaded_at",)):
    return sorted(map(str, spark.table(table).drop("source_file", *without).collect()))


def partitions(spark, table):
    return {r.source_file: r.version for r in spark.table(f"{table}_files").collect()}


def restate(path, add):
    lines = [json.loads(line) for line in path.read_text().splitlines()]
    for line in lines:
        if line["row_idx"] > 2 and line["cells"][0] not in (None, "TOTAL", "NaN"):
            line["cells"][2] = str(float(line["cells"][2] or 0) + add)
    path.write_text("\n".join(map(json.dumps, lines)) + "\n")


def test_restated_months(spark, tmp_path):
    folders = land_all(tmp_path)
    both = {t: folders[t] for t in ("enrollment_by_county", "timeliness_medicaid")}
    first = counts(load_restated(spark, both, namespace="months"))
    assert first == {"enrollment_by_county": ("loaded", 4, 0, 0, 0), "timeliness_medicaid": ("loaded", 5, 0, 0, 0)}
    load_raw(spark, both, namespace="months_whole")
    for table in both:
        assert rows(spark, f"MONTHS.{table}") == rows(spark, f"MONTHS_WHOLE.{table}")
    before = partitions(spark, "MONTHS.enrollment_by_county")

    # One month restated, one gone, one new; the others stay where they are.
    folder = tmp_path / "enrollment_by_county"
    restate(folder / f"{COUNTY}may-2024.jsonl", 1000)
    text = (folder / f"{COUNTY}june-2024.jsonl").read_text()
    (folder / f"{COUNTY}aug-2024.jsonl").write_text(text)
    folders_now = {"enrollment_by_county": str(tmp_path / "now")}
    (tmp_path / "now").mkdir()
    for file in folder.glob("*.jsonl"):
        if "april" not in file.name:
            (tmp_path / "now" / file.name).write_text(file.read_text())
    report = load_restated(spark, folders_now, namespace="months")
    assert counts(report) == {"enrollment_by_county": ("loaded", 1, 1, 1, 2)}
    assert report.first().n_rows == 2 * 255
    after = partitions(spark, "MONTHS.enrollment_by_county")
    assert {f for f in after if after[f] != before.get(f)} == {f"{COUNTY}may-2024.jsonl", f"{COUNTY}aug-2024.jsonl"}
    assert set(before) - set(after) == {f"{COUNTY}april-2024.jsonl"}
    load_raw(spark, folders_now, namespace="months_whole")
    assert rows(spark, "MONTHS.enrollment_by_county") == rows(spark, "MONTHS_WHOLE.enrollment_by_county")
    # The marts below see it.
    load_restated(spark, {t: folders[t] for t in folders if t != "enrollment_by_county"}, namespace="months")
    target = {"raw_namespace": "months", "mart_namespace": "month_marts"}
    assert [r.table for r in build_models(spark, **target, changed=["enrollment_by_county"]).collect()] == [
        "mart_enrollment_by_county"
    ]
    assert spark.table("MONTH_MARTS.mart_enrollment_by_county").count() == 3 * 255 * 8

    # Nothing changed: nothing is read or written.
    assert counts(load_restated(spark, folders_now, namespace="months")) == {
        "enrollment_by_county": ("loaded", 0, 0, 0, 4)
    }
    assert partitions(spark, "MONTHS.enrollment_by_county") == after


def test_a_failing_restatement_changes_nothing(spark, tmp_path):
    folders = {"enrollment_by_county": land_all(tmp_path)["enrollment_by_county"]}
    load_restated(spark, folders, namespace="failing")
    held = rows(spark, "FAILING.enrollment_by_county", ())
    (tmp_path / "enrollment_by_county" / "county-final-soon-2024.jsonl").write_text(
        json.dumps({"row_idx": 3, "cells": ["1", "x", *["1"] * 9]}) + "\n"
    )
    restate(tmp_path / "enrollment_by_county" / f"{COUNTY}may-2024.jsonl", 5)
    with pytest.raises(RuntimeError, match="enrollment_by_county"):
        load_restated(spark, folders, namespace="failing")
    report = load_restated(spark, folders, namespace="failing", tolerate=True)
    assert counts(report) == {"enrollment_by_county": ("failed", 1, 1, 0, 3)}
    assert rows(spark, "FAILING.enrollment_by_county", ()) == held


def test_workbooks_by_file(spark, tmp_path):
    folders = as_workbooks(tmp_path, SHEETS)
    assert file_hashes(spark, folders["htw_enrollment"], "*.xlsx").count() == 1
    report = counts(load_restated(spark, folders, namespace="restated_books", workbooks=True))
    assert report["timeliness_medicaid"] == ("loaded", 5, 0, 0, 0)
    load_raw(spark, folders, namespace="whole_books", workbooks=True)
    for table in folders:
        assert rows(spark, f"RESTATED_BOOKS.{table}") == rows(spark, f"WHOLE_BOOKS.{table}")
