"""Small sheets with the layouts and oddities of the published ones, as JSON lines."""

from __future__ import annotations

import json
from datetime import date
from pathlib import Path

RISK_HEADER = [
    "Month", "Medicaid Caseload", "Aged & Medicare-Related", "Disability-Related", "Parents*",
    "Pregnant Women", "Breast and Cervical Cancer", "Children’s Medicaid",
    "Medicaid Clients Under 21", "Medicaid Clients 21 and Older", "Children’s Medicaid",
    "Regular CHIP", "Total",
]
REGIONS = ["01", "02/09", " 03 ", "04", "05", "MEPD", "ST OFFICE", "UNKNOWN", "VIC", None]
# More months, regions and plans than any published sheet has had.
MONTHS, MORE_REGIONS, PLANS = 200, 35, 25


def months(n: int, start: int = 2014 * 12 + 8) -> list[date]:
    return [date((start + i) // 12, (start + i) % 12 + 1, 1) for i in range(n)]


def write(folder: Path, name: str, rows: dict[int, list]) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    lines = [
        json.dumps({"row_idx": i, "cells": [None if c is None else str(c) for c in cells]})
        for i, cells in sorted(rows.items(), reverse=True)
    ]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def risk_group(folder: Path) -> None:
    rows = {0: ["Caseload by risk group"] + [None] * 12, 1: [None] * 13, 2: RISK_HEADER}
    for i, month in enumerate(months(MONTHS)):
        whole = [1000 + 10 * i + j for j in range(11)]
        if month >= date(2025, 8, 1):
            whole = [v + 0.25 for v in whole]
        rows[3 + i] = [f"{month} 00:00:00", *whole, 7]
    rows[3 + MONTHS] = [None] * 13
    rows[4 + MONTHS] = ["Notes: 1 2 3"] + [None] * 12
    write(folder, "monthly-enrollment-by-risk-group.jsonl", rows)


def chip(folder: Path) -> None:
    rows = {0: ["CHIP"] + [None] * 4, 1: ["Month", "CHIP Caseload", "New Enrollment", "Renewals", "Disenrollment"]}
    stock = 1000
    for i, month in enumerate(months(MONTHS)):
        rows[2 + i] = [month, stock, 30 + i % 5, 100, 20 + i % 3]
        stock += (30 + (i + 1) % 5) - (20 + (i + 1) % 3)
    rows[2 + MONTHS] = ["Note"] + [None] * 4
    write(folder, "chip-enrollment-detail.jsonl", rows)


def htw(folder: Path) -> None:
    rows = {0: ["Healthy Texas Women Caseload", None]}
    for i, month in enumerate(months(MONTHS)):
        rows[1 + i] = [month, 500 + i + (0.5 if month >= date(2025, 8, 1) else 0)]
    rows[1 + MONTHS] = ["Note", None]
    write(folder, "htw.jsonl", rows)


def county(folder: Path) -> None:
    for k, name in enumerate(["april-2024", "may-2024", "june-2024"]):
        rows = {0: ["x"] * 11, 2: [f"c{i}" for i in range(11)]}
        for code in range(1, 256):
            county_name = " Unknown" if code == 255 else f"County {code} "
            values = [code + k + j for j in range(9)]
            rows[2 + code] = [code, county_name, *values]
        rows[258] = ["TOTAL", None, *[9] * 9]
        rows[259] = ["NaN", "note", *[None] * 9]
        rows[260] = ["1d", "note", *[None] * 9]
        rows[261] = ["1e30", "no long", *[None] * 9]
        rows[262] = [None] * 11
        write(folder, f"medicaid-enrollment-by-county-final-{name}.jsonl", rows)
    narrow = {2: ["c"] * 10, 3: [1, "County 1", *[1] * 8]}
    write(folder, "medicaid-enrollment-by-county-final-july-2024.jsonl", narrow)


def timeliness(folder: Path) -> None:
    for k, name in enumerate(["jan-2025", "February-2025", "mar-2025", "April-2025"]):
        header = ["Region", "Disposed", "Timely", "Percent"]
        if k % 2:
            header = ["Region", "Percent", "Timely", "Disposed"]
        # The second table stands wherever the first one ends.
        regions = REGIONS + [f"R{i}" for i in range(MORE_REGIONS)]
        rows, second = {0: ["Timeliness"]}, 3 + 2 + len(regions) + 4
        for at in (3, second):
            rows[at] = header
            rows[at + 1] = ["all regions", 1, 1, 1]
            for i, region in enumerate(regions):
                disposed = None if region in ("MEPD", "ST OFFICE", "UNKNOWN") else 0 if i == 4 else 100
                timely = None if disposed is None else min(disposed, 80 + i + k)
                percent = None if not disposed else timely / disposed
                values = [disposed, timely, percent if disposed else disposed]
                rows[at + 2 + i] = [region, *(values[::-1] if k % 2 else values)]
            rows[at + 2 + len(regions)] = ["TOTAL", 1, 1, 1]
            rows[at + 3 + len(regions)] = ["* a note", None, None, None]
        write(folder, f"timeliness-medicaid-{name}.jsonl", rows)
    write(folder, "timeliness-notes.jsonl", {3: ["Region", "Disposed"], 4: [None], 5: ["01", 1, 1, 1]})


def mco(folder: Path) -> None:
    areas = [f"Area {i}" for i in range(6)]
    rows = {0: ["Plans"] + [None] * 7, 1: [None, *areas, "Total"]}
    for block in range(PLANS):
        for offset in range(10):
            served = [None if (block + a) % 3 == 0 else block + offset + a + 0.5 for a in range(6)]
            if block == 4:
                served = [12.0] + [None] * 5
            label = f"Plan\n{block} " if offset == 0 else "x"
            rows[2 + 10 * block + offset] = [label, *served, 99]
    rows[2 + 10 * PLANS] = ["Statewide"] + [1] * 7
    rows[3 + 10 * PLANS] = ["Note"] + [1] * 7
    write(folder, "mco-enrollment-by-sda-final-sfy25.jsonl", rows)


def land_all(root: Path) -> dict[str, str]:
    makers = {
        "enrollment_by_risk_group": risk_group,
        "chip_enrollment_detail": chip,
        "htw_enrollment": htw,
        "enrollment_by_county": county,
        "timeliness_medicaid": timeliness,
        "mco_enrollment_by_sda": mco,
    }
    for table, make in makers.items():
        make(root / table)
    return {table: str(root / table) for table in makers}
