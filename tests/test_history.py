"""Window expressions against a slot-by-slot computation in Python."""

import random

import pytest

from bureauframe.functions import history as h

OFFSETS = [None, *range(-45, 46, 3), -1, 1, 2, 36, 37]


@pytest.fixture(scope="module")
def cases(spark):
    rng = random.Random(7)
    rows = []
    for i, md in enumerate(OFFSETS):
        arr = [rng.choice([None, 0.0, float(rng.randint(1, 200))]) for _ in range(37)]
        marks = [s if v is not None and v >= 30 else None for s, v in enumerate(arr)]
        rows.append((i, md, arr, marks))
    df = spark.createDataFrame(rows, "i int, md int, arr array<double>, marks array<int>").cache()
    return rows, df


def slots(arr, md, first, end):
    if md is None:
        return []
    return [arr[k - md] for k in range(first, end) if 0 <= k - md <= 36]


def known(values):
    return [v for v in values if v is not None]


@pytest.mark.parametrize(("months", "first"), [(3, 0), (6, 0), (12, 0), (36, 0), (15, 3)])
def test_window_extremes(cases, months, first):
    rows, df = cases
    top = h.window_max("arr", "md", months, first)
    covered = h.months_covered("md", months, first)
    got = {r["i"]: r for r in df.selectExpr("i", f"{top} AS top", f"{covered} AS n").collect()}
    for i, md, arr, _ in rows:
        inside = slots(arr, md, first, months)
        assert got[i]["top"] == max(known(inside), default=None), (md, months)
        assert got[i]["n"] == (None if md is None else len(inside)), (md, months)


@pytest.mark.parametrize("months", [3, 6, 12])
def test_sums_counts_and_newest(cases, months):
    rows, df = cases
    values = h.months_aligned("arr", "md", months)
    share = h.share_positive(values, h.months_covered("md", months))
    got = {
        r["i"]: r
        for r in df.selectExpr(
            "i",
            f"{h.total(values)} AS total",
            f"{h.known_count(values)} AS n",
            f"{h.newest(values)} AS newest",
            f"{share} AS share",
        ).collect()
    }
    for i, md, arr, _ in rows:
        inside = slots(arr, md, 0, months)
        have = known(inside)
        assert got[i]["total"] == (sum(have) if have else None)
        assert got[i]["n"] == (len(have) or None)
        assert got[i]["newest"] == (have[0] if have else None)
        hits = sum(1 for v in have if v > 0)
        assert got[i]["share"] == (hits / len(inside) if inside else None)


def test_distance_ignores_the_future(cases):
    rows, df = cases
    got = {r["i"]: r["d"] for r in df.selectExpr("i", f"{h.months_to_last('marks', 'md')} AS d").collect()}
    for i, md, _, marks in rows:
        past = [] if md is None else [md + s for s in known(marks) if md + s >= 0]
        assert got[i] == min(past, default=None), md


def test_value_as_of(cases):
    rows, df = cases
    got = {r["i"]: r["v"] for r in df.selectExpr("i", f"{h.value_as_of('arr', 'md')} AS v").collect()}
    for i, ahead, arr, _ in rows:
        if ahead is None or ahead > 36:
            assert got[i] is None
        else:
            assert got[i] == arr[max(ahead, 0)]
