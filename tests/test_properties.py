"""Operators against plain Python on generated tables."""

from __future__ import annotations

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tiermill.functions import reconcile_amounts, standardize_codes, strip_prefix, yyyymmdd_to_timestamp
from tiermill.operators import keep_first, orphan_keys, running_max_fill, surrogate_key, version_end_date

few = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)
keys = st.one_of(st.none(), st.sampled_from(["", "a", "A", "b", "é", "zz"]))
starts = st.one_of(st.none(), st.sampled_from(["2003", "2004", "2005", "2010", "NaN"]))


def last(value):
    """Sort key that puts None last."""
    return (value is None, value or "")


@few
@given(st.lists(st.tuples(keys, starts), max_size=60))
def test_surrogate_key(spark, data):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(data)], "i int, k string, s string")
    got = sorted(tuple(r) for r in surrogate_key(df, ["k", "s", "i"], "sk").collect())
    ordered = sorted(enumerate(data), key=lambda r: (last(r[1][0]), last(r[1][1]), r[0]))
    assert got == [(n + 1, i, *row) for n, (i, row) in enumerate(ordered)]


@few
@given(st.lists(st.tuples(keys, starts), max_size=60))
def test_version_end(spark, data):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(data)], "i int, k string, s string")
    got = {r["i"]: r["e"] for r in version_end_date(df, "k", "s", "e", ["i"]).collect()}
    expected = {}
    for key in {row[0] for row in data}:
        versions = sorted(((i, s) for i, (k, s) in enumerate(data) if k == key), key=lambda v: (last(v[1]), v[0]))
        for (i, _), following in zip(versions, [*versions[1:], (None, None)]):
            expected[i] = following[1]
    assert got == expected


@few
@given(st.lists(st.tuples(keys, starts), max_size=60))
def test_running_max(spark, data):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(data)], "i int, k string, s string")
    filled = running_max_fill(df, "s", "k", "none")
    got = {r["i"]: r["s"] for r in filled.collect()}
    usable = [(i, k, None if s == "NaN" else s) for i, (k, s) in enumerate(data)]
    best, expected = None, {}
    for i, _, s in sorted(usable, key=lambda r: (last(r[1]), r[2] is not None, r[2] or "")):
        best = s if best is None else max(best, s or best)
        expected[i] = best or "none"
    assert got == expected


@few
@given(st.lists(st.tuples(keys, starts, st.integers(0, 3)), max_size=60), st.booleans())
def test_keep_first(spark, data, first):
    df = spark.createDataFrame(data, "k string, s string, n int")
    kept = keep_first(df, "k", ["s"], keep="first" if first else "last")
    got = sorted((tuple(r) for r in kept.collect()), key=repr)
    pick = min if first else max
    expected = [
        pick((row for row in data if row[0] == key), key=lambda row: (last(row[1]), row[2]))
        for key in {row[0] for row in data}
    ]
    assert got == sorted(expected, key=repr)


amounts = st.one_of(st.none(), st.sampled_from([-2.0, 0.0, 1.0, 2.0, 4.0, 8.0]))


@few
@given(st.lists(st.tuples(amounts, amounts, amounts), min_size=1, max_size=80))
def test_amounts(spark, data):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(data)], "i int, s double, q double, p double")
    got = [tuple(r) for r in df.orderBy("i").select(*reconcile_amounts("s", "q", "p")).collect()]

    def repair(s, q, p):
        total = None if q is None or p is None else q * abs(p)
        sales = total if s is None or s <= 0 or (total is not None and s != total) else s
        price = p if p is not None and p > 0 else None if s is None or not q else s / q
        return sales, price

    assert got == [repair(*row) for row in data]


numbers = st.one_of(
    st.none(),
    st.dates(dt.date(1000, 1, 1), dt.date(9999, 12, 31)).map(lambda d: d.year * 10000 + d.month * 100 + d.day),
    st.integers(-(10**10), 10**10),
    st.integers(20200100, 20200450),
)


@few
@given(st.lists(numbers, min_size=1, max_size=120))
def test_int_dates(spark, data):
    default = dt.datetime(2011, 1, 5)
    df = spark.createDataFrame([(i, n) for i, n in enumerate(data)], "i int, n bigint")
    rule = yyyymmdd_to_timestamp("n", "2011-01-05 00:00:00")
    got = [r[0] for r in df.orderBy("i").select(rule).collect()]

    def parse(number):
        if number is None or len(str(number)) != 8:
            return None if number is None else default
        try:
            return dt.datetime.strptime(str(number), "%Y%m%d")
        except ValueError:
            return None

    assert got == [parse(n) for n in data]


texts = st.one_of(st.none(), st.text(alphabet="aA sSmM\t-NAS0é", max_size=7))


@few
@given(st.lists(texts, min_size=1, max_size=80))
def test_texts(spark, data):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(data)], "i int, t string")
    rules = (
        standardize_codes("t", {"S": "Single", "M": "Married"}),
        standardize_codes("t", {"a": "Alpha"}, upper=False, passthrough=True),
        strip_prefix("t"),
    )
    got = [tuple(r) for r in df.orderBy("i").select(*rules).collect()]

    def clean(text):
        bare = None if text is None else text.strip(" ")
        return (
            {"S": "Single", "M": "Married"}.get((bare or "").upper(), "n/a"),
            {"a": "Alpha"}.get(bare, bare) or "n/a",
            text if text is None or len(text) <= 4 else text[3:],
        )

    assert got == [clean(t) for t in data]


ids = st.one_of(st.none(), st.integers(0, 4))


@few
@given(
    st.lists(st.tuples(ids, ids), max_size=40), st.lists(st.integers(0, 4), max_size=6), st.lists(ids, max_size=6)
)
def test_orphans(spark, fact, left, right):
    rows = spark.createDataFrame(fact, "a int, b int")
    lefts = spark.createDataFrame([(v,) for v in left], "x int")
    rights = spark.createDataFrame([(v,) for v in right], "y int")
    got = {tuple(r) for r in orphan_keys(rows, {"a": (lefts, "x"), "b": (rights, "y")}, strict=True).collect()}
    expected = set()
    for pair in set(fact):
        hits = [None if v is None else dim.count(v) for v, dim in zip(pair, (left, right))]
        if all(hits):
            continue
        expected.add((*pair, fact.count(pair) * math.prod(h or 1 for h in hits)))
    assert got == expected
