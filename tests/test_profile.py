"""Problem 1: value-count tables, signed deltas, figures and departures against brute force."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from leasemill.operators import profile as P

RULES = [P.ColumnRule("amount", 10, 100), P.ColumnRule("usage", labels=("A", "B"))]
SCHEMA = "load bigint, amount double, usage string, n bigint, num string, column_name int"


def frame(spark, rows):
    # The last three columns only clash in name.
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


ROWS = [(1, 50.0, "A"), (1, 50.0, "A"), (1, None, None), (1, float("nan"), "C"), (1, 500.0, "A"), (2, 20.0, "B"), (2, 20.0, None), (None, -0.0, "A"), (None, 0.0, "a")]


def profiles(state):
    return {(r.grp, r.column_name): r for r in P.profile(state, RULES).collect()}


def test_profile(spark):
    state = P.delta(frame(spark, ROWS), RULES, "load")
    p = profiles(state)
    a = p[1, "amount"]
    assert (a.n_rows, a.n_null, a.n_distinct, a.n_bad, a.top_n, a.top_num, a.min_num, a.max_num) == (5, 2, 2, 1, 2, 50, 50, 500)
    assert a.null_rate == 0.4 and a.bad_share == pytest.approx(1 / 3) and a.top_share == pytest.approx(2 / 3)
    u = p[1, "usage"]
    assert (u.n_null, u.n_bad, u.top_txt) == (1, 1, "A")
    assert u.entropy == pytest.approx(-(0.75 * math.log2(0.75) + 0.25 * math.log2(0.25)))
    z = p[None, "amount"]
    assert z.n_distinct == 1 and z.n_bad == 2  # both zeros are one value


def test_ties_take_the_smallest(spark):
    p = profiles(P.delta(frame(spark, [(1, 3.0, "B"), (1, 2.0, "A")]), RULES, "load"))
    assert p[1, "amount"].top_num == 2 and p[1, "usage"].top_txt == "A"


def test_group_without_values(spark):
    p = profiles(P.delta(frame(spark, [(1, None, None)]), RULES, "load"))
    r = p[1, "amount"]
    assert r.null_rate == 1 and r.bad_share is None and r.top_share is None and r.entropy is None and r.n_distinct == 0


def test_empty(spark):
    state = P.delta(frame(spark, []), RULES, "load")
    assert P.profile(state, RULES).count() == 0 and P.departures(state, RULES).count() == 0
    assert P.distribution_change(state).count() == 0


def rows_of(df):
    return {tuple(r) for r in df.collect()}


def test_signed_deltas(spark):
    df = frame(spark, ROWS)
    store = P.CountStore(spark)
    assert store.read().count() == 0
    store.apply(P.delta(df, RULES, "load"))
    store.apply(P.delta(frame(spark, [(3, 1.0, "A")]), RULES, "load"), P.delta(df.filter("load = 1"), RULES, "load", sign=-1))
    wanted = P.delta(df.filter("load = 2 OR load IS NULL").unionByName(frame(spark, [(3, 1.0, "A")])), RULES, "load")
    assert rows_of(store.read()) == rows_of(wanted) and store.version == 2
    under = P.merge(P.delta(frame(spark, [(9, 5.0, "A")]), RULES, "load", sign=-1))
    assert {r.n for r in under.collect()} == {-1}


def test_batches_survive_and_replays_count_once(spark):
    from leasemill.session import shared_path

    path = shared_path(spark, "store")
    store = P.CountStore(spark, path)
    one, two = (P.delta(frame(spark, [(g, 1.0, "A")]), RULES, "load") for g in (1, 2))
    store.apply(one, batch=0)
    store.apply(two, batch=1)
    again = P.CountStore(spark, path)
    assert again.version == 2 and {r.grp for r in again.read().collect()} == {1, 2}
    again.apply(two, batch=1)
    assert {r.n for r in again.read().collect()} == {1} and P.CountStore(spark, path).version == 2


def test_refresh_takes_new_changed_and_vanished_loads(spark, tmp_path):
    from leasemill.session import shared_path

    path = shared_path(spark, "store")
    loads = lambda *rows: frame(spark, list(rows))
    a, b, n = (1, 5.0, "A"), (2, 6.0, "B"), (None, None, None)
    for rows in ([], [a, a], [a, a, b, n], [a, a, b, n], [a, (1, 7.0, "A"), b], [b, n], [n]):
        store = P.CountStore(spark, path)
        version, state = store.version, store.refresh(loads(*rows), RULES, "load")
        assert rows_of(state) == rows_of(P.delta(loads(*rows), RULES, "load")), rows
        assert len(store.list["parts"]) <= 3
    assert P.CountStore(spark, path).version == store.version == version + 1
    with pytest.raises(ValueError, match="counts"):
        P.CountStore(spark, path).refresh(loads(a), RULES[:1], "load")


def test_two_runs_on_one_store(spark):
    from leasemill.session import shared_path

    path = shared_path(spark, "store")
    one, two = P.CountStore(spark, path), P.CountStore(spark, path)
    first, both = frame(spark, [(1, 5.0, "A")]), frame(spark, [(1, 5.0, "A"), (2, 6.0, "B")])
    one.refresh(first, RULES, "load")
    assert rows_of(two.refresh(both, RULES, "load")) == rows_of(P.delta(both, RULES, "load")) and two.version == 2


def test_a_small_load_is_not_paid_with_the_whole_state(spark, tmp_path):
    import os

    path = (tmp_path / "store").as_uri()
    big = [(1, float(i), "A") for i in range(400)]
    for i, rows in enumerate([big, *[[(g, 1.0, "A")] for g in range(2, 8)]]):
        store = P.CountStore(spark, path)
        store.apply(P.delta(frame(spark, rows), RULES, "load"))
        first = first if i else store.list["parts"][0]["name"]  # noqa: F821
        assert store.list["parts"][0]["name"] == first and len(store.list["parts"]) <= 5
    assert sum(r.n for r in store.read().collect()) == 2 * 406
    left = {x for x in os.listdir(tmp_path / "store") if x.startswith(("part", "list"))}
    assert len([x for x in left if x.startswith("list")]) == 2 and len(left) <= 12
    # A list that was not written whole is not seen.
    (tmp_path / "store" / "list-000000099.json").write_text('{"version": 99')
    assert P.CountStore(spark, path).version == store.version


def test_total_equals_ungrouped(spark):
    df = frame(spark, ROWS)
    a = {(r.column_name, r.num, r.txt): r.n for r in P.total(P.delta(df, RULES, "load")).collect()}
    b = {(r.column_name, r.num, r.txt): r.n for r in P.delta(df, RULES, F.lit(0)).collect()}
    assert a == b


def test_shift(spark):
    rows = [(1, 1.0, "A")] * 3 + [(2, 2.0, "A")] + [(4, 2.0, "A"), (4, 3.0, None)]
    s = {(r.grp, r.column_name): (r["shift"], r.shift_whole) for r in P.distribution_change(P.delta(frame(spark, rows), RULES, "load")).collect()}
    assert s[1, "amount"] == (None, pytest.approx(0.5)) and s[2, "amount"] == (1, pytest.approx(2 / 3)) and s[4, "amount"][0] == pytest.approx(0.5)
    assert s[1, "usage"] == (None, 0) and s[4, "usage"] == (0, 0)


def test_departures(spark):
    usual = [(50.0 + i, "AB"[i % 2]) for i in range(20)]
    rows = [(g, *x) for g in range(5) for x in usual]
    rows += [(5, None if i < 4 else a, u) for i, (a, u) in enumerate(usual)]  # nulls
    rows += [(6, a * 2, u) for a, u in usual]  # another level, and out of range
    rows += [(7, 50.0 if i < 9 else a, u) for i, (a, u) in enumerate(usual)]  # one value too often
    rows += [(8, a, "A?" if i % 2 else "B") for i, (a, u) in enumerate(usual)]  # misspelt
    got = {tuple(r) for r in P.departures(P.delta(frame(spark, rows), RULES, "load"), RULES).collect()}
    assert got == {(5, "amount", "null_rate"), (6, "amount", "level"), (6, "amount", "range"), (7, "amount", "top_share"), (8, "usage", "pattern"), (8, "usage", "mix")}


def test_hot_value_is_one_row(spark):
    state = P.delta(frame(spark, [(1, 5.0, "A")] * 3000), RULES, "load")
    assert Counter(r.column_name for r in state.collect()) == {"amount": 1, "usage": 1}
