"""Problem 3 against a dictionary diff."""

import random
from datetime import date, datetime, timedelta

import pytest

from leasemill.operators import snapshots as S

SCHEMA = "snapshot_date date, contract_id string, line_number bigint, annual_amount double, contract_end_date date, loaded_at timestamp_ntz, k1 string, kind string, bucket int"
D = date


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], SCHEMA)


def brute(rows):
    held = {}
    for snap, cid, line, amount, end, at in rows:
        if snap is None:
            continue
        key = (None if cid is None else cid.strip().upper(), line)
        old = held.setdefault(snap, {}).get(key)
        if old is None or (at or datetime.min) >= old[0]:
            held[snap][key] = (at or datetime.min, None if amount is None else round(amount, 2), end)
    days = sorted(held)
    out = set()
    for before, now in zip(days, days[1:]):
        a, b = held[before], held[now]
        out |= {(now, *k, "added") for k in b.keys() - a.keys()} | {(now, *k, "removed") for k in a.keys() - b.keys()}
        out |= {(now, *k, "changed") for k in a.keys() & b.keys() if a[k][1:] != b[k][1:]}
    return out


def got(df, **kw):
    rows = [(r.snapshot_date, r.contract_id, r.line_number, r.change_kind) for r in S.changes(df, **kw).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("per_bucket", [10, 1_000_000])
def test_against_brute_force(spark, per_bucket):
    random.seed(3)
    days = [D(2025, 1, 31), D(2025, 2, 28), D(2025, 5, 31), None]
    rows = []
    for i in range(1500):
        cid = random.choice([None, *(f"C{n}" for n in range(60))])
        cid = cid and random.choice([cid, cid.lower(), f"  {cid}\t"])
        amount = random.choice([None, 100.0, 100.0 + 1e-7, 200.25, -0.0, 0.0])
        rows.append((random.choice(days), cid, random.choice([None, 1, 2]), amount, random.choice([None, D(2026, 1, 1)]), datetime(2025, 1, 1) + timedelta(seconds=i)))
    assert got(frame(spark, rows), rows_per_bucket=per_bucket) == brute(rows)


def test_values_and_repeats(spark):
    t = datetime(2025, 1, 1)
    rows = [
        (D(2025, 1, 1), "a", 1, 10.0, None, t),
        (D(2025, 1, 1), "A ", 1, 11.0, None, t + timedelta(1)),  # holds
        (D(2025, 2, 1), "A", 1, 12.0, D(2025, 3, 3), t),
        (D(2025, 2, 1), "A", 1, 12.0, D(2025, 3, 3), t),  # delivered twice
        (D(2025, 2, 1), "B", 1, None, None, None),
    ]
    out = {r.contract_id: r for r in S.changes(frame(spark, rows)).collect()}
    assert out["A"].change_kind == "changed" and (out["A"].old_annual_amount, out["A"].new_annual_amount) == (11, 12)
    assert out["A"].new_contract_end_date == D(2025, 3, 3) and out["B"].change_kind == "added" and out["B"].old_annual_amount is None


def test_hot_line(spark):
    t = datetime(2025, 1, 1)
    rows = [(D(2025, 1 + i % 2, 1), "H", 1, float(i % 2), None, t + timedelta(seconds=i)) for i in range(4000)] + [(D(2025, 1, 1), "Z", 1, 1.0, None, t)]
    assert got(frame(spark, rows)) == {(D(2025, 2, 1), "H", 1, "changed"), (D(2025, 2, 1), "Z", 1, "removed")}


def test_thinning(spark, monkeypatch):
    import pyarrow as pa

    c = S.keyed(frame(spark, [(D(2025, 1, 1), f"L{i % 3}", 1, float(i), None, datetime(2025, 1, 1) + timedelta(seconds=i)) for i in range(90)]))
    table = c.selectExpr("0 AS bucket", "snap", "k1", "k2", "v", "t").coalesce(1).toArrow()
    monkeypatch.setattr(S, "ROWS_THINNED", 50)
    out = pa.Table.from_batches(list(S._thin(table.to_batches(max_chunksize=10))))
    assert out.num_rows == 6 and max(out.column("t").to_pylist()) == max(table.column("t").to_pylist())
    assert list(S._thin([])) == []


def shuffled(spark):
    """Records that all stages so far have written to the shuffle."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    gateway = sc._gateway
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_equal_deliveries_of_a_differing_line_are_not_shuffled(spark):
    t = datetime(2025, 1, 1)
    rows = [(D(2025, 1 + i % 2, 1), "H", 1, 1.0 + i % 2 + i % 3 * 1e-4, None, t) for i in range(6000)] + [(D(2025, 1, 1), "Z", 1, 1.0, None, t)]
    df, before = frame(spark, rows), shuffled(spark)
    settings = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for x in settings:
        spark.conf.set(x, "-1")  # as if too many lines differed for a broadcast
    try:
        out = {r.contract_id: r for r in S.changes(df).collect()}
    finally:
        for x in settings:
            spark.conf.unset(x)
    assert shuffled(spark) - before < 1000
    assert (out["H"].old_annual_amount, out["H"].new_annual_amount) == (1.0002, 2.0002) and out["Z"].change_kind == "removed"


def test_few_snapshots(spark):
    t = datetime(2025, 1, 1)
    assert got(frame(spark, [])) == set()
    one = S.changes(frame(spark, [(D(2025, 1, 1), "A", 1, 1.0, None, t)]))
    assert one.count() == 0 and "new_annual_amount" in one.columns


def test_columns_of_both_forms_agree(spark):
    t = datetime(2025, 1, 1)
    two = frame(spark, [(D(2025, 1, 1), "A", 1, 1.0, None, t), (D(2025, 2, 1), "A", 1, 1.0, None, t)])
    assert S.changes(two).columns == S.changes(two.filter("snapshot_date < '2025-02-01'")).columns and S.changes(two).count() == 0


def test_bits(spark):
    from leasemill.operators.bits import MOST_BITS, bit_words, bits_for, might_hold

    assert bits_for(0) == bits_for(4096) == 1 << 16 and bits_for(4097) == 1 << 17 and bits_for(MOST_BITS // 2) == MOST_BITS
    assert bits_for(MOST_BITS // 2 + 1) is None

    keys = spark.range(200).selectExpr("xxhash64(id) AS k").unionByName(spark.createDataFrame([(None,), (-1,), (2**63 - 1,)], "k bigint"))
    every = spark.range(2000).selectExpr("xxhash64(id) AS k", "id")
    for bits in (64, 1024, 1 << 20):
        words = bit_words(keys, "k", bits)
        assert words.count() <= bits / 64
        passed = {r.id for r in might_hold(every, words, "k", bits).collect()}
        assert set(range(200)) <= passed
    assert len(passed) < 220
    assert might_hold(keys, bit_words(keys, "k", 1 << 20), "k", 1 << 20).count() == 202


@pytest.mark.parametrize("most", [True, False])
def test_most_lines_differ_or_too_many(spark, monkeypatch, most):
    t = datetime(2025, 1, 1)
    rows = [(D(2025, m, 1), f"L{i}", 1, float(m * (i % 4 == 0 or most)), None, t) for m in (1, 2, 3) for i in range(400)]
    if not most:
        monkeypatch.setattr(S, "bits_for", lambda n: None)
    assert got(frame(spark, rows)) == brute(rows)
