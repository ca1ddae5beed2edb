"""Problem 7: every token in exactly one container, within capacity, by the stated rule."""

import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leasemill.llm import bpe, packing

if not os.path.exists(bpe.DEFAULT_FILE):
    pytest.skip("no vocabulary files here", allow_module_level=True)


def plain_assign(lengths, capacity):
    """The rule, with a look at every container for every length."""
    room = [capacity] * -(-sum(lengths) // capacity)
    cost = [0.0] * len(room)
    out = [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        fits = [c for c in range(len(room)) if room[c] >= n]
        if fits:
            c = min(fits, key=lambda c: (cost[c], c))
        else:
            c = len(room)
            room.append(capacity), cost.append(0.0)
        room[c] -= n
        cost[c] += packing.LINEAR * n + packing.QUADRATIC * n * n
        out[i] = c
    return out


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 60).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=60))))
def test_assign_is_the_rule(case):
    capacity, lengths = case
    got = packing.assign(np.array(lengths, np.int64), capacity).tolist()
    assert got == plain_assign(lengths, capacity)
    held = Counter()
    for c, n in zip(got, lengths):
        held[c] += n
    assert all(n <= capacity for n in held.values())


def test_little_room_is_left():
    random.seed(1)
    lengths = np.array([min(512, int(random.lognormvariate(4, 1)) + 1) for _ in range(20_000)])
    used = packing.assign(lengths, 512).max() + 1
    assert lengths.sum() / (used * 512) > 0.98


def test_time_grows_with_the_number():
    lengths = np.random.default_rng(1).integers(1, 500, 200_000)
    assert packing.assign(lengths, 512).max() > 0


@pytest.mark.parametrize("per_shard", [3, 1000])
def test_pack(spark, per_shard):
    random.seed(2)
    texts = [None, "", " ", "word " * 700, "word " * 512, "word " * 128, "one"] + ["tenant pays rent " * random.randint(1, 40) for _ in range(60)] + ["same text"] * 5
    docs = spark.createDataFrame([(i if i < 65 else 65, t, 1, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, n_tokens int, piece string").repartition(3)
    specs = spark.createDataFrame([(1, 128, "a"), (2, 512, "b"), (2, 512, "b")], "spec_id bigint, capacity_tokens bigint, shard string")
    rows = packing.pack(docs, specs, per_shard=per_shard).collect()
    tok = bpe.ByteBPE(bpe.read_file())
    sizes = Counter()
    for i, t in enumerate(texts):
        sizes[(min(i, 65), len(tok.encode(t)))] += 1
    for spec, capacity in ((1, 128), (2, 512)):
        mine = [r for r in rows if r.spec_id == spec]
        held, parts = Counter(), defaultdict(list)
        for r in mine:
            if r.n_tokens == 0:
                assert r.container_id is None
            else:
                held[r.container_id] += r.n_tokens
            parts[r.doc_id, r.copy_at if r.doc_id == 65 else 0, r.n_tokens if r.doc_id == 65 else 0].append(r)
        assert max(held.values()) <= capacity
        total = Counter()
        for (doc, *_), rs in parts.items():
            rs = sorted(rs, key=lambda r: r.piece or 0)
            if doc == 65:
                total[65, rs[0].n_tokens] += len(rs)
                continue
            total[doc, sum(r.n_tokens for r in rs)] += 1
            if len(rs) > 1:  # only a text above the capacity is split
                assert sum(r.n_tokens for r in rs) > capacity
                assert [r.n_tokens for r in rs[:-1]] == [capacity] * (len(rs) - 1)
                assert [r.first_token for r in rs] == [capacity * i for i in range(len(rs))]
        assert total == sizes
    numbers = {(r.spec_id, r.copy_at) for r in rows}
    assert len(numbers) == 2 * len(texts)  # repeated rows are told apart, wherever they stand
    for r in packing.checks(packing.pack(docs, specs, per_shard=per_shard)).collect():
        assert (r.n_texts, r.n_empty, r.n_overfull, r.n_split_needlessly, r.n_with_gaps) == (len(texts), 2, 0, 0, 0)
    report = {r.spec_id: r for r in packing.fill_report(packing.pack(docs, specs, per_shard=per_shard)).collect()}
    assert report[1].tokens == report[2].tokens == sum(k[1] * n for k, n in sizes.items()) and report[2].fewest <= report[2].containers


def test_empty_and_refused(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    specs = spark.createDataFrame([(1, 8)], "spec_id bigint, capacity_tokens bigint")
    assert packing.pack(none, specs).count() == 0
    assert packing.pack(spark.createDataFrame([(1, "a")], none.schema), specs.filter("false")).count() == 0
    with pytest.raises(ValueError):
        packing.read_specs(spark.createDataFrame([(1, 0)], specs.schema))
    with pytest.raises(ValueError):
        packing.read_specs(spark.range(packing.MOST_SPECS + 5).selectExpr("id AS spec_id", "id + 1 AS capacity_tokens"))


def test_repeated_rows_spread(spark):
    docs = spark.createDataFrame([(7, "the same text")] * 600, "doc_id bigint, text string")
    specs = spark.createDataFrame([(1, 64)], "spec_id bigint, capacity_tokens bigint")
    rows = packing.pack(docs, specs, per_shard=100).collect()
    shards = Counter(r.container_id >> packing.SHARD_BITS for r in rows)
    assert len(rows) == 600 and len(shards) == 7 and max(shards.values()) < 200
