"""Problem 7: texts into containers of fixed token capacity.

The cost of a container is what attending to its texts costs: for each text a linear part and a part that grows with the
square of its length. Texts go in descending order of length, each into the container of lowest cost that still has room
for it; as many containers as the tokens need at least are open from the start, further ones are opened when nothing fits.
Filling the cheapest first keeps the containers' costs alike; the short texts at the end fill what is left.

A table is packed in shards of about ``PER_SHARD`` texts, chosen by hash, so the last containers of a shard are the only
ones that sharding may leave unfilled. Only ids and lengths are shuffled; a shard's state is bounded by its size.

Defined results: a text above the capacity, and no other, is split: into full containers of its own and a remainder that is
packed like a text. Null and empty texts have no tokens and stand in no container (``container_id`` null). Repeated rows
are texts of their own: ``copy_at`` is a number that no other row of the table has. The numbers of rows and containers
depend on how the input is split into tasks; which lengths stand together depends on the shards only. Containers are numbered within a capacity and shard, and
``container_id`` is unique in a capacity.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasemill.llm.encode import token_counts
from leasemill.session import persist_table, ship_package

#: Texts in a shard, on average.
PER_SHARD = 50_000
#: Cost of a token, and of a pair of tokens of one text: attention over d_model = 1024 against the rest of a layer.
LINEAR, QUADRATIC = 1.0, 1.0 / (6 * 1024)
#: A shard's containers are numbered from shard * 2**32.
SHARD_BITS = 32
#: More capacities than this are no list of container sizes.
MOST_SPECS = 1000


def assign(lengths: np.ndarray, capacity: int, linear: float = LINEAR, quadratic: float = QUADRATIC) -> np.ndarray:
    """The container of each length (all from 1 to the capacity). O(n log n): containers without room for the present
    length wait until the lengths, which only fall, have come down to their room."""
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order].tolist()
    start = -(-int(lengths.sum()) // capacity)
    room = [capacity] * start
    open_heap = [(0.0, c) for c in range(start)]  # by cost
    waiting: list[tuple[int, int, float]] = []  # by room, largest first
    out = np.empty(len(sizes), np.int64)
    push, pop = heapq.heappush, heapq.heappop
    for i, n in enumerate(sizes):
        while waiting and -waiting[0][0] >= n:
            _, c, cost = pop(waiting)
            push(open_heap, (cost, c))
        while True:
            if not open_heap:
                cost, c = 0.0, len(room)
                room.append(capacity)
                break
            cost, c = pop(open_heap)
            if room[c] >= n:
                break
            if room[c]:
                push(waiting, (-room[c], c, cost))
        room[c] -= n
        out[i] = c
        if room[c]:
            push(open_heap, (cost + linear * n + quadratic * n * n, c))
    placed = np.empty(len(sizes), np.int64)
    placed[order] = out
    return placed


def _pack(table: pa.Table) -> pa.Table:
    """One shard and capacity: every text or remainder, and the full parts of texts above the capacity, with containers."""
    capacity, shard = table.column("capacity_tokens")[0].as_py(), table.column("shard")[0].as_py()
    n = table.column("n_tokens").to_numpy()
    full, rest = n // capacity, n % capacity
    whole = n <= capacity
    full[whole], rest[whole] = 0, n[whole]
    order = np.lexsort((table.column("_at").to_numpy(), table.column("doc_id").fill_null(-1).to_numpy(), -rest))
    items = order[rest[order] > 0]
    placed = assign(rest[items], capacity)
    used = int(placed.max()) + 1 if len(placed) else 0
    rows = np.concatenate([np.repeat(np.arange(len(n)), full), items])
    ordinal = np.arange(int(full.sum())) - np.repeat(np.cumsum(full) - full, full)
    piece = np.concatenate([ordinal, full[items]])
    container = np.concatenate([used + np.arange(int(full.sum())), placed]) + (shard << SHARD_BITS)
    size = np.concatenate([np.full(int(full.sum()), capacity), rest[items]])
    taken = table.take(pa.array(rows))
    return pa.table(
        {
            "spec_id": taken.column("spec_id"),
            "capacity_tokens": taken.column("capacity_tokens"),
            "container_id": pa.array(container, pa.int64()),
            "doc_id": taken.column("doc_id"),
            "copy_at": taken.column("_at"),
            "piece": pa.array(piece, pa.int64()),
            "first_token": pa.array(piece * capacity, pa.int64()),
            "n_tokens": pa.array(size, pa.int64()),
        }
    )


SCHEMA = "spec_id bigint, capacity_tokens bigint, container_id bigint, doc_id bigint, copy_at bigint, piece bigint, first_token bigint, n_tokens bigint"


def read_specs(specs: DataFrame) -> list[tuple[int, int]]:
    """(spec_id, capacity_tokens) of every container size; a bounded list, checked."""
    rows = specs.select("spec_id", "capacity_tokens").distinct().limit(MOST_SPECS + 1).collect()
    if len(rows) > MOST_SPECS:
        raise ValueError(f"more than {MOST_SPECS} container sizes")
    if any(r.capacity_tokens is None or r.capacity_tokens < 1 for r in rows):
        raise ValueError("a capacity must be 1 token or more")
    return sorted((r.spec_id, r.capacity_tokens) for r in rows)


def pack(documents: DataFrame, specs: DataFrame, path: str | None = None, per_shard: int = PER_SHARD) -> DataFrame:
    """spec_id, capacity_tokens, container_id, doc_id, copy_at, piece, first_token, n_tokens: one row for each part of a
    text in a container of each capacity."""
    ship_package(documents.sparkSession)
    sizes = read_specs(specs)
    counts = persist_table(token_counts(documents, ["doc_id"], path=path), "tokens")
    shards = 1 + counts.count() // per_shard
    # The place in the input is part of the hash, so that equal rows spread over the shards.
    lengths = counts.withColumn("shard", F.pmod(F.xxhash64("doc_id", "n_tokens", "_at"), F.lit(shards)))
    if not sizes:
        return documents.sparkSession.createDataFrame([], SCHEMA)
    every = F.explode(F.array(*[F.struct(F.lit(i).cast("bigint").alias("spec_id"), F.lit(c).cast("bigint").alias("capacity_tokens")) for i, c in sizes]))
    rows = lengths.select("*", every.alias("x")).select("x.*", "shard", "doc_id", "n_tokens", "_at")
    packed = rows.filter(F.col("n_tokens") > 0).groupBy("spec_id", "shard").applyInArrow(_pack, SCHEMA)
    none = F.lit(None).cast("bigint")
    empty = rows.filter(F.col("n_tokens") == 0).select("spec_id", "capacity_tokens", none.alias("container_id"), "doc_id", F.col("_at").alias("copy_at"), none.alias("piece"), none.alias("first_token"), "n_tokens")
    return packed.unionByName(empty)


def fill_report(packed: DataFrame) -> DataFrame:
    """By capacity: containers, tokens, the fewest containers that could hold them, and the share of room that is filled."""
    held = packed.filter(F.col("container_id").isNotNull()).groupBy("spec_id", "capacity_tokens", "container_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("parts"))
    return held.groupBy("spec_id", "capacity_tokens").agg(
        F.count("*").alias("containers"),
        F.sum("n").alias("tokens"),
        F.max("n").alias("fullest"),
        F.sum("parts").alias("parts"),
        F.ceil(F.sum("n") / F.first("capacity_tokens")).alias("fewest"),
        (F.sum("n") / (F.count("*") * F.first("capacity_tokens"))).alias("fill"),
    )


def checks(packed: DataFrame) -> DataFrame:
    """By capacity: ``n_texts`` and those without tokens, ``n_empty``; and what must be 0: containers above the capacity, texts
    that are split though they fit, and texts whose parts do not follow on each other without a gap."""
    texts = packed.groupBy("spec_id", "capacity_tokens", "copy_at").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("parts"), F.max("piece").alias("last"), F.max(F.col("first_token") + F.col("n_tokens")).alias("end"), F.count("container_id").alias("placed"))
    gap = (F.col("placed") > 0) & ((F.col("last") + 1 != F.col("parts")) | (F.col("end") != F.col("n")))
    by_text = texts.groupBy("spec_id", "capacity_tokens").agg(F.count("*").alias("n_texts"), F.count_if(F.col("placed") == 0).alias("n_empty"), F.count_if((F.col("parts") > 1) & (F.col("n") <= F.col("capacity_tokens"))).alias("n_split_needlessly"), F.count_if(gap).alias("n_with_gaps"))
    held = packed.filter(F.col("container_id").isNotNull()).groupBy("spec_id", "capacity_tokens", "container_id").agg(F.sum("n_tokens").alias("n"))
    by_container = held.groupBy("spec_id").agg(F.count_if(F.col("n") > F.col("capacity_tokens")).alias("n_overfull"))
    return by_text.join(by_container, "spec_id", "left").withColumn("n_overfull", F.coalesce("n_overfull", F.lit(0)))
