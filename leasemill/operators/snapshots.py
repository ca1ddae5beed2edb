"""Problem 3: what changed between full snapshots.

Rows become compact arrays: a 128-bit hash of the normal key and a 64-bit hash of the compared values. They are bucketed
by key hash; in each bucket numpy sorts them, keeps the latest delivery of every line, and takes the differences of
snapshots that follow each other with searchsorted. Only differing keys then fetch their full values, by a join on the
hashes. The table is read twice, and its day column once before.

Defined results: a line is (contract_id without surrounding white space and in upper case, line_number), a null in either
being a value like any other; of several deliveries the latest loaded_at holds, a null loaded_at being the earliest, and
among equal times the row with the larger value hash; amounts compare after rounding to two decimals, null equal to null
only, NaN to NaN only; rows without snapshot_date belong to no snapshot and are left out; one snapshot or an empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasemill.functions.exprs import strip
from leasemill.operators.bits import bit_words, bits_for, might_hold
from leasemill.session import persist_table, ship_package

#: Rows that one bucket should hold on average; a bucket's arrays take about 100 bytes a row while it is worked on.
ROWS_PER_BUCKET = 500_000
#: Rows that a task looks at together before the shuffle.
ROWS_THINNED = 500_000
KINDS = np.array(["added", "removed", "changed"])


def line_id(c: str = "contract_id") -> Column:
    return F.upper(strip(F.col(c)))


def _flagged(*columns: Column) -> list[Column]:
    """For hashing: xxhash64 passes over nulls, so each column is preceded by whether it is one."""
    return [x for c in columns for x in (c.isNull(), c)]


def keyed(df: DataFrame) -> DataFrame:
    """The rows of a snapshot with ``snap`` (its day as a number), the normal key, the compared values, the key's two
    hashes, the hash of the values, and the load time in microseconds."""
    key = _flagged(F.col("contract_id"), F.col("line_number"))
    values = _flagged(F.round(F.col("annual_amount"), 2) + F.lit(0.0), F.col("contract_end_date"))
    rows = df.filter(F.col("snapshot_date").isNotNull()).select(
        F.unix_date(F.col("snapshot_date").cast("date")).cast("bigint").alias("snap"),
        line_id().alias("contract_id"),
        "line_number",
        "annual_amount",
        "contract_end_date",
        F.coalesce(F.unix_micros(F.col("loaded_at").cast("timestamp")), F.lit(-(2**62))).alias("t"),
    )
    return rows.withColumns({"k1": F.xxhash64(*key), "k2": F.xxhash64(F.lit(17), *key), "v": F.xxhash64(*values)})


def _holders(snap, k1, k2, t, v) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the holding rows in the order of (key, snapshot), and the dense number of each one's key."""
    order = np.lexsort((v, t, snap, k2, k1))
    a, b, s = k1[order], k2[order], snap[order]
    new_key = np.ones(len(order), bool)
    new_key[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    last = np.ones(len(order), bool)
    last[:-1] = new_key[1:] | (s[1:] != s[:-1])
    return order[last], (np.cumsum(new_key) - 1)[last]


def _thin(batches):
    """Of the rows of one key and snapshot among ``ROWS_THINNED`` rows only the holding one goes on, so that a line delivered
    without end costs one row for each such portion."""
    held, n = [], 0

    def thinned():
        rows = pa.Table.from_batches(held).combine_chunks()
        arrays = [rows.column(c).to_numpy() for c in ("snap", "k1", "k2", "t", "v")]
        keep, _ = _holders(*arrays)
        return rows.take(pa.array(np.sort(keep))).to_batches()

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= ROWS_THINNED:
            yield from thinned()
            held, n = [], 0
    if n:
        yield from thinned()


def _difference(table: pa.Table, days: np.ndarray) -> pa.Table:
    """One bucket: the differing keys of snapshots that follow each other in ``days``, with the hash and time of their rows."""
    snap, k1, k2, v, t = (table.column(c).to_numpy() for c in ("snap", "k1", "k2", "v", "t"))
    rows, key = _holders(snap, k1, k2, t, v)
    order = np.argsort(snap[rows], kind="stable")
    rows, key = rows[order], key[order]
    bounds = np.append(np.searchsorted(snap[rows], days), len(rows))
    parts = []

    def lookup(sorted_keys, wanted):
        pos = np.searchsorted(sorted_keys, wanted)
        pos[pos == len(sorted_keys)] = 0
        found = np.zeros(len(wanted), bool) if not len(sorted_keys) else sorted_keys[pos] == wanted
        return found, pos

    for later in range(1, len(days)):
        old, new = slice(bounds[later - 1], bounds[later]), slice(bounds[later], bounds[later + 1])
        known, pos = lookup(key[old], key[new])
        still, _ = lookup(key[new], key[old])
        added, gone = rows[new][~known], rows[old][~still]
        now = rows[new][known]
        before = rows[old][pos[known]]
        differs = v[now] != v[before]
        for kind, own, prior in ((0, added, None), (1, gone, gone), (2, now[differs], before[differs])):
            n = len(own)
            if n:
                none = pa.nulls(n, pa.int64())
                parts.append(
                    pa.table(
                        {
                            "later": pa.array(np.full(n, days[later])),
                            "earlier": pa.array(np.full(n, days[later - 1])),
                            "kind": pa.array(np.full(n, kind, np.int32)),
                            "k1": pa.array(k1[own]),
                            "k2": pa.array(k2[own]),
                            "v_new": none if kind == 1 else pa.array(v[own]),
                            "t_new": none if kind == 1 else pa.array(t[own]),
                            "v_old": none if prior is None else pa.array(v[prior]),
                            "t_old": none if prior is None else pa.array(t[prior]),
                        }
                    )
                )
    return pa.concat_tables(parts) if parts else _EMPTY


_DIFF = ["later", "earlier", "kind", "k1", "k2", "v_new", "t_new", "v_old", "t_old"]
_EMPTY = pa.table({c: pa.array([], pa.int32() if c == "kind" else pa.int64()) for c in _DIFF})
_DIFF_SCHEMA = ", ".join(f"{c} {'int' if c == 'kind' else 'bigint'}" for c in _DIFF)


def snapshot_days(df: DataFrame) -> tuple[list[int], int]:
    """The days of the snapshots as numbers, in order, one for each delivery, and the number of rows. Reads one column."""
    day = F.unix_date(F.col("snapshot_date").cast("date")).cast("bigint")
    found = df.filter(F.col("snapshot_date").isNotNull()).groupBy(day.alias("snap")).agg(F.count("*").alias("n")).collect()
    return sorted(r.snap for r in found), sum(r.n for r in found)


def differing_keys(df: DataFrame, days: list[int], n_rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Differing keys by hash: the two days, kind, k1, k2 and the hash and time of the rows that hold."""
    spark = df.sparkSession
    ship_package(spark)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + n_rows // rows_per_bucket)
    rows = keyed(df).select(F.pmod(F.col("k1"), F.lit(buckets)).cast("int").alias("bucket"), "snap", "k1", "k2", "v", "t")
    known = np.array(days, np.int64)
    return rows.mapInArrow(_thin, rows.schema).groupBy("bucket").applyInArrow(lambda table: _difference(table, known), _DIFF_SCHEMA)


def candidates(df: DataFrame, wanted: DataFrame, n_keys: int, n_rows: int) -> DataFrame:
    """The rows that may belong to differing keys. Others are dropped before the shuffle, as far as a bit array sized by the
    number of keys can tell; where most lines differ, or too many for an array, all rows go on."""
    bits = bits_for(n_keys)
    rows = keyed(df)
    return rows if bits is None or 2 * n_keys > n_rows else might_hold(rows, bit_words(wanted, "k1", bits), "k1", bits)


def changes(df: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """snapshot_date (of the later one), contract_id, line_number, change_kind, and annual_amount and contract_end_date
    before and after. One row for each differing line and pair of snapshots that follow each other."""
    days, n_rows = snapshot_days(df)
    diff = persist_table(differing_keys(df, days, n_rows, rows_per_bucket), "differing")
    # A differing key asks for the row that held in each snapshot: one request for an added or removed line, two for a changed one.
    ask = [F.struct(F.lit(side).alias("side"), F.col(day).alias("snap"), F.col(f"v_{side}").alias("v"), F.col(f"t_{side}").alias("t")) for side, day in (("new", "later"), ("old", "earlier"))]
    wanted = diff.select("later", "kind", "k1", "k2", F.explode(F.array(*ask)).alias("x")).filter(F.col("x.v").isNotNull()).select("later", "kind", "k1", "k2", "x.*")
    full = candidates(df, wanted, diff.count(), n_rows)
    # Equal deliveries of a line become one before the shuffle; of amounts that round alike the largest counts, as below.
    same = ["k1", "k2", "snap", "v", "t"]
    full = full.groupBy(*same).agg(*[F.max(c).alias(c) for c in ("contract_id", "line_number", "annual_amount", "contract_end_date")])
    found = full.join(wanted, same)
    pick = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{side}_{c}")
    sides = [(s, c) for s in ("old", "new") for c in ("annual_amount", "contract_end_date")]
    kinds = F.array(*[F.lit(str(k)) for k in KINDS])
    return (
        found.groupBy("k1", "k2", "later", "kind")
        .agg(F.max("contract_id").alias("contract_id"), F.max("line_number").alias("line_number"), *[pick(s, c) for s, c in sides])
        .select(
            F.date_from_unix_date(F.col("later").cast("int")).alias("snapshot_date"),
            "contract_id",
            "line_number",
            F.element_at(kinds, F.col("kind") + 1).alias("change_kind"),
            *[f"{s}_{c}" for s, c in sides],
        )
    )
