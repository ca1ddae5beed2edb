"""A join of many rows to facts about their keys that does not send a hot key to one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tables of fewer rows have no key that is too much for one task.
LEAST_ROWS = 500_000
#: A key that holds this share of all rows, and at least ``LEAST_HOT`` of them, is hot. There are at most ``1 / HOT_SHARE`` such keys.
HOT_SHARE, LEAST_HOT = 1e-4, 100_000


def hot_limit(total: int) -> int:
    return max(LEAST_HOT, int(total * HOT_SHARE))


def join_facts(rows: DataFrame, facts: DataFrame, on: list[str], weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` to ``facts``, whose keys ``on`` are unique; null keys meet null keys.

    ``weight``: a column of the facts, the rows that hold the key (or an upper bound); ``total``: the rows of the table. The
    facts of hot keys, at most ``1 / HOT_SHARE`` by the weights' definition, are broadcast; all others are left to the
    planner. Both sides are read twice then and should be stored tables.
    """
    facts = facts.withColumnsRenamed({c: f"_f_{c}" for c in on})
    same: Column = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_f_{c}")) for c in on])
    extra = [f"_f_{c}" for c in on]
    if total < LEAST_ROWS:
        return rows.join(facts, same).drop(*extra)
    is_hot = F.coalesce(F.col(weight), F.lit(0)) >= hot_limit(total)
    hot, rest = facts.filter(is_hot), facts.filter(~is_hot)
    there = rows.join(F.broadcast(hot), same)
    others = rows.join(F.broadcast(hot.select(*extra)), same, "left_anti").join(rest, same)
    return there.unionByName(others).drop(*extra)
