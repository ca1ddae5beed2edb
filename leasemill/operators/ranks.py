"""Figures and exact order statistics of groups without holding or sorting a whole group in one task, in two passes.

The first pass counts the values of each group in logarithmic buckets, and sums them there: a table whose size is bounded by
the type of the values and the number of groups, combined before the shuffle and written to the shared folder. Counts, means,
deviations, extremes, and the bucket that holds a rank all come from it. The second pass takes only the values of the
buckets so found (a relative width of 2 * ``COARSE``), counts equal ones, cuts the bucket into ``SLICES`` of equal width, and
puts in order those of one slice. So about one row in a hundred is shuffled, and no task orders more than a slice.

Null and NaN take no part; infinite values stand at the ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasemill.functions.buckets import INFINITE, bucket_text, gamma, sign_text
from leasemill.operators.joins import join_facts
from leasemill.session import persist_table, small_or_stored

#: Relative accuracy of the first step's buckets, and the parts of one bucket in the second; buckets of fewer rows are not cut.
COARSE, SLICES, ROWS_ORDERED = 0.005, 4096, 1_000_000

#: The ranks of the middle two of ``total`` values, as SQL.
MIDDLE = {"lo": "floor((total - 1) / 2)", "hi": "ceil((total - 1) / 2)"}


def _list(*names: str) -> str:
    return ", ".join(f"`{n}`" for n in names)


def _same(left: str, right: str, names: list[str]) -> str:
    return " AND ".join(f"{left}.`{n}` <=> {right}.`{n}`" for n in names)


def _bucketed(df: DataFrame) -> DataFrame:
    return df.filter("v IS NOT NULL AND NOT isnan(v)").selectExpr("*", f"{sign_text('v')} AS _s", f"{bucket_text('v', COARSE)} AS _b")


def _tagged(df: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """One row for each value that is a number: the keys, _tag, v, n, _s, _b."""
    named = df.select(*keys, *[v.alias(f"_v{i}") for i, v in enumerate(values.values())])
    cells = ", ".join(f"struct('{name}' AS _tag, CAST(_v{i} AS DOUBLE) AS v)" for i, name in enumerate(values))
    return _bucketed(named.selectExpr(*[f"`{k}`" for k in keys], f"inline(array({cells}))").selectExpr("*", "1L AS n"))


def _located(counts: DataFrame, keys: list[str], ranks: dict[str, str]) -> DataFrame:
    """The buckets that hold the asked ranks: keys, _s, _b, ``below`` (rows in lower buckets), ``weight`` (rows in it),
    ``rank_tag``, ``rank``.

    ``counts``: keys, _s, _b, n. ``ranks``: tag -> SQL of the rank from ``total``, the rows of a group.
    """
    by_key, lead = _list(*keys) or "0", "".join(f"`{k}`, " for k in keys)
    asked = ", ".join(f"struct('{t}' AS tag, CAST({r} AS BIGINT) AS rank)" for t, r in ranks.items())
    return counts.sparkSession.sql(
        f"""SELECT {lead}_s, _b, below, weight, r.tag AS rank_tag, r.rank AS rank FROM (
          SELECT *, explode(array({asked})) AS r FROM (
            SELECT *, sum(weight) OVER (PARTITION BY {by_key} ORDER BY _s, _b * _s ROWS UNBOUNDED PRECEDING) - weight AS below, sum(weight) OVER (PARTITION BY {by_key}) AS total
            FROM (SELECT {lead}_s, _b, sum(n) AS weight FROM {{counts}} GROUP BY {lead}_s, _b)))
        WHERE r.rank >= below AND r.rank < below + weight""",
        counts=counts,
    )


def _slice() -> str:
    """The part of its bucket in which v lies, rising with v, as SQL."""
    g = f"{gamma(COARSE)!r}D"
    part = f"coalesce(least(greatest(floor(try_divide(abs(v) - pow({g}, _b - 1), pow({g}, _b) - pow({g}, _b - 1)) * {SLICES}), 0), {SLICES - 1}), 0)"
    return f"CAST(CASE WHEN _s = 0 OR _b >= {INFINITE} THEN 0 ELSE {part} * _s END AS INT)"


def within(found: DataFrame, keys: list[str], heaviest: int | None = None) -> DataFrame:
    """keys, rank_tag, v from the rows of the located buckets: keys, rank_tag, rank, below, _s, _b, v, n.

    ``heaviest``: the rows of the largest bucket, if known; buckets that one task orders easily are not cut into slices.
    """
    group = _list(*keys, "rank_tag")
    values, start = found.groupBy(*keys, "rank_tag", "rank", "below", "_s", "_b", "v").agg(F.expr("sum(n) AS n")), "below"
    if heaviest is None or heaviest > ROWS_ORDERED:
        chosen = """SELECT *, upto - k AS start FROM (SELECT *, below + sum(k) OVER (PARTITION BY {group} ORDER BY slice ROWS UNBOUNDED PRECEDING) AS upto
          FROM (SELECT {group}, rank, below, slice, sum(n) AS k FROM {values} GROUP BY {group}, rank, below, slice)) WHERE upto > rank AND upto - k <= rank"""
        values = values.selectExpr("*", f"{_slice()} AS slice")
        chosen = found.sparkSession.sql(chosen.replace("{group}", group), values=values)
        on = _same("a", "b", [*keys, "rank_tag", "slice"])
        values, start = found.sparkSession.sql(f"SELECT a.*, b.start FROM {{values}} a JOIN {{chosen}} b ON {on}", values=values, chosen=chosen), "start"
    upto = f"{start} + sum(n) OVER (PARTITION BY {group} ORDER BY v ROWS UNBOUNDED PRECEDING) AS _upto"
    return values.selectExpr("*", upto).filter("_upto > rank AND _upto - n <= rank").select(*keys, "rank_tag", "v")


def _pick(rows: DataFrame, counts: DataFrame, keys: list[str], ranks: dict[str, str]) -> DataFrame:
    """keys, ``rank_tag``, ``v``: the values at given ranks of each group. ``rows``: keys, v, n, _s, _b; ``counts``: keys, n,
    _s, _b. The located buckets, a row or two for each group, are computed first; few are broadcast, many are stored and
    joined with hot ones apart. Empty groups give no rows."""
    located, held = small_or_stored(_located(counts, keys, ranks), "ranks")
    on = [*keys, "_s", "_b"]
    if held is None:
        return within(join_facts(rows, located, on, "weight", counts.agg(F.sum("n")).first()[0]), keys)
    # at most MOST_LOCAL_ROWS rows are broadcast
    near = rows.sparkSession.sql(f"SELECT /*+ BROADCAST(b) */ a.*, b.below, b.rank_tag, b.rank FROM {{rows}} a JOIN {{located}} b ON {_same('a', 'b', on)}", rows=rows, located=located)
    return within(near, keys, max(held.column("weight").to_pylist(), default=0))


def exact_medians(counts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, ``median``, from a stored table of values and their counts (keys, v, n): the mean of the middle two."""
    rows = _bucketed(counts)
    return _pick(rows, rows, keys, MIDDLE).groupBy(*keys).agg(F.expr("avg(v) AS median"))


def group_figures(df: DataFrame, keys: list[str], values: dict[str, Column], overall: bool = False) -> DataFrame:
    """One row for each group with any of ``values``: the keys, and for each value a struct of its name with ``n``, ``mean``,
    ``min``, ``max``, ``std`` (sample) and the exact ``median``; null where the group has no number of it, but for ``n``, 0.

    ``overall``: with a column ``_all``, and one more row, where it is true and the keys are null, for the whole table. The
    table is scanned twice, the first time when this is called.
    """
    spark, group = df.sparkSession, ["_all", *keys] if overall else keys
    rows = _tagged(df, keys, values)
    first = ("count(1) AS n", "avg(v) AS mean", "min(v) AS min", "max(v) AS max", "var_pop(v) AS var")
    counts = persist_table(rows.groupBy(*keys, "_tag", "_s", "_b").agg(*map(F.expr, first)), "counts")
    if overall:
        kinds = [counts.schema[k].dataType.simpleString() for k in keys]
        own, none = (", ".join([f"{flag} AS _all", *cells]) for flag, cells in (("false", [f"`{k}`" for k in keys]), ("true", [f"CAST(NULL AS {t}) AS `{k}`" for k, t in zip(keys, kinds)])))
        # Before the rows meet the located buckets each stands for its group and for the whole table.
        rows, counts = (x.selectExpr(f"inline(array(struct({own}), struct({none})))", *[c for c in x.columns if c not in keys]) for x in (rows, counts))
    # The deviations of the buckets' means from the group's add up with those inside the buckets, without cancellation.
    by = _list(*group, "_tag")
    plain = spark.sql(
        f"""SELECT {by}, sum(n) AS n, first(_mean) AS mean, min(min) AS min, max(max) AS max, sqrt(try_divide(sum(n * (var + pow(mean - _mean, 2))), sum(n) - 1)) AS std, CAST(NULL AS DOUBLE) AS v
        FROM (SELECT *, sum(n * mean) OVER (PARTITION BY {by}) / sum(n) OVER (PARTITION BY {by}) AS _mean FROM {{counts}}) GROUP BY {by}""",
        counts=counts,
    )
    middle = _pick(rows, counts, [*group, "_tag"], MIDDLE)
    empty = ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in (("n", "BIGINT"), *((c, "DOUBLE") for c in ("mean", "min", "max", "std"))))
    every = plain.unionByName(middle.selectExpr(*[f"`{k}`" for k in (*group, "_tag")], *empty.split(", "), "v"))
    figures = ["coalesce(sum(n) FILTER (WHERE _tag = '{t}'), 0L) AS n", *[f"max({c}) FILTER (WHERE _tag = '{{t}}') AS {c}" for c in ("mean", "min", "max", "std")], "avg(v) FILTER (WHERE _tag = '{t}') AS median"]
    structs = [F.expr(f"struct({', '.join(figures).replace('{t}', t)}) AS `{t}`") for t in values]
    return every.groupBy(*group).agg(*structs)


def _overall(df: DataFrame, values: dict[str, Column], ranks: dict[str, str]) -> DataFrame:
    """_tag, rank_tag, v over the whole table, for all values at once; the first of two scans is run when this is called."""
    rows = _tagged(df, [], values)
    return _pick(rows, rows, ["_tag"], ranks)


def _nearest(quantiles: dict[str, float]) -> dict[str, str]:
    return {t: f"floor((total - 1) * {float(q)!r}D + 0.5D)" for t, q in quantiles.items()}


def nearest_rank(df: DataFrame, value: Column, quantiles: dict[str, float]) -> DataFrame:
    """tag, v: nearest-rank quantiles over the whole table, the element at 0-based index round(q * (n - 1)), halves away
    from zero. No values, no rows."""
    return _overall(df, {"": value}, _nearest(quantiles)).selectExpr("rank_tag AS tag", "v")


def nearest_ranks(df: DataFrame, asked: dict[str, tuple[Column, float]]) -> Column:
    """A nearest-rank quantile of each of several values, as the fields of one scalar subquery; null without values."""
    found = _overall(df, {name: v for name, (v, _) in asked.items()}, _nearest({name: q for name, (_, q) in asked.items()}))
    fields = ", ".join(f"max(v) FILTER (WHERE _tag = '{name}') AS `{name}`" for name in asked)
    return found.filter("_tag = rank_tag").agg(F.expr(f"struct({fields})")).scalar()
