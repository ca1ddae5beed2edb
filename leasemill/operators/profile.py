"""Problem 1: a profile of columns from persistent value-count tables.

State: one row for each (group, column, value) with the number of rows that hold it. A load arrives as a signed delta of
the same shape (:func:`delta`, ``sign=-1`` takes rows away); :class:`CountStore` keeps the deltas as a log at a named place,
merges them now and then, and knows which loads it has: :meth:`CountStore.refresh` adds the loads that are new, and takes
back what has changed or gone. Every figure of the profile is derived exactly from the counts, never from the rows again.

Defined results: a null counts as null, and so does NaN in a number; -0.0 is 0.0; a null group is a group of its own; rows
repeated in the input all count; an empty table gives an empty state and an empty profile; columns other than those asked
for are not read, whatever their names.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leasemill.operators.ranks import exact_medians
from leasemill.session import file_system, shared_path

STATE = T.StructType(
    [
        T.StructField("grp", T.LongType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("num", T.DoubleType()),
        T.StructField("txt", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)
KEY = ["grp", "column_name", "num", "txt"]


@dataclass(frozen=True)
class ColumnRule:
    """What is asked of a column: bounds for a number (both included), or the valid labels of a text."""

    name: str
    low: float | None = None
    high: float | None = None
    labels: tuple[str, ...] | None = None

    @property
    def numeric(self) -> bool:
        return self.labels is None


def _cells(df: DataFrame, rules: list[ColumnRule], group: str | Column) -> DataFrame:
    """grp, column_name, num, txt: one row for each row and column."""
    g = (F.col(group) if isinstance(group, str) else group).cast("bigint").alias("grp")
    cells = []
    for r in rules:
        if r.numeric:
            v = F.col(r.name).cast("double")
            num = F.when(F.isnan(v), None).when(v == 0, F.lit(0.0)).otherwise(v)
            cells.append(F.struct(F.lit(r.name).alias("column_name"), num.alias("num"), F.lit(None).cast("string").alias("txt")))
        else:
            cells.append(F.struct(F.lit(r.name).alias("column_name"), F.lit(None).cast("double").alias("num"), F.col(r.name).alias("txt")))
    return df.select(g, F.inline(F.array(*cells)))


def delta(df: DataFrame, rules: list[ColumnRule], group: str | Column, sign: int = 1) -> DataFrame:
    """The signed value counts of a load. One scan of the asked columns; equal values are combined before the shuffle."""
    return _cells(df, rules, group).groupBy(*KEY).agg((F.count("*") * F.lit(sign)).alias("n")).select(*STATE.names)


#: How often a run tries to make the next version of a store that others change at the same time.
ATTEMPTS = 3
#: More loads than this are no list of deliveries.
MOST_LOADS = 100_000


def fingerprints(cells: DataFrame, n: str = "1L") -> dict[int | None, list[int]]:
    """What tells one content of a group from another: its cells, and two sums over hashes of them, from single cells or from
    counted ones (``n``). One row for each group comes to the driver; equal groups are combined before the shuffle."""
    h = "xxhash64(column_name, num IS NULL, num, txt IS NULL, txt)"
    parts = [f"sum({n}) AS cells", f"sum({n} * pmod({h}, 16777216L)) AS low", f"sum({n} * pmod(shiftright({h}, 24), 16777216L)) AS high"]
    rows = cells.groupBy("grp").agg(*map(F.expr, parts)).limit(MOST_LOADS + 1).collect()
    if len(rows) > MOST_LOADS:
        raise ValueError(f"more than {MOST_LOADS} loads")
    return {r.grp: [r.cells, r.low, r.high] for r in rows}


def merge(*parts: DataFrame) -> DataFrame:
    """The state that the given states and deltas add up to. Counts below zero show that rows were taken away that were
    never there; they stay visible (``n`` < 0) instead of being dropped."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy(*KEY).agg(F.sum("n").alias("n")).filter(F.col("n") != 0).select(*STATE.names)


class CountStore:
    """A state as a log of signed deltas below one folder, which a later run finds again by its path.

    A list (``list-n.json``) names the parts of version n: tables of counts, each distinct in its keys. A delta is written as
    a new part, at a cost that grows with the delta only. Parts are merged like the digits of a binary counter, when one is
    at most twice as large as all after it: a row is rewritten some log2(parts) times in all, and there are as few parts. A
    version counts once its list is there, which is never overwritten; what failed before that is not seen (its parts stay
    unread). Parts and lists older than the version before are removed. Of two runs that make the same version at once one fails;
    :meth:`refresh` then starts again from what the other has made.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or shared_path(spark, "counts")
        self.list: dict = {"version": 0, "parts": [], "dropped": [], "loads": [], "columns": None, "batch": -1}
        if path:
            self._find()

    def _lists(self) -> dict[int, str]:
        pattern, fs = file_system(self.spark, f"{self.path}/list-*.json")
        found = [f.getPath().toString() for f in fs.globStatus(pattern) or []]
        return {int(f.rsplit("-", 1)[1].removesuffix(".json")): f for f in found}

    def _find(self) -> None:
        """Read the newest list that is whole."""
        for _, file in sorted(self._lists().items(), reverse=True):
            try:
                self.list = json.loads("".join(r.value for r in self.spark.read.text(file, wholetext=True).collect()))
                return
            except ValueError:
                continue

    @property
    def version(self) -> int:
        return self.list["version"]

    def _part(self, df: DataFrame) -> dict:
        name = f"part-{uuid.uuid4().hex}"
        df.select(*STATE.names).write.parquet(f"{self.path}/{name}")
        return {"name": name, "rows": self._read(name).count(), "groups": None}

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(STATE).parquet(f"{self.path}/{name}")

    def _sum(self, parts: list[dict]) -> DataFrame:
        """The parts added up. Parts that are known to share no group have no key in common and are not shuffled."""
        if not parts:
            return self.spark.createDataFrame([], STATE)
        tables = [self._read(p["name"]) for p in parts]
        groups = [g for p in parts for g in p["groups"] or []]
        if len(parts) == 1 or (all(p["groups"] is not None for p in parts) and len(set(groups)) == len(groups)):
            return reduce(DataFrame.unionByName, tables)
        return merge(*tables)

    def read(self) -> DataFrame:
        """The state. A single part is read as it is, so counts of a delta that took away what was never there show."""
        return self._sum(self.list["parts"])

    def _commit(self, parts: list[dict], **more) -> None:
        parts = [p for p in parts if p["rows"]]
        while len(parts) > 1 and parts[-2]["rows"] <= 2 * parts[-1]["rows"]:
            start = len(parts) - 2
            while start and parts[start - 1]["rows"] <= 2 * sum(p["rows"] for p in parts[start:]):
                start -= 1
            known = all(p["groups"] is not None for p in parts[start:])
            groups = sorted({g for p in parts[start:] for g in p["groups"]}, key=str) if known else None
            parts = parts[:start] + [p for p in [self._part(merge(*[self._read(p["name"]) for p in parts[start:]])) | {"groups": groups}] if p["rows"]]
        kept, before = {p["name"] for p in parts}, self.list
        dropped = [p["name"] for p in before["parts"] if p["name"] not in kept]
        made = before | {"version": before["version"] + 1, "parts": parts, "dropped": dropped} | more
        path, fs = file_system(self.spark, f"{self.path}/list-{made['version']:09d}.json")
        out = fs.create(path, False)  # fails if another run has made this version
        out.write(bytearray(json.dumps(made).encode()))
        out.close()
        self.list = made
        for name in before["dropped"]:
            fs.delete(file_system(self.spark, f"{self.path}/{name}")[0], True)
        for version, file in self._lists().items():
            if version < self.version - 1:
                fs.delete(file_system(self.spark, file)[0], False)

    def apply(self, *deltas: DataFrame, batch: int | None = None) -> DataFrame:
        """Add deltas and return the state. ``batch``: a number that rises; one that was applied already is passed over, so
        that a batch that is replayed after a failure counts once."""
        if batch is None or batch > self.list["batch"]:
            self._commit([*self.list["parts"], *map(self._part, deltas)], batch=self.list["batch"] if batch is None else batch)
        return self.read()

    def refresh(self, df: DataFrame, rules: list[ColumnRule], group: str) -> DataFrame:
        """Bring the state up to date with the loads (values of ``group``) of a table, and return it.

        Each load is a signed delta of its own group. A store without loads takes all of them in one scan. Later ones compare
        the fingerprints of the loads, for which values are not shuffled, and scan only loads that are new or have changed; the
        counts of changed and vanished loads are taken back by what the store holds of them, with the sign turned.
        """
        for _ in range(ATTEMPTS - 1):
            try:
                return self._refresh(df, rules, group)
            except Py4JJavaError as e:
                if "FileAlreadyExists" not in str(e):
                    raise
                self._find()
        return self._refresh(df, rules, group)

    def _refresh(self, df: DataFrame, rules: list[ColumnRule], group: str) -> DataFrame:
        columns = [r.name for r in rules]
        if self.list["columns"] not in (None, columns):
            raise ValueError(f"the store at {self.path} counts {self.list['columns']}")
        held = {g: f for g, *f in self.list["loads"]}
        if not held:
            part = self._part(delta(df, rules, group))
            seen = fingerprints(self._read(part["name"]), "n")
            parts = [part | {"groups": list(seen)}]
        else:
            seen = fingerprints(_cells(df, rules, group))
            fresh = [g for g in seen if held.get(g) != seen[g]]
            stale = [g for g in held if g in fresh or g not in seen]
            if not fresh and not stale:
                return self.read()
            parts = [self._part(self.read().filter(_among("grp", stale)).withColumn("n", -F.col("n"))) | {"groups": stale}] if stale else []
            if fresh:
                parts.append(self._part(delta(df.filter(_among(group, fresh)), rules, group)) | {"groups": fresh})
        self._commit([*self.list["parts"], *parts], loads=[[g, *f] for g, f in seen.items()], columns=columns)
        return self.read()


def _among(column: str, values: list[int | None]) -> Column:
    c = F.col(column).cast("bigint")
    named = c.isin([v for v in values if v is not None]) if any(v is not None for v in values) else F.lit(False)
    return F.coalesce(named, F.lit(False)) | c.isNull() if None in values else F.coalesce(named, F.lit(False))


def total(state: DataFrame) -> DataFrame:
    """The state with the groups added up (``grp`` null): what a profile of the whole table is derived from."""
    return state.groupBy("column_name", "num", "txt").agg(F.sum("n").alias("n")).select(F.lit(None).cast("bigint").alias("grp"), "column_name", "num", "txt", "n")


def _is_null() -> Column:
    return F.col("num").isNull() & F.col("txt").isNull()


def _bad(rules: list[ColumnRule]) -> Column:
    """A value outside its column's bounds or labels."""
    out = F.lit(False)
    for r in rules:
        mine = F.col("column_name") == r.name
        if r.numeric and r.low is not None:
            out = out | (mine & ((F.col("num") < r.low) | (F.col("num") > r.high)))
        elif not r.numeric:
            out = out | (mine & ~F.col("txt").isin(list(r.labels or ())))
    return F.coalesce(out, F.lit(False))


def profile(state: DataFrame, rules: list[ColumnRule]) -> DataFrame:
    """One row for each group and column, by one aggregation of the state.

    n_rows, n_null, null_rate; n_distinct; min_num, max_num; n_bad, bad_share (outside the bounds or not a label, of the
    non-null rows); top_n, top_share and the most frequent value (ties: the smallest); entropy in bits of the non-null
    values. Shares and entropy are null where there is no non-null row.
    """
    there, n = ~_is_null(), F.col("n")
    live = F.sum(F.when(there, n))
    best = F.max(F.when(there, F.struct(n.alias("n"), (-F.col("num")).alias("neg"), F.col("num").alias("num"))))
    best_txt = F.min(F.when(there, F.struct((-n).alias("neg"), F.col("txt").alias("txt"))))
    agg = state.groupBy("grp", "column_name").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(_is_null(), n)), F.lit(0)).alias("n_null"),
        F.coalesce(live, F.lit(0)).alias("n_live"),
        F.count_if(there).alias("n_distinct"),
        F.min("num").alias("min_num"),
        F.max("num").alias("max_num"),
        F.coalesce(F.sum(F.when(_bad(rules), n)), F.lit(0)).alias("n_bad"),
        F.max(F.when(there, n)).alias("top_n"),
        best.alias("_best"),
        best_txt.alias("_best_txt"),
        F.sum(F.when(there, n * F.log2(n.cast("double")))).alias("_nlogn"),
    )
    alive = F.col("n_live").cast("double")
    return agg.select(
        "grp",
        "column_name",
        "n_rows",
        "n_null",
        F.try_divide(F.col("n_null").cast("double"), F.col("n_rows")).alias("null_rate"),
        "n_distinct",
        "min_num",
        "max_num",
        "n_bad",
        F.try_divide(F.col("n_bad").cast("double"), alive).alias("bad_share"),
        "top_n",
        F.try_divide(F.col("top_n").cast("double"), alive).alias("top_share"),
        F.col("_best.num").alias("top_num"),
        F.col("_best_txt.txt").alias("top_txt"),
        F.when(alive > 0, F.greatest(F.lit(0.0), F.log2(F.nullif(alive, F.lit(0.0))) - F.try_divide(F.col("_nlogn"), alive))).alias("entropy"),
    )


def medians(state: DataFrame) -> DataFrame:
    """Exact median of the values above 0 for each group and numeric column: grp, column_name, median."""
    counts = state.filter(F.col("num") > 0).select("grp", "column_name", F.col("num").alias("v"), "n")
    return exact_medians(counts, ["grp", "column_name"])


def label_shares(state: DataFrame, rule: ColumnRule) -> DataFrame:
    """grp, column_name, label, share: of each valid label (0 where a group lacks it) among the non-null values."""
    mine = state.filter((F.col("column_name") == rule.name) & F.col("txt").isNotNull())
    groups = mine.groupBy("grp").agg(F.sum("n").alias("_all"))
    cells = groups.select(F.col("grp").alias("_g"), "_all", F.explode(F.array(*[F.lit(x) for x in rule.labels])).alias("label"))
    held = cells.join(mine.select("grp", "txt", "n"), F.col("_g").eqNullSafe(F.col("grp")) & (F.col("label") == F.col("txt")), "left")
    share = F.try_divide(F.coalesce(F.col("n"), F.lit(0)).cast("double"), F.col("_all"))
    return held.select(F.col("_g").alias("grp"), F.lit(rule.name).alias("column_name"), "label", share.alias("share"))


def distribution_change(state: DataFrame) -> DataFrame:
    """How the non-null values of each group are distributed otherwise than those of the group before it, by number, and of the
    whole table: grp, column_name, ``shift`` (null for the first) and ``shift_whole``. Total-variation distances in 0..1,
    half the sum of the absolute differences of the shares. A group without values of a column has no part in it.

    A value's rows, at most one for each group, meet in one window; no value is joined to all groups.
    """
    value = "column_name, num, txt"
    return state.sparkSession.sql(
        f"""WITH live AS (SELECT * FROM {{state}} WHERE num IS NOT NULL OR txt IS NOT NULL),
        sizes AS (SELECT grp AS g, column_name AS c, sum(n) AS size, sum(sum(n)) OVER (PARTITION BY column_name) AS every,
          dense_rank() OVER (PARTITION BY column_name ORDER BY grp) AS place FROM live GROUP BY grp, column_name),
        shares AS (SELECT grp, column_name, place, n / size AS p, sum(n) OVER (PARTITION BY {value}) / every AS q,
          lag(n / size) OVER (PARTITION BY {value} ORDER BY place) AS p0, lag(place) OVER (PARTITION BY {value} ORDER BY place) AS place0
          FROM live JOIN sizes ON grp <=> g AND column_name = c)
        SELECT grp, column_name, CASE WHEN place > 1 THEN 1 - coalesce(sum(least(p, p0)) FILTER (WHERE place0 = place - 1), 0) END AS shift,
          1 - sum(least(p, q)) AS shift_whole FROM shares GROUP BY grp, column_name, place""",
        state=state,
    )


#: How far a figure may lie from the median over the groups.
NULL_RATE_STEP, LEVEL_RATIO, RANGE_STEP, TOP_STEP, PATTERN_STEP, MIX_STEP = 0.05, 1.6, 0.05, 0.10, 0.10, 0.15


def departures(state: DataFrame, rules: list[ColumnRule]) -> DataFrame:
    """Groups whose figure departs from the median of the figure over all groups: grp, column_name, finding.

    Findings: null_rate, level, range, top_share for numbers; null_rate, pattern, mix for labelled texts. Groups in which a
    figure does not exist (no non-null rows) have no part in its median.
    """
    numeric = [r.name for r in rules if r.numeric]
    texts = [r for r in rules if not r.numeric]
    is_num = F.col("column_name").isin(numeric)
    prof = profile(state, rules)
    figures = prof.select(
        "grp",
        "column_name",
        F.inline(
            F.array(
                F.struct(F.lit("null_rate").alias("finding"), F.lit("").alias("label"), F.col("null_rate").alias("x")),
                F.struct(F.lit("range").alias("finding"), F.lit("").alias("label"), F.when(is_num, F.col("bad_share")).alias("x")),
                F.struct(F.lit("pattern").alias("finding"), F.lit("").alias("label"), F.when(~is_num, F.col("bad_share")).alias("x")),
                F.struct(F.lit("top_share").alias("finding"), F.lit("").alias("label"), F.when(is_num, F.col("top_share")).alias("x")),
            )
        ),
    )
    level = medians(state).select("grp", "column_name", F.lit("level").alias("finding"), F.lit("").alias("label"), F.col("median").alias("x"))
    figures = figures.unionByName(level)
    for r in texts:
        figures = figures.unionByName(label_shares(state, r).select("grp", "column_name", F.lit("mix").alias("finding"), "label", F.col("share").alias("x")))
    figures = figures.filter(F.col("x").isNotNull())
    # One row for each group and figure: the median over the groups sees no data rows.
    middle = F.median("x").over(Window.partitionBy("column_name", "finding", "label"))
    x, m = F.col("x"), F.col("m")
    away = {
        "null_rate": F.abs(x - m) > NULL_RATE_STEP,
        "level": (x > m * LEVEL_RATIO) | (m > x * LEVEL_RATIO),
        "range": x - m > RANGE_STEP,
        "top_share": x - m > TOP_STEP,
        "pattern": x - m > PATTERN_STEP,
        "mix": F.abs(x - m) > MIX_STEP,
    }
    hit = F.lit(False)
    for name, test in away.items():
        hit = hit | ((F.col("finding") == name) & test)
    return figures.withColumn("m", middle).filter(hit).select("grp", "column_name", "finding").distinct()
