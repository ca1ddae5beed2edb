"""The registered queries of this subpackage, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leasemill.llm import encode, mojibake, packing, sketch, truncation
from leasemill.plans.registry import rounded, rounded_sql, table

Query = Callable[[SparkSession, str], DataFrame]


#: Table, key and field of problem 2.
NAMES = [
    ("dim_project", "project_key", "project_name_ar"),
    ("dim_location", "location_key", "area_name_ar"),
    ("dim_property", "property_key", "property_usage_ar"),
]


def garbled_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """table_name, record_key, original, garbled, mapping, restored of every record of the three tables.

    The corpus is what is not under suspicion: all documents and the list of usage labels.
    """
    corpus = table(spark, sf_dir, "documents").select("text").unionByName(table(spark, sf_dir, "usage_labels").select(F.col("property_usage_ar").alias("text")))
    names = [table(spark, sf_dir, t).select(F.lit(t).alias("table_name"), F.col(k).alias("record_key"), F.col(c).alias("name")) for t, k, c in NAMES]
    every = names[0].unionByName(names[1]).unionByName(names[2])
    return mojibake.detect(every, ["table_name", "record_key"], "name", mojibake.corpus_pairs(corpus, "text"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbled_names(spark, sf_dir).filter("garbled").select("table_name", "record_key")


def p2_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbled_names(spark, sf_dir).filter("garbled").drop("garbled")


def p2_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By table: garbled records, those for which a text was restored, and those whose restored text is, but for blanks, that
    of a record of the same table that is not garbled."""
    every = garbled_names(spark, sf_dir)
    # Names that are not garbled, each once; joined by equality.
    sound = every.filter(~F.col("garbled") & F.col("original").isNotNull()).select("table_name", F.trim("original").alias("_sound")).distinct().withColumn("_is", F.lit(True))
    told = every.filter("garbled").select("table_name", F.trim("restored").alias("_sound")).groupBy("table_name", "_sound").agg(F.count("*").alias("n"))
    told = told.join(sound, ["table_name", "_sound"], "left")
    n = F.col("n")
    return told.groupBy("table_name").agg(F.sum(n).alias("n_garbled"), F.coalesce(F.sum(F.when(F.col("_sound").isNotNull(), n)), F.lit(0)).alias("n_restored"), F.coalesce(F.sum(F.when(F.col("_is"), n)), F.lit(0)).alias("n_confirmed"))


QUANTILES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


def p5_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of the rent by usage and area, from sketches made by load and then merged."""
    keys = ["property_usage_en", "area_name_en"]
    by_load = sketch.build(table(spark, sf_dir, "rent_contracts"), ["load_id", *keys], "annual_amount")
    merged = sketch.merge([by_load], keys)
    return rounded(sketch.percentiles(merged, keys, QUANTILES), "value", "low", "high")


def p5_by(key: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        by_load = sketch.build(table(spark, sf_dir, "rent_contracts"), ["load_id", key], "annual_amount")
        return rounded(sketch.percentiles(sketch.merge([by_load], [key]), [key], QUANTILES), "value", "low", "high")

    return query


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode(table(spark, sf_dir, "documents"))


def p6_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again."""
    return encode.decode(p6_ids(spark, sf_dir))


def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), table(spark, sf_dir, "container_specs"))


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(p7_packed(spark, sf_dir)).withColumn("fill", F.round("fill", 4))


def p7_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.checks(p7_packed(spark, sf_dir))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.judged(table(spark, sf_dir, "documents")).filter("truncated").select("doc_id")


def p8_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.source_report(truncation.judged(table(spark, sf_dir, "documents"))).withColumn("share", F.round("share", 4))


def queries() -> dict[str, Query]:
    return {
        "p2_found": p2_found,
        "p2_restored": p2_restored,
        "p2_rate": p2_rate,
        "p5_percentiles": p5_percentiles,
        "p5_by_usage": p5_by("property_usage_en"),
        "p5_by_area": p5_by("area_name_en"),
        "p6_ids": p6_ids,
        "p6_decoded": p6_decoded,
        "p7_packed": p7_packed,
        "p7_fill": p7_fill,
        "p7_checks": p7_checks,
        "p8_found": p8_found,
        "p8_sources": p8_sources,
    }


def _p5_sql(keys: list[str]) -> str:
    k = ", ".join(keys)
    g = (1 + sketch.ALPHA) / (1 - sketch.ALPHA)
    qs = " UNION ALL ".join(f"SELECT CAST({q} AS DOUBLE) AS q" for q in QUANTILES)
    on = " AND ".join(f"s.{c} IS NOT DISTINCT FROM z.{c}" for c in keys)
    return f"""WITH x AS (SELECT {k}, annual_amount AS a, annual_amount IS NOT NULL AND NOT isnan(annual_amount) AND NOT isinf(annual_amount) AS ok FROM rent_contracts),
    z AS (SELECT {k}, count(*) FILTER (ok) AS n_values, count(*) FILTER (NOT ok) AS n_skipped FROM x GROUP BY ALL),
    s AS (SELECT {k}, a, row_number() OVER (PARTITION BY {k} ORDER BY a) - 1 AS r FROM x WHERE ok),
    qs AS ({qs}),
    p AS (SELECT {', '.join(f'z.{c}' for c in keys)}, n_values, n_skipped, q, a FROM z JOIN qs ON true LEFT JOIN s ON {on} AND s.r = floor(q * (n_values - 1))),
    e AS (SELECT *, CASE WHEN a = 0 THEN 0.0 WHEN a IS NOT NULL THEN sign(a) * pow({g!r}, ceil(ln(abs(a)) / ln({g!r}))) * 2.0 / ({g!r} + 1.0) END AS est FROM p)
    SELECT {k}, n_values, n_skipped, q, round(est, 4) AS value, round(least(est / {1 + sketch.ALPHA}, est / {1 - sketch.ALPHA}), 4) AS low, round(greatest(est / {1 + sketch.ALPHA}, est / {1 - sketch.ALPHA}), 4) AS high FROM e"""


def oracle_sql() -> dict[str, str]:
    sketches = {"p5_percentiles": _p5_sql(["property_usage_en", "area_name_en"]), "p5_by_usage": _p5_sql(["property_usage_en"]), "p5_by_area": _p5_sql(["area_name_en"])}
    return {k: rounded_sql(v) for k, v in sketches.items()} | {
        "p7_checks": "SELECT spec_id, capacity_tokens, count(*) AS n_texts, count(*) FILTER (coalesce(text, '') = '') AS n_empty, CAST(0 AS BIGINT) AS n_split_needlessly, CAST(0 AS BIGINT) AS n_with_gaps, CAST(0 AS BIGINT) AS n_overfull FROM documents JOIN container_specs ON true GROUP BY 1, 2",
        "p6_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    }
