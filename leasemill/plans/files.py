"""Queries through files: CSV written and ingested again, in batch and as a stream, and links taken from pages."""

from __future__ import annotations

import csv
import io
import json
import tempfile
import urllib.parse
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leasemill.schema import CONTRACTS
from leasemill.session import file_system, shared_path
from leasemill.sources.contracts import read_csv, write_csv
from leasemill.sources.fetch import download_contracts, link_column
from leasemill.sources.publish import from_token, publish_existing
from leasemill.streaming.ingest import ingest_new_files, usage_counts

#: What is put into a text column on its way through the files: line breaks, quotes and commas.
TROUBLE = ' "A",\n\r\n,'


def _csv_folder(spark: SparkSession, sf_dir: str) -> str:
    """All contract columns as CSV files, in another order, with a column more, and with trouble in a text."""
    path = shared_path(spark, "csv")
    rows = spark.read.parquet(f"{sf_dir}/rent_contracts.parquet")
    rows = rows.withColumn("master_project_en", F.concat(F.col("project_name_en"), F.lit(TROUBLE), F.col("area_name_en")))
    # One task reads a file, so there are several.
    write_csv(rows.select("source_file", *reversed(CONTRACTS.names)).repartition(spark.sparkContext.defaultParallelism), path)
    return path


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv(spark, _csv_folder(spark, sf_dir))


def stream_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = shared_path(spark, "ingested")
    ingest_new_files(spark, _csv_folder(spark, sf_dir), target, shared_path(spark, "progress")).awaitTermination()
    return spark.read.schema(CONTRACTS).parquet(target)


def stream_usage_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windowed counts over the contracts as a stream; the update stream's last state of each window. The watermark is so
    far back that no row of the table is late, in whatever order its files come."""
    source = f"{sf_dir}/rent_contracts.parquet"
    schema = spark.read.parquet(source).schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/rent_contracts.parquet*")
    target, progress = shared_path(spark, "windows"), shared_path(spark, "progress")
    timed = rows.filter(F.col("ingestion_timestamp").isNotNull()).withColumn("at", F.col("ingestion_timestamp").cast("timestamp"))
    out = usage_counts(timed, "at", late_by="36500 days")

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{target}/batch={number}")

    out.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    states = spark.read.parquet(target)
    last = states.groupBy("window_start", "property_usage_en").agg(F.max_by(F.struct("n", "rent"), "batch").alias("x"))
    return last.select("window_start", "property_usage_en", F.col("x.n").alias("n"), F.round("x.rent", 2).alias("rent"))


#: Pages with the label %s in a link, and whether that link counts. Each page is made from a row of the usage labels.
PAGES = [
    ('<a class="other" href="x.csv">No</a><p><a href="%s" class="big action-icon-anchor">A</a><a class="action-icon-anchor" href="second.csv">B</a></p>', True),
    ('<a class="action-icon-anchor-old" href="%s">Old</a>', False),
    ("<A data-href='x.csv' CLASS = action-icon-anchor\n href='%s'>", True),
    ('<!-- <a class="action-icon-anchor" href="x"> --><script>"<a class=\'action-icon-anchor\' href=\'x\'>"</script><a title="a > b" href="%s" class="action-icon-anchor">', True),
    ('<a title=" class=action-icon-anchor" href="%s">', False),
    ('<a class="action-icon-anchor">no target</a><a class="action-icon-anchor" href="%s">', False),
]


def html_link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/usage_labels.parquet")
    page = F.element_at(F.array(*[F.lit(p) for p, _ in PAGES]), (F.pmod("usage_id", F.lit(len(PAGES))) + 1).cast("int"))
    pages = labels.select("usage_id", F.replace(page, F.lit("%s"), F.col("property_usage_en")).alias("html"))
    return pages.select("usage_id", link_column(F.col("html")).alias("href"))


# ------------------------------------------------------------------------- services, played by this process for a small table


def _labels_csv(spark: SparkSession, sf_dir: str) -> bytes:
    """The usage labels, a list of bounded length (``registry.labels`` checks it), as one CSV file."""
    t = spark.read.parquet(f"{sf_dir}/usage_labels.parquet").select("property_usage_en", "property_usage_ar", F.lit("x").alias("contract_id")).toPandas()
    return t.to_csv(index=False, quoting=csv.QUOTE_ALL).encode()


def fetch_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page, its link and the file from a service that fails twice; then once more, when the file is there already."""
    data, failures = _labels_csv(spark, sf_dir), [2]
    pages = {"http://labels/": b'<a class="action-icon-anchor" href="files/labels.csv">', "http://labels/files/labels.csv": data}

    def opener(url: str, timeout: float):
        if failures[0]:
            failures[0] -= 1
            raise OSError("down")
        return io.BytesIO(pages[url])

    with tempfile.TemporaryDirectory() as folder:  # of the driver, where downloads go
        file = f"{folder}/labels.csv"
        done = [download_contracts("http://labels/", file, opener, lambda s: None) for _ in range(2)]
        if done != [True, True] or Path(file).read_bytes() != data:
            raise ValueError("the file did not arrive")
        target, fs = file_system(spark, f"{shared_path(spark, 'fetched')}/labels.csv")
        fs.copyFromLocalFile(file_system(spark, Path(file).as_uri())[0], target)
    return read_csv(spark, target.toString()).select("property_usage_en", "property_usage_ar")


def _published(spark: SparkSession, sf_dir: str, repository: str | None) -> DataFrame:
    """The usage labels written as a table, published to a service by a token, and read back from what the service got."""
    got: dict[str, bytes] = {}

    def http(method: str, url: str, headers: dict, body) -> tuple[int, bytes]:
        if method == "GET":
            return (404, b"") if repository else (200, b"[]")
        if isinstance(body, Path):
            got[urllib.parse.unquote(url.rsplit("=" if repository else "/", 1)[1])] = body.read_bytes()
        return 201, json.dumps({"id": 1, "links": {"bucket": "http://bucket"}}).encode()

    with tempfile.TemporaryDirectory() as folder:  # of the driver, where artifacts to be published lie
        pq.write_to_dataset(spark.read.parquet(f"{sf_dir}/usage_labels.parquet").toArrow(), f"{folder}/labels")
        none = publish_existing(from_token(None, "http://api", repository=repository, http=http), "v1", [f"{folder}/labels"])
        made = publish_existing(from_token("t", "http://api", repository=repository, http=http), "v1", [f"{folder}/labels", f"{folder}/none"])
    if none is not None or made != "1" or not got:
        raise ValueError("nothing was published, or without a token")
    return spark.createDataFrame(pa.concat_tables([pq.read_table(pa.BufferReader(b)) for b in got.values()]))


def publish_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir, "owner/labels")


def publish_deposit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir, None)


def queries() -> dict:
    return {
        "csv_ingest": csv_ingest,
        "stream_csv_ingest": stream_csv_ingest,
        "stream_usage_windows": stream_usage_windows,
        "html_link_extract": html_link_extract,
        "fetch_labels": fetch_labels,
        "publish_release": publish_release,
        "publish_deposit": publish_deposit,
    }


def _through_sql() -> str:
    cells = []
    for f in CONTRACTS.fields:
        c = "project_name_en || ' \"A\",' || chr(10) || chr(13) || chr(10) || ',' || area_name_en" if f.name == "master_project_en" else f.name
        cells.append(f"CASE WHEN ({c}) NOT IN ('', 'null', 'NULL') THEN {c} END AS {f.name}" if f.dataType == T.StringType() else f"{c} AS {f.name}")
    return f"SELECT {', '.join(cells)} FROM rent_contracts"


def oracle_sql() -> dict[str, str]:
    counts = ", ".join(str(i) for i, (_, ok) in enumerate(PAGES) if ok)
    return {
        "csv_ingest": _through_sql(),
        "stream_csv_ingest": _through_sql(),
        "stream_usage_windows": "SELECT time_bucket(INTERVAL 30 DAY, ingestion_timestamp, TIMESTAMP '1970-01-01') AS window_start, property_usage_en, count(*) AS n, round(sum(annual_amount), 2) AS rent FROM rent_contracts WHERE ingestion_timestamp IS NOT NULL GROUP BY 1, 2",
        "html_link_extract": f"SELECT usage_id, CASE WHEN usage_id % {len(PAGES)} IN ({counts}) THEN property_usage_en END AS href FROM usage_labels",
        "fetch_labels": "SELECT property_usage_en, property_usage_ar FROM usage_labels",
        "publish_release": "SELECT * FROM usage_labels",
        "publish_deposit": "SELECT * FROM usage_labels",
    }
