"""The contract CSV source and the table sinks."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leasemill.functions.exprs import null_tokens, parse_date
from leasemill.operators import quality
from leasemill.schema import CONTRACTS
from leasemill.settings import PARQUET_CODEC, PARQUET_CODEC_LEVEL

log = logging.getLogger(__name__)

CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "mode": "PERMISSIVE",
    # Every file's header is compared with the columns that are read; another order in one of them is an error.
    "enforceSchema": "false",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def header(spark: SparkSession, path: str, options: dict[str, str] = CSV_OPTIONS) -> list[str]:
    """The column names of the first file there; reads its first record."""
    return spark.read.options(**options).csv(path).columns


def as_strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def typed(raw: DataFrame, schema: T.StructType = CONTRACTS) -> DataFrame:
    """String columns to their types: null tokens and what does not cast become null, and so does NaN."""
    columns = []
    for f in schema.fields:
        if f.name not in raw.columns:
            continue
        c = null_tokens(F.col(f.name))
        if isinstance(f.dataType, T.DateType):
            c = parse_date(c)
        elif isinstance(f.dataType, T.DoubleType):
            c = F.nullif(c.try_cast("double"), F.lit(float("nan")))
        elif not isinstance(f.dataType, T.StringType):
            c = c.try_cast(f.dataType)
        columns.append(c.alias(f.name))
    return raw.select(*columns)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = CONTRACTS, line_breaks: bool = True) -> DataFrame:
    """Contracts from CSV files, their columns found by the names in the header, in any order; columns that ``schema`` does not
    know are left out, columns that the files lack are absent from the result, and a header with none of them is an error,
    as is a file whose header differs from the first one's. Malformed UTF-8 becomes U+FFFD.

    Line breaks inside quotes stay in the value, so no file is split between tasks: one task reads a file, as a stream, and
    files are read in parallel. A quote that is never closed takes the rest of its file with it. ``line_breaks=False`` is for
    files that are known to have none in values: they are split between tasks.
    """
    options = CSV_OPTIONS | {"multiLine": str(line_breaks).lower()}
    names = header(spark, path, options)
    if not {*names} & {*schema.names}:
        raise ValueError(f"no known column in the header of {path}: {names}")
    return typed(spark.read.schema(as_strings(names)).options(**options).csv(path), schema)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet with zstd. ``mode="ignore"`` leaves a table that is already there."""
    writer = df.write.mode(mode).option("compression", PARQUET_CODEC).option("parquet.compression.codec.zstd.level", PARQUET_CODEC_LEVEL)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv_report(df: DataFrame, path: str) -> None:
    """A report as one CSV file (a folder with one part); for aggregated results."""
    df.coalesce(1).write.mode("overwrite").options(header="true", quote='"', escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Any table as CSV that ``read_csv`` reads back: dates dd-MM-yyyy, ``null`` for nulls."""
    out = df.select(*[F.coalesce(F.date_format(f.name, "dd-MM-yyyy") if isinstance(f.dataType, T.DateType) else F.col(f.name).cast("string"), F.lit("null")).alias(f.name) for f in df.schema.fields])
    out.write.mode("overwrite").options(header="true", quote='"', escape='"', quoteAll="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)


def csv_to_parquet(spark: SparkSession, source: str, target: str, validate: bool = True, report: Callable[[quality.ValidationResult], None] | None = None) -> bool:
    """CSV to typed Parquet; False if anything failed. Validation findings are reported and never stop the load."""
    try:
        df = read_csv(spark, source)
        write_parquet(df, target)
        if validate:
            result = quality.validate(spark.read.parquet(target))
            (report or (lambda r: log.info("%s", r)))(result)
        return True
    except Exception:
        log.exception("load of %s failed", source)
        return False
