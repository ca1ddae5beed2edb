"""The batch pipeline: download, load, report, publish."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import date
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from leasemill.operators.usage import compare_periods, usage_report
from leasemill.sources.contracts import csv_to_parquet, write_csv_report
from leasemill.sources.fetch import download_contracts
from leasemill.sources.publish import Publisher, publish_existing

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Paths:
    """Artifacts of one day."""

    root: str
    day: date

    def at(self, name: str) -> str:
        return str(Path(self.root) / f"{name}_{self.day.isoformat()}")

    @property
    def csv(self) -> str:
        return self.at("rent_contracts") + ".csv"

    @property
    def parquet(self) -> str:
        return self.at("rent_contracts") + ".parquet"

    @property
    def report(self) -> str:
        return self.at("property_usage")


def report_usage(spark: SparkSession, contracts: str, target: str, day: date) -> bool:
    """Write the usage report of a contract table; False if it failed."""
    try:
        write_csv_report(usage_report(spark.read.parquet(contracts), F.lit(day)), target)
        return True
    except Exception:
        log.exception("usage report of %s failed", contracts)
        return False


def report_comparison(spark: SparkSession, current: str, previous: str, target: str, day: date) -> bool:
    """Write the comparison of two contract tables; False if it failed."""
    try:
        write_csv_report(compare_periods(spark.read.parquet(current), spark.read.parquet(previous), F.lit(day)), target)
        return True
    except Exception:
        log.exception("comparison of %s and %s failed", current, previous)
        return False


def publish_artifacts(publisher: Publisher | None, tag: str, files: list[str]) -> bool:
    """Publish what exists; False if it failed or left out a file."""
    try:
        made = publish_existing(publisher, tag, files)
        missing = getattr(publisher, "missing", []) if made is not None else []
        if missing:
            log.error("%s lacks %s", tag, missing)
        return not missing
    except Exception:
        log.exception("publication of %s failed", tag)
        return False


def run(spark: SparkSession, page_url: str | None, root: str, day: date, publisher: Publisher | None = None) -> bool:
    """The whole pipeline. Without a URL nothing is done; a step that fails ends the run."""
    if not page_url:
        return False
    paths = Paths(root, day)
    if not download_contracts(page_url, paths.csv):
        return False
    if not csv_to_parquet(spark, paths.csv, paths.parquet):
        return False
    if not report_usage(spark, paths.parquet, paths.report, day):
        return False
    return publish_artifacts(publisher, f"release-{day.isoformat()}", [paths.parquet, paths.report])
