"""Any SQL query over one contract table, or over the whole star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame

from leasemill.operators import star
from leasemill.schema import DIMENSIONS

#: Both names under which published scripts know the table.
VIEW_NAMES = ("rent_contracts", "rent_contracts_df")


def run_sql(df: DataFrame, query: str, names: tuple[str, ...] = VIEW_NAMES) -> DataFrame:
    """The query's result; the table is visible under each of ``names``."""
    for name in names:
        df.createOrReplaceTempView(name)
    return df.sparkSession.sql(query)


def register_star(df: DataFrame) -> list[str]:
    """Views of the star schema over a contract table; returns their names."""
    spark = df.sparkSession
    views = {f"dim_{n}": star.dimension(df, n) for n in DIMENSIONS} | {"dim_date": star.dim_date(spark), "fact_rent_contract": star.fact(df)}
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)
