"""Database view extract over JDBC.

The original runs ``SELECT TOP 100 * FROM view`` through ODBC.  Here the view is a JDBC
DataFrame: the limit and any date filter are pushed into the database query, and a
partitioned read (``partition_column`` + bounds) splits a large extract over tasks.
No database is reachable in this environment, so this module is only exercised
with a stand-in table in the tests (see README).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config


def read_view(spark: SparkSession, url: str, table: str, user: str | None = None, password: str | None = None,
              driver: str | None = None, fetch_size: int = 1000, partition_column: str | None = None,
              lower_bound=None, upper_bound=None, num_partitions: int | None = None) -> DataFrame:
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", fetch_size).option("pushDownLimit", True).option("pushDownPredicate", True))
    for key, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            reader = reader.option(key, value)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
                  .option("upperBound", upper_bound).option("numPartitions", num_partitions or 8))
    return reader.load()


def extract(view: DataFrame, date_column: str | None = None, start=None, end=None,
            limit: int | None = None, order: list[str] | None = None) -> DataFrame:
    """P13 + O5: optional day / interval filter (pushed to the database), optional order,
    and a row limit only where one is given (``config.EXTRACT_ROWS`` for the top-n extract)."""
    out = view
    if date_column and start is not None:
        out = out.where(F.col(date_column) >= F.lit(start))
    if date_column and end is not None:
        out = out.where(F.col(date_column) < F.lit(end))
    if order:
        out = out.orderBy(*order)
    return out.limit(limit) if limit else out
