"""Helpers shared by the training-data operators: session settings, landed tables, words."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_defaults, checkpoint_dir

# The white space that ends a word; bytes.split() without arguments splits at exactly these six.
WORD_ENDS = " \t\n\x0b\x0c\r"
# Bytes of one Arrow batch handed to Python; bounds a task's memory whatever the texts' lengths are.
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings every operator here relies on; safe to call again."""
    apply_defaults(spark)
    checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """The named columns (all when none is named) of a Parquet table."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


def landed(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts the lineage where a result is used more than once or a loop would grow the plan.
    The table lies in shared storage, so losing an executor loses none of it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def neutral(df: DataFrame, *keep: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with all columns but ``keep`` named c0, c1, ... by place, and the way back to its columns and names.

    Helper columns added in between then clash with no column a user may have.
    """
    names = [c if c in keep else f"c{i}" for i, c in enumerate(df.columns)]
    return df.toDF(*names), lambda rows: rows.select(*[F.col(n).alias(c) for n, c in zip(names, df.columns)])


def is_word_text(col):
    """Whether a text has at least one character that is no word end."""
    return F.length(F.translate(col, WORD_ENDS, "")) > 0


def ascii_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches that have rows."""
    return (b for b in rows if b.num_rows)


def groups(rows: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of equal keys of sorted rows; a group waits until its last row has come."""
    waiting = None
    for batch in batches(rows):
        table = pa.Table.from_batches([batch])
        table = table if waiting is None else pa.concat_tables([waiting, table])
        columns = [table.column(k).to_numpy() for k in keys]
        cuts = np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)])
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield table.slice(a, b - a)
        waiting = table.slice(cuts[-1])
    if waiting is not None:
        yield waiting
