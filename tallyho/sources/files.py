"""File discovery and plain-text sources.

Listings come from the ``binaryFile`` source with only path / time / length selected, so
file contents are never read just to list them.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..operators.extract import latest_per_folder


def list_files(spark: SparkSession, root: str, extensions=config.WORKBOOK_EXTENSIONS, recursive: bool = False,
               skip_prefixes=config.SKIP_FILE_PREFIXES, own_outputs=config.OWN_OUTPUT_PREFIXES,
               with_content: bool = False) -> DataFrame:
    """``path, folder, file_name, modificationTime, length`` of matching files in the
    immediate sub-folders of ``root`` (any depth if ``recursive``).  Extensions are
    filtered while listing (``pathGlobFilter``); ``with_content`` adds the file bytes."""
    glob = "*.{" + ",".join(sorted({e.lower() for e in extensions} | {e.upper() for e in extensions})) + "}"
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    pattern = root.rstrip("/") + ("" if recursive else "/*/*")
    cols = ["path", "modificationTime", "length"] + (["content"] if with_content else [])
    listing = reader.load(pattern).select(*cols)
    parts = F.split(F.col("path"), "/")
    name = F.element_at(parts, -1)
    ext = F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1))
    keep = ext.isin(*extensions)
    for p in list(skip_prefixes) + list(own_outputs):
        keep = keep & ~name.startswith(p)
    return listing.select("path", F.element_at(parts, -2).alias("folder"), name.alias("file_name"),
                          *[c for c in cols if c != "path"]).where(keep)


def keep_folders(listing: DataFrame, excluded_names=config.EXCLUDED_DIR_NAMES,
                 excluded_parts=config.EXCLUDED_DIR_PARTS, drop_hidden: bool = False) -> DataFrame:
    """Drop folders by exact name and by name fragment (and dot-folders, optional)."""
    f = F.col("folder")
    cond = ~f.isin(*excluded_names)
    for part in excluded_parts:
        cond = cond & ~F.lower(f).contains(part)
    if drop_hidden:
        cond = cond & ~f.startswith(".")
    return listing.where(cond)


def latest_files(listing: DataFrame, by_name_time: bool = True) -> DataFrame:
    """The newest file per folder."""
    return latest_per_folder(listing, use_name_time=by_name_time)


def read_all_strings(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A delimited table read as text only, header names stripped."""
    df = spark.read.option("header", True).option("inferSchema", False).option("sep", sep).csv(path)
    return df.toDF(*[c.strip() for c in df.columns])


SENSOR_LOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("humidity_%RH", T.DoubleType()),
    T.StructField("temperature_C", T.DoubleType()),
])


def read_sensor_log(spark: SparkSession, path: str) -> DataFrame:
    """The sensor CSV log (header, UTF-8, CRLF line ends) with an explicit schema."""
    return spark.read.schema(SENSOR_LOG_SCHEMA).option("header", True).csv(path)


def pick_sheet(cells: DataFrame, name: str | None = None) -> DataFrame:
    """One sheet of a cell grid -- by name (error if absent) or the first sheet."""
    if name is not None:
        if cells.where(F.col("sheet") == name).isEmpty():
            raise ValueError(f"sheet {name!r} not found")
        return cells.where(F.col("sheet") == name)
    if "sheet_idx" not in cells.columns:
        raise ValueError("picking the first sheet needs a sheet_idx column")
    # scalar subquery: the smallest sheet index, evaluated once by Spark
    return cells.where(F.col("sheet_idx") == cells.agg(F.min("sheet_idx")).scalar())


# Spark's conditions for a folder that does not exist, or holds no file yet
NO_TABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def previous_output_columns(spark: SparkSession, path: str) -> list[str] | None:
    """Column names of the previous output (schema only, no job); None if there is none."""
    try:
        return spark.read.parquet(path).columns or None
    except AnalysisException as e:
        if e.getCondition() in NO_TABLE:  # there is no previous output yet
            return None
        raise
