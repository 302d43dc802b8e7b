"""Driver-side column-name resolution.

These work on ``DataFrame.columns`` only -- schema metadata, never data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm_name_py


def pick_column(columns: list[str], candidates: list[str], normalise: bool = False) -> str | None:
    """H7: first candidate present in ``columns`` (optionally after H6 normalisation)."""
    if normalise:
        by_norm = {}
        for c in columns:
            by_norm.setdefault(norm_name_py(c), c)
        for cand in candidates:
            hit = by_norm.get(norm_name_py(cand))
            if hit is not None:
                return hit
        return None
    present = set(columns)
    return next((c for c in candidates if c in present), None)


def spelled(columns: list[str], name: str) -> str | None:
    """The column that equals ``name`` apart from case."""
    return next((c for c in columns if c.lower() == name.lower()), None)


def shared_column(left: list[str], right: list[str], candidates: list[str]) -> tuple[str, str] | None:
    """How both sides spell the first candidate that both have."""
    both = ((spelled(left, name), spelled(right, name)) for name in candidates)
    return next((pair for pair in both if None not in pair), None)


def clean_names(df: DataFrame) -> DataFrame:
    """H8: column names stripped and made text."""
    return df.toDF(*[str(c).strip() for c in df.columns])


def drop_unnamed(df: DataFrame) -> DataFrame:
    """H5 (always variant): drop columns whose name starts with 'Unnamed'."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not str(c).startswith("Unnamed")])


def align_to(df: DataFrame, template: list[str], types: dict[str, str] | None = None) -> DataFrame:
    """H9: template columns first (missing ones as null), then the remaining columns."""
    types = types or {}
    have = set(df.columns)
    head = [F.col(f"`{c}`") if c in have else F.lit(None).cast(types.get(c, "string")).alias(c)
            for c in template]
    rest = [F.col(f"`{c}`") for c in df.columns if c not in set(template)]
    return df.select(*head, *rest)


def require_columns(df: DataFrame, names: list[str], side: str = "") -> None:
    """Raise when a required column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{side + ': ' if side else ''}missing columns {missing}")


def drop_empty_unnamed(df: DataFrame) -> DataFrame:
    """H5 (only-if-empty variant): drop 'Unnamed*' columns that hold no value at all.

    Emptiness of all such columns is measured in one aggregate (a single row reaches the
    driver); the remaining columns are selected without touching the data again.
    """
    unnamed = [c for c in df.columns if str(c).startswith("Unnamed")]
    if not unnamed:
        return df
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(unnamed)]).first()
    empty = {c for i, c in enumerate(unnamed) if counts[f"c{i}"] == 0}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in empty])
