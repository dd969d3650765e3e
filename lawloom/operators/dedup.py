"""Removing repeats: first row of equal rows, distinct values in first-seen order."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, columns: list[str], pos: str) -> DataFrame:
    """The first row, by `pos`, of every group of rows equal in `columns`.

    Copies collapse before the shuffle: only one row per group and task is sent. When all other
    columns belong to the group, the smallest position is all that has to be kept.
    """
    rest = [c for c in df.columns if c not in columns and c != pos]
    if not rest:
        return df.groupBy(*columns).agg(F.min(pos).alias(pos)).select(*df.columns)
    first = df.groupBy(*columns).agg(F.min(pos).alias(pos), F.min_by(F.struct(*rest), pos).alias("_rest"))
    return first.select(*columns, pos, *[F.col(f"_rest.`{c}`").alias(c) for c in rest]).select(*df.columns)


def distinct_in_order(df: DataFrame, column: str, pos: str) -> DataFrame:
    """(value, first position) of every distinct value."""
    return df.groupBy(column).agg(F.min(pos).alias(pos))
