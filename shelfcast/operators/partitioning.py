"""Partitioning of Python-bound work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hash partitioning by key that keeps its partition count.

    Rows are few but each group costs Python time, so partitions must not be merged by size. Their
    number is ``spark.sql.shuffle.partitions``.
    """
    if not keys:
        return df
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
