"""Side outputs: one result frame with a ``tag`` column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def split_tags(df: DataFrame, tags: Sequence[str], tag: str = "tag") -> dict[str, DataFrame]:
    """One lazy frame per tag.  When several are written, cache or write ``df`` by tag instead."""
    return {value: df.where(df[tag] == value).drop(tag) for value in tags}


def write_by_tag(df: DataFrame, path: str, tag: str = "tag", mode: str = "overwrite") -> None:
    """All side outputs in one pass over the input, one folder per tag."""
    df.write.mode(mode).partitionBy(tag).parquet(path)
