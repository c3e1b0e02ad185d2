"""Keys of state that may be null.

The pandas form of Spark's stateful operator mixes up the state of keys that hold nulls.  So each key
goes as two columns without any: its value, or a filler of its type, and whether it is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.functions.times import column_type


def names(keys: Sequence[str]) -> list[str]:
    """The columns that stand for the keys."""
    return [name for k in range(len(keys)) for name in (f"key{k}", f"none{k}")]


def filled(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The keys as those columns; keys are of a plain type."""
    out = []
    for k, key in enumerate(keys):
        of = column_type(df, key)
        filler = F.lit("1970-01-01") if isinstance(of, T.DateType) else F.lit(0)
        out += [F.coalesce(key, filler.cast(of)).alias(f"key{k}"), F.col(key).isNull().alias(f"none{k}")]
    return out


def restored(keys: Sequence[str]) -> list[Column]:
    """The keys again."""
    return [F.when(~F.col(f"none{k}"), F.col(f"key{k}")).alias(key) for k, key in enumerate(keys)]
