"""Click-fraud filter: at most ``limit`` clicks per key and local day pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eddyline.functions.times import SECOND, bucket, local_day, micros
from eddyline.operators.timeline import BUCKET, running

DEFAULT_LIMIT = 100
HOUR = 3_600 * SECOND


def click_filter(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    """Tag clicks: the first ``limit`` of a key's local day ``pass``, the next one is ``warning``.

    Later ones are dropped, as the filter is meant to do.  The row-number limit lets every map
    task keep only ``limit + 1`` rows per key and day, so a bot's clicks are cut before the
    shuffle.  Limits beyond what Spark cuts map-side are counted hour by hour instead.
    """
    dated = df.withColumn("_day", local_day(micros(ts)))
    order = [F.col(ts), F.col(tie)]
    cut = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if limit + 1 <= cut:
        numbered = dated.withColumn(
            "_n", F.row_number().over(Window.partitionBy(*keys, "_day").orderBy(*order))
        )
    else:
        numbered = running(
            dated.withColumn(BUCKET, bucket(micros(ts), HOUR)),
            [*keys, "_day"], BUCKET, order, {"_n": F.lit(1)}, F.sum,
        ).drop(BUCKET)
    return (
        numbered.where(F.col("_n") <= limit + 1)
        .withColumn("tag", F.when(F.col("_n") <= limit, "pass").otherwise("warning"))
        .drop("_n", "_day")
    )


def passed(tagged: DataFrame) -> DataFrame:
    return tagged.where("tag = 'pass'").drop("tag")


def warnings(tagged: DataFrame, keys: Sequence[str], message: str = "warning") -> DataFrame:
    return tagged.where("tag = 'warning'").select(*keys, F.lit(message).alias("warning_msg"))
