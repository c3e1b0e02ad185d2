"""Top-N per window, its change rows and its text report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.functions.times import stamp_text


def top_n_per_window(
    counts: DataFrame,
    n: int,
    key: str,
    cnt: str = "cnt",
    window_end: str = "window_end",
    rank: str = "rk",
) -> DataFrame:
    """The ``n`` largest counts of every window; equal counts in ascending key order.

    Filtering the row number right above the window lets Spark keep only ``n`` rows per window
    in every map task, so a window with very many keys never meets in one task.
    """
    order = Window.partitionBy(window_end).orderBy(F.desc(cnt), F.asc(key))
    ranked = counts.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= n)
    return ranked.withColumn(rank, F.col(rank).cast("long"))


def top_n_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Change rows that turn one ranked table into another: ``-`` withdraws, ``+`` adds.

    Both frames hold at most N rows per window, with the same columns.
    """
    columns = after.columns
    tagged = before.select(*columns, F.lit(-1).alias("_d")).unionByName(
        after.select(*columns, F.lit(1).alias("_d"))
    )
    net = tagged.groupBy(*columns).agg(F.sum("_d").alias("_d")).where("_d <> 0")
    return net.select(*columns, F.when(F.col("_d") > 0, "+").otherwise("-").alias("op"))


# The wording of the ranked report.
REPORT_RULE = "=============================="
REPORT_HEAD = "窗口结束时间："
REPORT_LABELS = {"item": (" ItemId=", " 商品热度="), "url": (" Url ", " Url热度=")}


def report(
    ranked: DataFrame,
    key: str,
    labels: tuple[str, str],
    head: Column | None = None,
    cnt: str = "cnt",
    window_end: str = "window_end",
    rank: str = "rk",
) -> DataFrame:
    """One text block per window over a Top-N result (so at most N lines are collected)."""
    entry = F.struct(F.col(rank).alias("rk"), F.col(key).cast("string").alias("key"), F.col(cnt).alias("cnt"))
    line = lambda e: F.concat(
        F.lit("TOP "), e["rk"].cast("string"), F.lit(labels[0]), e["key"],
        F.lit(labels[1]), e["cnt"].cast("string"),
    )
    lines = F.transform(F.array_sort(F.collect_list(entry)), line)
    head = stamp_text(F.col(window_end)) if head is None else head
    return ranked.groupBy(window_end).agg(lines.alias("_lines")).select(
        window_end,
        F.concat_ws(
            "\n",
            F.lit(REPORT_RULE),
            F.concat(F.lit(REPORT_HEAD), head),
            F.concat_ws("\n", "_lines"),
            F.lit(REPORT_RULE),
        ).alias("report"),
    )


def hot_items_sql_text(
    view: str, item: str, behavior: str, ts: str, size: str, slide: str
) -> str:
    """The Top-N question as one Spark SQL statement over a view.

    Its parameters are ``:wanted``, the behavior, and ``:n``.
    """
    return f"""
        SELECT {item} AS item_id, cnt, window_end, rk FROM (
          SELECT {item}, cnt, window_end,
                 CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, {item}) AS BIGINT) AS rk
          FROM (
            SELECT {item}, w.end AS window_end, count({item}) AS cnt
            FROM (SELECT {item}, window({ts}, '{size}', '{slide}') AS w
                  FROM {view} WHERE {behavior} = :wanted)
            GROUP BY {item}, w
          )
        ) WHERE rk <= :n
    """
