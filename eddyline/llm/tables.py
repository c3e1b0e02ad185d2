"""Reading the tables, and the rows that a model may learn from."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.session import new_folder

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives the executors' Python workers this package, once per application.

    Their path is not the driver's.  The archive goes through the shared folder.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, str(file.relative_to(root.parent)))
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{new_folder(spark, 'code')}/eddyline.zip")
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = files.create(where)
    stream.write(bytearray(archive.getvalue()))
    stream.close()
    context.addPyFile(files.makeQualified(where).toString())
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds, F.lit(0))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and there for any executor."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _chosen(rows: DataFrame, share: float, *by: str) -> DataFrame:
    return rows.where(F.pmod(F.xxhash64(*by), F.lit(1 << 30)) < int(share * (1 << 30)))


def training_labels(labels: DataFrame, label: str, held_out: Column, most: int) -> DataFrame:
    """``doc_id, label``: distinct 0/1 labels outside the held-out fold, at most about ``most``.

    A hash of the id chooses them, so the same rows are chosen each time.  The result is bounded and
    may be broadcast.
    """
    usable = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out)
        .distinct()
    )
    share = min(1.0, most / max(usable.count(), 1))
    return _chosen(usable, share, "doc_id")


def _chosen(rows: DataFrame, share: float, *by: str) -> DataFrame:
    return rows.where(F.pmod(F.xxhash64(*by), F.lit(1 << 30)) < int(share * (1 << 30)))


def training_labels(labels: DataFrame, label: str, held_out: Column, most: int) -> DataFrame:
    """``doc_id, label``: distinct 0/1 labels outside the held-out fold, at most about ``most``.

    A hash of the id chooses them, so the same rows are chosen each time.  The result is bounded and
    may be broadcast.
    """
    usable = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out)
        .distinct()
    )
    share = min(1.0, most / max(usable.count(), 1))
    return _chosen(usable, share, "doc_id")


#: Tasks that work on the training rows.
TRAINING_PARTS = 32


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, held_out: Column, most: int
) -> DataFrame:
    """``doc_id, label, text`` of the chosen labelled rows, each once, at most about ``most``.

    A doc_id with several texts gives a row for each; a hash of both chooses among the rows where that
    makes them more than ``most``.  The rows are a written table, so that learning reads the documents
    once; nothing is shuffled unless rows repeat.
    """
    chosen = training_labels(labels, label, held_out, most)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = written(rows.select("doc_id", "label", "text"), "training-rows")
    keys = rows.select("doc_id", "label", F.xxhash64("text").alias("key"))
    n = keys.count()
    once = keys.distinct().count()
    if once < n:
        rows = rows.dropDuplicates()
    if once > most:
        rows = _chosen(rows, most / once, "doc_id", "text")
    return rows if once == n else written(rows, "training-rows")
