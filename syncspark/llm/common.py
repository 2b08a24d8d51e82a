"""What the operators of this folder share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from syncspark.session import shared_folder, ship_package

SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = 1000


def body(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ready(spark: SparkSession) -> None:
    """Prepare for Python in tasks: the package is sent, and texts come a thousand at a time,
    as batches of ten thousand long ones would fill a worker's memory."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder all executors share."""
    return f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"


def numbered(docs: DataFrame, name: str = "_row") -> DataFrame:
    """Rows with a number of their own. It is the id if all rows have one that no other has;
    if not, rows are written with numbers, so that all that reads them finds the same ones."""
    shared = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("doc_id is null or n > 1")
    if shared.isEmpty():
        return docs.withColumn(name, F.col("doc_id").cast("long"))
    return written(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")


def carried(docs: DataFrame) -> DataFrame:
    """Numbered rows (_row, doc_id, text, source) that carry all columns of ``docs`` in ``row``,
    where no name can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return numbered(docs.select("doc_id", "text", "source", row))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table in the folder all executors share and read it back.

    Cuts the lineage: what follows survives lost executors without computing the table
    again. The owner of ``spark.checkpoint.dir`` removes ``llm-*`` once results are stored.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
