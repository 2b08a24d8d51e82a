"""Which spaces a source covers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from syncspark.functions.text import parse_csv
from syncspark.operators.joins import keyed_join


def csv_spaces(spark: SparkSession, text: str | None) -> DataFrame:
    """Keys of a comma list of the configuration."""
    return spark.range(1).select(F.explode(parse_csv(F.lit(text))).alias("space_key"))


def select_spaces(listed: DataFrame, indexed_csv: str | None = None, excluded_csv: str | None = None) -> DataFrame:
    """A configured list wins as it is; else the listed spaces without the excluded ones."""
    spark = listed.sparkSession
    if indexed_csv is not None and indexed_csv.replace(",", "").strip():
        return csv_spaces(spark, indexed_csv)
    if excluded_csv is None or not excluded_csv.replace(",", "").strip():
        return listed.select("space_key")
    return keyed_join(listed.select("space_key"), csv_spaces(spark, excluded_csv).distinct(), ["space_key"], "left_anti")
