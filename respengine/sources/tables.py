"""Observation frames over Spark tables.

Any table becomes an observation frame given a row key, a label expression
and a list of categorical feature expressions (numbered by position). The
three views below stand in for the reference's click log on the driver's
parquet tables; only the needed columns reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import feature_array
from .rows import with_content_ids


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a folder (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_observations(df: DataFrame, row_id: Column, label: Column,
                       features: list[Column]) -> DataFrame:
    """``(row_id, label, feats)`` from any frame; features keep ``''`` as a category."""
    return df.select(row_id.cast("bigint").alias("row_id"),
                     label.cast("double").alias("label"),
                     feature_array(features).alias("feats"))


def ctr_event_features() -> list[Column]:
    """hour, ISO weekday, user, k from props, value band ('' below 5)."""
    return [
        F.hour("ts").cast("string"),
        (F.weekday("ts") + 1).cast("string"),
        F.col("user_id").cast("string"),
        F.get_json_object("props", "$.k"),
        F.when(F.col("value") < 5.0, F.lit(""))
         .otherwise(F.floor(F.col("value") / 10).cast("int").cast("string")),
    ]


def ctr_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click observations over ``events``: label = event_type is 'click'."""
    ev = read_table(spark, sf_dir, "events")
    return table_observations(
        ev, F.col("event_id"),
        F.when(F.col("event_type") == "click", 1).otherwise(0),
        ctr_event_features())


def doc_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second labelled set: documents with a quality label.

    Features: lang, source, toxic flag, number of digits of the length.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    joined = labels.join(docs, "doc_id", "inner")
    return table_observations(
        joined, F.col("doc_id"), F.col("quality"),
        [F.col("lang"), F.col("source"), F.col("toxic").cast("string"),
         F.length(F.col("n_chars").cast("string")).cast("string")])


def lineitem_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wider labelled set over ``lineitem``: label = returned ('R').

    Features: line number, quantity, discount and tax in percent, ship year,
    ship month, supplier, part. The table has no unique key (order and line
    number repeat), so the row id comes from the observation itself and its
    place among equal ones.
    """
    li = read_table(spark, sf_dir, "lineitem")
    obs = table_observations(
        li, F.lit(0), F.when(F.col("l_returnflag") == "R", 1).otherwise(0),
        [F.col("l_linenumber").cast("string"),
         F.col("l_quantity").cast("int").cast("string"),
         F.round(F.col("l_discount") * 100).cast("int").cast("string"),
         F.round(F.col("l_tax") * 100).cast("int").cast("string"),
         F.year("l_shipdate").cast("string"),
         F.month("l_shipdate").cast("string"),
         F.col("l_suppkey").cast("string"),
         F.col("l_partkey").cast("string")]).drop("row_id")
    content = F.concat_ws("|", F.col("label").cast("int").cast("string"),
                          F.transform("feats", lambda f: f["category"]))
    return with_content_ids(obs, content)
