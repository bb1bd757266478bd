"""An extension beyond the batch operators: the same rules on streams of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions.redaction import redact
from loomline.functions.text import normalize_question


def redacted(stream: DataFrame, text_col: str) -> DataFrame:
    """A stream with a text column redacted; rows are independent, so nothing is kept between batches."""
    return stream.withColumn(text_col, redact(F.col(text_col)))


def gated(stream: DataFrame, least: float, coverage_col: str = "coverage") -> DataFrame:
    """Rows that pass the coverage gate; no coverage passes."""
    return stream.where(F.col(coverage_col).isNull() | (F.col(coverage_col) >= least))


def first_by_text(stream: DataFrame, text_col: str, time_col: str, within: str) -> DataFrame:
    """Each normalised text once within a watermark; what is kept is bounded by it."""
    keyed = stream.withWatermark(time_col, within).withColumn("_key", F.md5(normalize_question(F.coalesce(F.col(text_col), F.lit("")))))
    return keyed.dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def windowed_effects(stream: DataFrame, time_col: str, kind_col: str, size: str, within: str) -> DataFrame:
    """(start, kind, n): rows by kind in tumbling windows, as far as the watermark has closed them."""
    windows = stream.withWatermark(time_col, within).groupBy(F.window(time_col, size), F.col(kind_col).alias("kind")).agg(
        F.count("*").alias("n")
    )
    return windows.select(F.col("window.start").alias("start"), "kind", "n")
