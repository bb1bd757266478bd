"""Credentials in emitted files: any finding fails a release."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# What is looked for, by kind.
KINDS = (
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    ("aws_access_key", r"AKIA[0-9A-Z]{16}"),
    ("api_key", r"sk-[A-Za-z0-9_-]{20,}"),
    ("bearer_token", r"(?i)bearer\s+[A-Za-z0-9._~+/-]{16,}"),
    ("assigned_credential", r"(?i)(api[_-]?key|secret|token|password)['\"]?\s*[:=]\s*['\"]?[A-Za-z0-9_.-]{12,}"),
)


def findings(texts: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """(path, line_no, kind) of each line that holds a credential; a line may have several kinds."""
    lines = texts.where(F.col(text_col).rlike("|".join(f"(?:{p})" for _, p in KINDS)))
    split = lines.select(F.col(path_col).alias("path"), F.posexplode(F.split(text_col, "\n")).alias("pos", "line"))
    kinds = F.filter(F.array(*(F.when(F.col("line").rlike(p), kind) for kind, p in KINDS)), lambda x: x.isNotNull())
    return split.select("path", (F.col("pos") + 1).cast("long").alias("line_no"), F.explode(kinds).alias("kind"))


def scan_files(spark, folder: str) -> DataFrame:
    """Findings in the text files of a folder, those below it included; files and lines of any length, line by line.

    Spark reads a file in blocks, and a line's place in its block comes with the row: so the lines of each block are
    counted, and only those with a finding are kept. Parquet files are left out, as they are no text.
    """
    files = spark.read.option("recursiveFileLookup", True).text(folder).where(~F.col("_metadata.file_name").endswith(".parquet"))
    kinds = F.filter(F.array(*(F.when(F.col("value").rlike(p), kind) for kind, p in KINDS)), lambda x: x.isNotNull())
    lines = files.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), kinds.alias("kinds")
    )
    blocks = lines.groupBy("path", "block").agg(
        F.count("*").alias("n"),
        F.min("id").alias("first"),
        F.collect_list(F.when(F.size("kinds") > 0, F.struct("id", "kinds"))).alias("found"),
    )
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    told = blocks.withColumn("before", before).select("path", "before", "first", F.explode("found").alias("x"))
    number = F.col("before") + F.col("x.id") - F.col("first") + 1
    return told.select("path", number.cast("long").alias("line_no"), F.explode("x.kinds").alias("kind"))
