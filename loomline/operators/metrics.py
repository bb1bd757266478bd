"""Metrics of a data set of question-answer rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.text import canon, estimate_tokens
from loomline.operators.traces import grounded
from loomline.operators.verify import coverage

LEAST_ANSWER_CHARS = 40


def stats(x: Column, prefix: str) -> list[Column]:
    """Mean, least, most, population deviation and count of a column; zeros for none."""
    zero = F.lit(0.0)
    return [
        F.coalesce(F.avg(x), zero).alias(f"{prefix}_mean"),
        F.coalesce(F.min(x), F.lit(0)).cast("double").alias(f"{prefix}_min"),
        F.coalesce(F.max(x), F.lit(0)).cast("double").alias(f"{prefix}_max"),
        F.coalesce(F.stddev_pop(x), zero).alias(f"{prefix}_stdev"),
        F.count(x).alias(f"{prefix}_n"),
    ]


def top_values(rows: DataFrame, array_col: str, most: int = 5, order_col: str = "ord") -> DataFrame:
    """(value, n): the most frequent items of an array column; of equally frequent ones, that which comes first."""
    items = rows.select(order_col, F.posexplode(array_col).alias("pos", "value"))
    counted = items.groupBy("value").agg(F.count("*").alias("n"), F.min(F.struct(order_col, "pos")).alias("first"))
    return counted.orderBy(F.desc("n"), "first").limit(most).select("value", "n")


def tool_diversity(rows: DataFrame) -> DataFrame:
    """One row: distinct_tools, total_steps and mean_steps_per_pair."""
    items = rows.select(F.explode("required_tools").alias("tool")).agg(
        F.countDistinct("tool").alias("distinct_tools"), F.count("*").alias("total_steps")
    )
    n = rows.agg(F.count("*").alias("n"))
    return items.join(n).select(
        "distinct_tools",
        "total_steps",
        F.when(F.col("n") > 0, F.col("total_steps") / F.col("n")).otherwise(0.0).alias("mean_steps_per_pair"),
    )


def parametric_flags(rows: DataFrame, context: str, least: int = LEAST_ANSWER_CHARS) -> DataFrame:
    """``rows`` with ``flagged``: whether the answer stands verbatim in the context, and so may need no tool."""
    answer = canon(F.coalesce("answer_draft", F.lit("")))
    known = canon(F.lit(context))
    return rows.withColumn("flagged", (F.length(answer) >= least) & F.lit(bool(context)) & F.contains(known, answer))


def evaluate(rows: DataFrame, entities: DataFrame | None = None, edges: DataFrame | None = None, context: str = "", keys: tuple[str, ...] = ("key",)) -> dict:
    """All metrics as one document. ``rows`` has ord, question, answer_draft, required_tools, chain, entity_refs and,
    where it was measured, verification."""
    names = F.array().cast("array<string>") if entities is None else F.col("_names")
    own = rows.withColumn("question_tokens", estimate_tokens(F.col("question"))).withColumn(
        "answer_tokens", estimate_tokens(F.col("answer_draft"))
    )
    if entities is not None:
        own = own.join(F.broadcast(entities.agg(F.collect_set("name").alias("_names"))))
    if edges is not None:
        own = own.drop("coverage").join(coverage(rows, edges, list(keys)), list(keys), "left")
    measured = "verification" in rows.columns
    flagged = parametric_flags(own, context)
    valid = F.avg(F.coalesce(F.col("verification.chain_valid"), F.lit(False)).cast("double")) if measured else F.lit(None).cast("double")
    found = flagged.agg(
        F.count("*").alias("n"),
        (F.coalesce(valid, F.lit(0.0)) if measured else valid).alias("fraction_chain_verified"),
        (F.avg("coverage") if edges is not None else F.lit(None).cast("double")).alias("mean_toolkg_coverage"),
        (F.count_if(F.col("coverage").isNull()) if edges is not None else F.lit(0).cast("long")).alias("toolkg_coverage_not_applicable"),
        F.coalesce(F.avg(grounded(F.col("entity_refs"), names, F.col("question")).cast("double")), F.lit(0.0)).alias(
            "entity_grounding_rate"
        ),
        F.count_if("flagged").alias("flagged"),
        *stats(F.col("question_tokens"), "question_tokens"),
        *stats(F.col("answer_tokens"), "answer_tokens"),
    )
    metrics = found.first().asDict()
    metrics["flagged_fraction"] = metrics["flagged"] / metrics["n"] if metrics["n"] else 0.0
    metrics["tool_diversity"] = tool_diversity(rows).first().asDict() | {
        "most_common": [(x["value"], x["n"]) for x in top_values(rows, "required_tools").collect()]
    }
    if not measured:
        metrics["verification_note"] = "rows carry no verification; chain validity not measured"
    if edges is None:
        metrics["coverage_note"] = "no composability graph given; coverage not measured"
    return metrics
