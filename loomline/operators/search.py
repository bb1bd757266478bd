"""Keyword search over articles, and how far two judges of the same rows agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomline.functions.text import clipped

SNIPPET_CHARS = 220


def words(text: Column) -> Column:
    """Distinct runs of a-z and 0-9 in a lower-case text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-z0-9]+)"), 1))


def relevance(query: Column, title: Column, hay: Column) -> Column:
    """Words of the query that the article has, those in its title twice, by one more than the query's words; arrays of
    distinct words. Zero for a query without words."""
    return (F.size(F.array_intersect(query, hay)) + F.size(F.array_intersect(query, title))) / (F.size(query) + 1)


def search(articles: DataFrame, queries: list[str], top_k: int = 5) -> DataFrame:
    """(query, place, article_id, title, category, score, snippet): the best articles of each query, at least one,
    ties by id; articles that share no word are none. ``articles`` has article_id, title, body, tags, category.

    The queries are given, so each article meets all of them where it is, and only the best of each task move on.
    """
    hay = words(F.concat_ws(" ", "title", "body", "tags"))
    ready = articles.select(
        "article_id",
        "title",
        "category",
        clipped(F.coalesce("body", F.lit("")), SNIPPET_CHARS).alias("snippet"),
        words(F.col("title")).alias("_title"),
        hay.alias("_hay"),
    )
    asked = F.array(*(F.struct(F.lit(q).alias("query"), words(F.lit(q)).alias("words")) for q in queries))
    met = ready.withColumn("_q", F.explode(asked))
    scored = met.withColumn("score", relevance(F.col("_q.words"), F.col("_title"), F.col("_hay"))).where("score > 0")
    place = F.row_number().over(Window.partitionBy("_q.query").orderBy(F.desc("score"), "article_id"))
    best = scored.withColumn("place", place).where(F.col("place") <= max(1, top_k))
    return best.select("_q.query", "place", "article_id", "title", "category", "score", "snippet")


def agreement(judged: DataFrame) -> DataFrame:
    """One row on ``judged`` (first, second: verdicts; runs: probabilities by repeat; latency_ms): how many agree, what each
    accepts, how the probabilities spread and flip over the repeats, and the upper median and greatest latency."""
    runs = F.filter("runs", lambda x: x.isNotNull())
    spread = F.when((F.col("first") == "accept") & (F.size(runs) > 0), F.array_max(runs) - F.array_min(runs))
    flips = F.when(F.col("first") == "accept", F.size(F.filter(runs, lambda x: (x >= 0.5) != (F.get(runs, F.lit(0)) >= 0.5)))).otherwise(0)
    n = F.count("*")
    found = judged.agg(
        n.alias("n"), F.round(F.avg((F.col("first") == F.col("second")).cast("double")), 4).alias("agreement"),
        F.count_if(F.col("first") == "accept").alias("first_accepts"), F.count_if(F.col("second") == "accept").alias("second_accepts"),
        F.round(F.coalesce(F.avg(spread), F.lit(0.0)), 3).alias("mean_spread"), F.coalesce(F.sum(flips), F.lit(0)).cast("long").alias("flips"), F.max("latency_ms").alias(
            "latency_max"
        ),
    )
    # the upper median: the value at place n div 2 from 0 on
    upper = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY latency_ms DESC)").cast(judged.schema["latency_ms"].dataType)
    return found.join(judged.agg(upper.alias("latency_p50")))
