"""Which tools compose: an output of one that fits an input of the other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.text import name_tokens, normalize_type, types_compatible

# Threshold, bonus, tokens that say nothing alone, and outputs that a description suggests (in order).
THRESHOLD = 0.34
TYPE_BONUS = 0.15
GENERIC = (
    "id",
    "ids",
    "title",
    "name",
    "names",
    "status",
    "state",
    "type",
    "kind",
    "description",
    "desc",
    "info",
    "data",
    "value",
    "result",
    "results",
    "item",
    "items",
    "list",
    "count",
    "total",
    "summary",
)
SUGGESTED_OUTPUTS = (
    (("path", "filepath", "file"), "path", "path"),
    (("directory", "folder"), "path", "path"),
    (("content", "text", "body"), "content", "content"),
    (("list", "listing"), "listing", "array"),
    (("tree",), "tree", "object"),
    (("metadata", "info", "information", "detail", "summary"), "metadata", "object"),
)

PROPS = "array<struct<name:string,type:string>>"


def suggested_outputs(description: Column) -> Column:
    """Outputs by the words of a description; of several of one name, the first."""
    tokens = name_tokens(F.coalesce(description, F.lit("")))
    rules = [
        F.when(F.arrays_overlap(tokens, F.array(*map(F.lit, words))), F.struct(F.lit(name).alias("name"), F.lit(kind).alias("type"))) for words, name, kind in SUGGESTED_OUTPUTS
    ]
    return F.array_distinct(F.filter(F.array(*rules), lambda x: x.isNotNull())).cast(PROPS)


def input_properties(schema: Column) -> Column:
    """(name, type, description) of the properties of a JSON schema, in document order; empty where there are none."""
    properties = F.get_json_object(schema, "$.properties")
    keys = F.coalesce(F.json_object_keys(properties), F.array().cast("array<string>"))

    def prop(key: Column) -> Column:
        spec = F.call_function("get_json_object", properties, F.concat(F.lit("$['"), key, F.lit("']")))
        of = lambda field: F.when(spec.startswith("{"), F.get_json_object(spec, f"$.{field}"))
        return F.struct(
            key.alias("name"), normalize_type(of("type")).alias("type"), F.coalesce(of("description"), F.lit("")).alias("description")
        )

    return F.transform(keys, prop)


def normalize_tools(catalog: DataFrame, hints: DataFrame | None = None) -> DataFrame:
    """(tool, description, inputs, outputs) from ``catalog`` (name, description, input_schema: JSON).

    ``hints`` (tool, pos, output_prop, output_type) say what tools return and go before what descriptions suggest.
    """
    tools = catalog.select(
        F.coalesce(F.nullif("name", F.lit("")), F.lit("unknown_tool")).alias("tool"),
        F.coalesce("description", F.lit("")).alias("description"),
        input_properties(F.col("input_schema")).alias("inputs"),
        suggested_outputs(F.col("description")).alias("suggested"),
    )
    if hints is None:
        return tools.withColumnRenamed("suggested", "outputs")
    prop = F.struct("pos", F.col("output_prop").alias("name"), normalize_type(F.col("output_type")).alias("type"))
    known = hints.groupBy("tool").agg(F.array_sort(F.collect_list(prop)).alias("hinted"))
    named = F.transform("hinted", lambda x: F.struct(x["name"].alias("name"), x["type"].alias("type"))).cast(PROPS)
    return tools.join(known, "tool", "left").select("tool", "description", "inputs", F.coalesce(named, "suggested").alias("outputs"))


def pair_scores(given: DataFrame, wanted: DataFrame) -> DataFrame:
    """(src, dst, out_pos, out_name, in_pos, in_name, score) of property pairs that share a token.

    ``given`` and ``wanted`` have (tool, pos, name, type). A pair without a shared token scores zero, so the pairs
    come from an equi-join on tokens instead of from all properties with all others.
    """

    def tokens(df: DataFrame, prefix: str) -> DataFrame:
        own = df.select(
            F.col("tool").alias(prefix),
            F.col("pos").alias(f"{prefix}_pos"),
            F.col("name").alias(f"{prefix}_name"),
            F.col("type").alias(f"{prefix}_type"),
            name_tokens(F.col("name")).alias("tokens"),
        )
        return own.select("*", F.size("tokens").alias(f"{prefix}_n"), F.explode("tokens").alias("token")).drop("tokens")

    met = tokens(given, "src").join(tokens(wanted, "dst"), "token").where("src <> dst")
    keys = [f"{p}{x}" for p in ("src", "dst") for x in ("", "_pos", "_name", "_type", "_n")]
    shared = met.groupBy(*keys).agg(F.count("*").alias("shared"), F.every(F.col("token").isin(*GENERIC)).alias("generic"))
    plain = 2.0 * F.col("shared") / (F.col("src_n") + F.col("dst_n"))
    fits = types_compatible(F.col("src_type"), F.col("dst_type"))
    score = F.when(F.col("generic"), plain * 0.5).when(fits, F.least(F.lit(1.0), plain + TYPE_BONUS)).otherwise(plain)
    return shared.select(
        "src",
        "dst",
        F.col("src_pos").alias("out_pos"),
        F.col("src_name").alias("out_name"),
        F.col("dst_pos").alias("in_pos"),
        F.col("dst_name").alias("in_name"),
        score.alias("score"),
    )


def composability_edges(tools: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(src, dst, relation, score, via): the best pair of each two tools, if it reaches the threshold before rounding.

    Of equally good pairs the one of the first output, then of the first input.
    """
    given = tools.select("tool", F.posexplode("outputs").alias("pos", "p")).select("tool", "pos", "p.name", "p.type")
    wanted = tools.select("tool", F.posexplode("inputs").alias("pos", "p")).select("tool", "pos", "p.name", "p.type")
    order = F.struct("score", -F.col("out_pos"), -F.col("in_pos"))
    via = F.concat_ws("->", "out_name", "in_name")
    best = pair_scores(given, wanted).groupBy("src", "dst").agg(F.max("score").alias("score"), F.max_by(via, order).alias("via"))
    return best.where(F.col("score") >= threshold).select(
        "src", "dst", F.lit("composable").alias("relation"), F.round("score", 3).alias("score"), "via"
    )


def graph_stats(nodes: DataFrame, edges: DataFrame, node_col: str = "tool") -> DataFrame:
    """One row: num_tools, num_edges, density, avg_out_degree and isolated (sorted names)."""
    linked = edges.select(F.col("src").alias(node_col)).union(edges.select("dst"))
    alone = nodes.select(node_col).join(linked, node_col, "left_anti").agg(F.array_sort(F.collect_list(node_col)).alias("isolated"))
    counts = nodes.agg(F.count("*").alias("num_tools")).join(edges.agg(F.count("*").alias("num_edges")))
    n, m = F.col("num_tools"), F.col("num_edges")
    return counts.join(alone).select(
        "num_tools",
        "num_edges",
        F.when(n > 1, F.round(m / (n * (n - 1)), 3)).otherwise(0.0).alias("density"),
        F.when(n > 0, F.round(m / n, 2)).otherwise(0.0).alias("avg_out_degree"),
        "isolated",
    )


def neighborhood_density(edges: DataFrame, groups: DataFrame) -> DataFrame:
    """(group, n, density): mean score over the ordered pairs of each group's tools (group, tool); zero below two."""
    members = groups.select("group", "tool").distinct()
    sizes = members.groupBy("group").agg(F.count("*").alias("n"))
    a, b = members.withColumnRenamed("tool", "src"), members.withColumnRenamed("tool", "dst")
    sums = edges.where("src <> dst").join(a, "src").join(b, ["group", "dst"]).groupBy("group").agg(F.sum("score").alias("total"))
    n = F.col("n")
    return sizes.join(sums, "group", "left").select(
        "group", "n", F.when(n < 2, 0.0).otherwise(F.coalesce("total", F.lit(0.0)) / (n * (n - 1))).alias("density")
    )
