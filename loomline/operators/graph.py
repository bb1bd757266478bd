"""Property graphs: merging, degrees, ranking, components and the budget of an exported context."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomline.functions.text import first_filled, truncate
from loomline.session import cut

# Attributes by which a node or an edge is named, in the order in which they are tried.
NAME_KEYS = ("entity_name", "name", "id")
TYPE_KEYS = ("entity_type", "type")
DESCRIPTION_KEYS = ("description", "desc", "summary")
RELATION_KEYS = ("relation", "relationship", "edge_type", "relation_type", "type")


@dataclass(frozen=True)
class ExportConfig:
    """Caps of an exported context; ``max_tokens`` is a budget that is met by dropping what ranks last."""

    max_entities: int = 40
    max_triples: int = 60
    max_communities: int = 8
    max_tokens: int = 2000
    max_desc_chars: int = 300
    community_min_size: int = 2
    members: int = 8


def merge_entities(entities: DataFrame) -> DataFrame:
    """(id, entity_name, entity_type, description) from (ord, name, type, description): one row for each trimmed name.

    The longest description stays, the first of equally long ones; an empty first one counts as the name. Types are
    the sorted distinct ones, joined by +. A blank name is an error.
    """
    name = F.trim("name")
    checked = F.when(F.coalesce(name, F.lit("")) == "", F.raise_error(F.lit("entity with empty name"))).otherwise(name)
    rows = entities.select("ord", checked.cast("string").alias("id"), "type", F.coalesce("description", F.lit("")).alias("description"))
    order = F.struct(F.length("description"), -F.col("ord"))
    merged = rows.groupBy("id").agg(
        F.array_sort(F.collect_set(F.nullif("type", F.lit("")))).alias("types"),
        F.max_by("description", order).alias("longest"),
        F.min_by("description", "ord").alias("first"),
    )
    # a name that stands in for an empty first description gives way to longer ones only
    kept = F.when(F.col("first") != "", F.col("longest")).when(F.length("longest") > F.length("id"), F.col("longest")).otherwise(
        F.col("id")
    )
    return merged.select("id", F.col("id").alias("entity_name"), F.array_join("types", "+").alias("entity_type"), kept.alias("description"))


def merge_relations(relations: DataFrame) -> DataFrame:
    """(src, dst, relation, description) from (ord, head, relation, tail, description): the first of each two nodes.

    Direction doesn't count; loops and blank relations go. A relation without a description is described by itself.
    """
    rows = relations.where((F.col("head") != F.col("tail")) & (F.trim("relation") != ""))
    described = first_filled(F.col("description"), F.concat_ws(" ", "head", "relation", "tail"))
    row = F.struct(
        "ord", F.col("head").alias("src"), F.col("tail").alias("dst"), F.trim("relation").alias("relation"), described.alias("description")
    )
    first = rows.groupBy(F.least("head", "tail").alias("a"), F.greatest("head", "tail").alias("b")).agg(F.min(row).alias("row"))
    return first.select("row.src", "row.dst", "row.relation", "row.description")


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, degree) of every node; a loop counts twice."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
    return nodes.select("id").join(ends, "id", "left").select("id", F.coalesce("degree", F.lit(0)).cast("long").alias("degree"))


def top_nodes(nodes: DataFrame, edges: DataFrame, most: int) -> DataFrame:
    """(rank, id, degree): the most connected nodes, ties by id."""
    best = degrees(nodes, edges).orderBy(F.desc("degree"), "id").limit(most)
    return best.select(F.row_number().over(Window.orderBy(F.desc("degree"), "id")).alias("rank"), "id", "degree")


def cap_entities(nodes: DataFrame, edges: DataFrame, most: int = 200) -> tuple[DataFrame, DataFrame]:
    """The graph that the ``most`` best connected nodes induce."""
    kept = cut(top_nodes(nodes, edges, most).select("id"))
    inner = edges.join(kept.withColumnRenamed("id", "src"), "src", "left_semi").join(
        kept.withColumnRenamed("id", "dst"), "dst", "left_semi"
    )
    return nodes.join(kept, "id", "left_semi"), inner.select(edges.columns)


def _attribute(df: DataFrame, keys: tuple[str, ...], default: Column | str = "") -> Column:
    found = [F.nullif(F.col(key).cast("string"), F.lit("")) for key in keys if key in df.columns]
    return F.coalesce(*found, default if isinstance(default, Column) else F.lit(default))


def ranked_entities(nodes: DataFrame, edges: DataFrame, config: ExportConfig = ExportConfig()) -> DataFrame:
    """(rank, name, entity_type, description, degree) of the best connected nodes."""
    best = top_nodes(nodes, edges, config.max_entities)
    return best.join(nodes, "id").select(
        "rank",
        _attribute(nodes, NAME_KEYS).alias("name"),
        _attribute(nodes, TYPE_KEYS, "UNKNOWN").alias("entity_type"),
        truncate(_attribute(nodes, DESCRIPTION_KEYS), config.max_desc_chars).alias("description"),
        "degree",
    )


def ranked_triples(nodes: DataFrame, edges: DataFrame, config: ExportConfig = ExportConfig()) -> DataFrame:
    """(rank, head, relation, tail, description) of the edges whose ends have the largest degrees together.

    An edge without a relation is named by its description.
    """
    own = degrees(nodes, edges)
    of = lambda end: own.select(F.col("id").alias(end), F.col("degree").alias(f"{end}_degree"))
    scored = edges.join(of("src"), "src").join(of("dst"), "dst").withColumn("weight", F.col("src_degree") + F.col("dst_degree"))
    order = [F.desc("weight"), F.col("src"), F.col("dst")]
    best = scored.orderBy(*order).limit(config.max_triples).withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    described = _attribute(edges, DESCRIPTION_KEYS)
    relation = first_filled(_attribute(edges, RELATION_KEYS), truncate(described, 80), default="related_to")
    named = best.select("rank", "src", "dst", relation.alias("relation"), truncate(described, config.max_desc_chars).alias("description"))
    name = nodes.select("id", _attribute(nodes, NAME_KEYS).alias("name"))
    heads = named.join(name.select(F.col("id").alias("src"), F.col("name").alias("head")), "src")
    return heads.join(name.select(F.col("id").alias("dst"), F.col("name").alias("tail")), "dst").select(
        "rank", "head", "relation", "tail", "description"
    )


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that can be reached, by label propagation with pointer jumping.

    Each round takes the least label around each node, then follows labels to their own; a round's result is written
    to the shared folder.
    """
    links = cut(edges.select("src", "dst").union(edges.select("dst", "src")).where("src <> dst").distinct())
    labels = cut(nodes.select("id", F.col("id").alias("component")))
    while True:
        around = links.join(labels, links["dst"] == labels["id"]).groupBy("src").agg(F.min("component").alias("around"))
        nearer = labels.join(around, labels["id"] == around["src"], "left").select(
            "id", F.least("component", F.coalesce("around", "component")).alias("component")
        )
        nearer = cut(nearer)
        jump = nearer.select(F.col("id").alias("component"), F.col("component").alias("farther"))
        now = cut(nearer.join(jump, "component", "left").select("id", F.coalesce("farther", "component").alias("component")))
        changed = now.join(labels.withColumnRenamed("component", "before"), "id").where("component <> before")
        if changed.isEmpty():
            return now
        labels = now


def communities(nodes: DataFrame, edges: DataFrame, config: ExportConfig = ExportConfig()) -> DataFrame:
    """(id, size, members, summary) of the largest components, ties by their smallest node; ids count from 0."""
    of = connected_components(nodes, edges)
    sizes = of.groupBy("component").agg(F.count("*").alias("size")).where(F.col("size") >= config.community_min_size)
    order = [F.desc("size"), F.col("component")]
    best = cut(sizes.orderBy(*order).limit(config.max_communities).withColumn("id", F.row_number().over(Window.orderBy(*order)) - 1))
    inside = of.withColumnRenamed("id", "node").join(best, "component").join(degrees(nodes, edges).withColumnRenamed("id", "node"), "node")
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("degree"), "node"))
    first = inside.withColumn("place", place).where(F.col("place") <= config.members)
    name = nodes.select(F.col("id").alias("node"), _attribute(nodes, NAME_KEYS).alias("name"))
    members = first.join(name, "node").groupBy("id", "size").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "name"))), lambda x: x["name"]).alias("members")
    )
    more = F.when(F.size("members") > 5, F.lit(", …")).otherwise(F.lit(""))
    summary = F.concat(
        F.lit("Topic cluster of "),
        F.col("size").cast("string"),
        F.lit(" entities, centered on "),
        F.array_join(F.slice("members", 1, 5), ", "),
        more,
        F.lit("."),
    )
    return members.select("id", "size", "members", summary.alias("summary"))


def entity_line(name: Column, kind: Column, description: Column) -> Column:
    return F.concat(
        F.lit("- "), name, F.lit(" ("), kind, F.lit(")"), F.when(description != "", F.concat(F.lit(": "), description)).otherwise("")
    )


def triple_line(head: Column, relation: Column, tail: Column, description: Column) -> Column:
    return F.concat(
        F.lit("- "),
        head,
        F.lit(" --"),
        relation,
        F.lit("--> "),
        tail,
        F.when(description != "", F.concat(F.lit(" — "), description)).otherwise(""),
    )


def community_line(id_: Column, size: Column, members: Column, summary: Column) -> Column:
    return F.concat(
        F.lit("- Cluster "),
        id_.cast("string"),
        F.lit(" ("),
        size.cast("string"),
        F.lit(" entities): "),
        F.array_join(members, ", "),
        F.lit(". "),
        summary,
    )


#: Characters of the three headings, of the blank lines between the sections and of the line ends around them.
HEADINGS = ("Domain entities:", "", "Key relationships:", "", "Topic clusters:")


def context_lines(entities: DataFrame, triples: DataFrame, clusters: DataFrame) -> DataFrame:
    """(section, rank, line): what the rendered context has besides its headings; sections 0, 1 and 2."""
    c = F.col
    first = entities.select(F.lit(0).alias("section"), "rank", entity_line(c("name"), c("entity_type"), c("description")).alias("line"))
    second = triples.select(
        F.lit(1).alias("section"), "rank", triple_line(c("head"), c("relation"), c("tail"), c("description")).alias("line")
    )
    third = clusters.select(
        F.lit(2).alias("section"), (c("id") + 1).alias("rank"), community_line(c("id"), c("size"), c("members"), c("summary")).alias("line")
    )
    return first.unionByName(second).unionByName(third)


def fit_budget(lines: DataFrame, max_tokens: int, fixed: int = sum(map(len, HEADINGS)) + len(HEADINGS) - 1) -> DataFrame:
    """The lines that stay within the budget: triples go first, then clusters, then entities but the first, from the end.

    The text is over the budget from 4 * (max_tokens + 1) characters on; a line counts with its line end. So a
    running sum over sections in the order of their worth shows where to stop. The lines are few: the caps bound them.
    """
    worth = F.when(F.col("section") == 0, 0).when(F.col("section") == 2, 1).otherwise(2)
    so_far = F.sum(F.length("line") + 1).over(Window.orderBy("worth", "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    fits = (so_far + fixed < 4 * (max_tokens + 1)) | ((F.col("section") == 0) & (F.col("rank") == 1))
    return lines.withColumn("worth", worth).withColumn("fits", fits).where("fits").select("section", "rank", "line")


def render(lines: DataFrame) -> DataFrame:
    """One row: the context as text."""
    titles = ("Domain entities:", "Key relationships:", "Topic clusters:")
    heads = lines.sparkSession.createDataFrame(
        [(k, 0, ("\n" if k else "") + title) for k, title in enumerate(titles)], "section int, rank int, line string"
    )
    every = lines.select("section", "rank", "line").unionByName(heads)
    ordered = F.array_sort(F.collect_list(F.struct("section", "rank", "line")))
    return every.agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("text"))


def export_context(nodes: DataFrame, edges: DataFrame, directed: bool = False, config: ExportConfig = ExportConfig()) -> dict:
    """The context as one document: ranked entities, triples and clusters within the budget, and what it left out.

    Its parts are bounded by the caps, so they come to the driver. If one entity alone is over the budget, the
    descriptions go and the summaries are cut to their sizes.
    """
    parts = [cut(ranked_entities(nodes, edges, config)), cut(ranked_triples(nodes, edges, config)), cut(communities(nodes, edges, config))]
    kept = fit_budget(context_lines(*parts), config.max_tokens).groupBy("section").count().collect()
    counts = {x["section"]: x["count"] for x in kept}
    rows = [[x.asDict() for x in part.orderBy(key).collect()] for part, key in zip(parts, ("rank", "rank", "id"), strict=True)]
    entities, triples, clusters = (part[: counts.get(k, 0)] for k, part in enumerate(rows))
    for x in entities + triples:
        del x["rank"]
    context = {"entities": entities, "triples": triples, "communities": clusters}
    if len(context_text(context)) >= 4 * (config.max_tokens + 1):
        for x in entities + triples:
            x["description"] = ""
        for x in clusters:
            x["summary"] = f"Topic cluster of {x['size']} entities."
    sizes = nodes.agg(F.count("*").alias("n")).join(edges.agg(F.count("*").alias("m"))).first()
    tokens = max(1, len(context_text(context)) // 4)
    context["meta"] = {
        "node_count": sizes["n"], "edge_count": sizes["m"], "directed": directed, "exported_entities": len(entities), "exported_triples": len(
            triples
        ),
        "exported_communities": len(clusters), "estimated_tokens": tokens, "max_tokens": config.max_tokens,
    }
    return context


def context_text(context: dict) -> str:
    """What ``render`` makes, of a document."""
    told = lambda x, mark: f"{mark}{x['description']}" if x.get("description") else ""
    sections = [
        ["Domain entities:", *(f"- {x['name']} ({x['entity_type']}){told(x, ': ')}" for x in context["entities"])],
        ["Key relationships:", *(f"- {x['head']} --{x['relation']}--> {x['tail']}{told(x, ' — ')}" for x in context["triples"])],
        [
            "Topic clusters:",
            *(f"- Cluster {x['id']} ({x['size']} entities): {', '.join(x['members'])}. {x['summary']}" for x in context["communities"]),
        ],
    ]
    return "\n\n".join("\n".join(x) for x in sections)


def tool_graph(catalog: DataFrame, max_entities: int = 200, max_params: int = 25) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a catalog (ord, name, description, input_schema): tools, their parameters, and shared parameters."""
    properties = F.get_json_object("input_schema", "$.properties")
    keys = F.slice(F.coalesce(F.json_object_keys(properties), F.array().cast("array<string>")), 1, max_params)
    required = F.coalesce(F.from_json(F.get_json_object("input_schema", "$.required"), "array<string>"), F.array().cast("array<string>"))
    tools = catalog.select(
        "ord",
        F.trim("name").alias("tool"),
        F.substring(F.coalesce("description", F.lit("")), 1, 500).alias("description"),
        properties.alias("properties"),
        keys.alias("keys"),
        required.alias("required"),
    )
    spec = F.call_function("get_json_object", "properties", F.concat(F.lit("$['"), F.col("param"), F.lit("']")))
    of = lambda field, default: F.coalesce(F.when(spec.startswith("{"), F.get_json_object(spec, f"$.{field}")), F.lit(default))
    params = cut(
        tools.select("ord", "tool", "properties", "required", F.posexplode("keys").alias("pos", "param")).select(
            "ord",
            "pos",
            "tool",
            "param",
            of("type", "string").alias("type"),
            F.substring(of("description", ""), 1, 300).alias("description"),
            F.array_contains("required", F.col("param")).alias("required"),
        )
    )
    place = F.col("ord") * (max_params + 1)
    node = F.concat_ws(".", "tool", "param")
    entities = tools.select(place.alias("ord"), F.col("tool").alias("name"), F.lit("tool").alias("type"), "description")
    entities = entities.unionByName(
        params.select((place + F.col("pos") + 1).alias("ord"), node.alias("name"), F.lit("parameter").alias("type"), "description")
    )
    takes = F.concat(
        F.col("tool"),
        F.lit(" takes parameter "),
        F.col("param"),
        F.lit(" ("),
        F.col("type"),
        F.lit(")"),
        F.when(F.col("required"), " [required]").otherwise(""),
    )
    owned = params.select(
        F.struct(F.lit(0).alias("a"), F.lit("").alias("b"), F.lit("").alias("c"), (place + F.col("pos")).alias("d")).alias("ord"),
        F.col("tool").alias("head"),
        F.lit("has_parameter").alias("relation"),
        node.alias("tail"),
        takes.alias("description"),
    )
    both = F.concat(F.lit("both take "), F.col("param"), F.lit(" ("), F.col("type"), F.lit(")"))
    shared = shared_parameters(params).select(
        F.struct(F.lit(1).alias("a"), F.col("param").alias("b"), F.col("type").alias("c"), F.lit(0).cast("long").alias("d")).alias("ord"),
        F.col("a").alias("head"),
        F.lit("shares_parameter_with").alias("relation"),
        F.col("b").alias("tail"),
        both.alias("description"),
    )
    return cap_entities(merge_entities(entities), merge_relations(owned.unionByName(shared)), max_entities)


def shared_parameters(params: DataFrame) -> DataFrame:
    """(a, b, param, type): tools a < b that take a parameter of the same name and type; ``params`` has (tool, param, type)."""
    own = params.select("tool", "param", "type").distinct()
    return own.withColumnRenamed("tool", "a").join(own.withColumnRenamed("tool", "b"), ["param", "type"]).where("a < b").select(
        "a", "b", "param", "type"
    )


def spec_graph(entities: DataFrame, relations: DataFrame, max_entities: int = 200) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of an explicit spec: entities (ord, name, type, description), relations (ord, head, relation, tail,
    description). Ends that no entity names become concepts; a relation without a part is an error."""
    broken = (F.coalesce(F.col("head"), F.lit("")) == "") | (F.coalesce(F.col("relation"), F.lit("")) == "") | (
        F.coalesce(F.col("tail"), F.lit("")) == ""
    )
    sound = relations.withColumn(
        "head", F.when(broken, F.raise_error(F.lit("relation needs head, relation and tail"))).otherwise(F.col("head")).cast("string")
    )
    given = entities.select(
        F.struct(F.lit(0).alias("k"), F.col("ord").cast("long").alias("n")).alias("place"),
        "name",
        F.coalesce("type", F.lit("concept")).alias("type"),
        F.substring(F.coalesce("description", F.lit("")), 1, 1000).alias("description"),
    )
    ends = sound.select("ord", F.posexplode(F.array("head", "tail")).alias("end", "name"))
    known = entities.select(F.trim("name").alias("name"))
    new = ends.join(known, "name", "left_anti").select(
        F.struct(F.lit(1).alias("k"), (F.col("ord") * 2 + F.col("end")).cast("long").alias("n")).alias("place"),
        "name",
        F.lit("concept").alias("type"),
        F.lit("").alias("description"),
    )
    every = given.unionByName(new)
    ordered = every.withColumn("ord", F.row_number().over(Window.partitionBy(F.trim("name")).orderBy("place")))
    linked = sound.select(
        "ord", F.col("head"), "relation", "tail", F.substring(F.coalesce("description", F.lit("")), 1, 500).alias("description")
    )
    return cap_entities(merge_entities(ordered.drop("place")), merge_relations(linked), max_entities)


def union_graphs(first: tuple[DataFrame, DataFrame], second: tuple[DataFrame, DataFrame], max_entities: int = 200) -> tuple[
    DataFrame, DataFrame
]:
    """Two graphs as one: the second's nodes and edges are added to the first's."""
    nodes = [
        g[0].select(F.lit(k).alias("ord"), F.col("id").alias("name"), F.explode(F.split("entity_type", r"\+")).alias("type"), "description") for k, g in enumerate(
            (first, second)
        )
    ]
    edges = [
        g[1].select(F.lit(k).alias("ord"), F.col("src").alias("head"), "relation", F.col("dst").alias("tail"), "description") for k, g in enumerate(
            (first, second)
        )
    ]
    return cap_entities(merge_entities(nodes[0].unionByName(nodes[1])), merge_relations(edges[0].unionByName(edges[1])), max_entities)
