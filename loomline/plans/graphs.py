"""Queries over a property graph of the sales tables: regions, nations, and their customers and suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators import graph
from loomline.plans.literals import PARAMS, relation
from loomline.session import cut, table


def _graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): customers belong to nations, nations to regions; customers of odd numbers stand apart, in pairs."""
    region, nation, customer = (table(spark, sf_dir, x) for x in ("region", "nation", "customer"))
    odd = F.col("c_custkey") % 2 == 1
    nodes = region.select(
        F.concat_ws(":", F.lit("region"), "r_regionkey").alias("id"),
        F.col("r_name").alias("entity_name"),
        F.lit("region").alias("entity_type"),
        F.lit("A region").alias("description"),
    )
    nodes = nodes.unionByName(
        nation.select(
            F.concat_ws(":", F.lit("nation"), "n_nationkey").alias("id"),
            F.col("n_name").alias("entity_name"),
            F.lit("nation").alias("entity_type"),
            F.lit("").alias("description"),
        )
    )
    nodes = nodes.unionByName(
        customer.select(
            F.concat_ws(":", F.lit("customer"), "c_custkey").alias("id"),
            F.col("c_name").alias("entity_name"),
            F.lit("customer").alias("entity_type"),
            F.col("c_mktsegment").alias("description"),
        )
    )
    edges = nation.select(
        F.concat_ws(":", F.lit("nation"), "n_nationkey").alias("src"),
        F.concat_ws(":", F.lit("region"), "n_regionkey").alias("dst"),
        F.lit("in_region").alias("relation"),
        F.lit("").alias("description"),
    )
    even = customer.where(~odd).select(
        F.concat_ws(":", F.lit("customer"), "c_custkey").alias("src"),
        F.concat_ws(":", F.lit("nation"), "c_nationkey").alias("dst"),
        F.lit("").alias("relation"),
        F.col("c_mktsegment").alias("description"),
    )
    pairs = customer.where(odd & (F.col("c_custkey") % 4 == 3)).select(
        F.concat_ws(":", F.lit("customer"), "c_custkey").alias("src"),
        F.concat_ws(":", F.lit("customer"), F.col("c_custkey") - 2).alias("dst"),
        F.lit("knows").alias("relation"),
        F.lit("").alias("description"),
    )
    return nodes, edges.unionByName(even).unionByName(pairs)


def kg_degree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.top_nodes(*_graph(spark, sf_dir), 40)


def kg_entities_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.ranked_entities(*_graph(spark, sf_dir))


def kg_triples_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.ranked_triples(*_graph(spark, sf_dir))


def kg_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.connected_components(*_graph(spark, sf_dir)).groupBy("component").agg(F.count("*").alias("size"))


def kg_communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.communities(*_graph(spark, sf_dir)).withColumn("members", F.array_join("members", ","))


def kg_entity_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers of a number as one entity, and a nation's comment from whoever has the longest."""
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    key = lambda c: F.concat(F.lit(" party "), F.col(c).cast("string"))
    first = customer.select(
        F.col("c_custkey").alias("ord"),
        key("c_custkey").alias("name"),
        F.lit("customer").alias("type"),
        F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment")).alias("description"),
    )
    second = supplier.select(
        (F.col("s_suppkey") + 1_000_000_000).alias("ord"),
        key("s_suppkey").alias("name"),
        F.lit("supplier").alias("type"),
        F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).otherwise("").alias("description"),
    )
    return graph.merge_entities(first.unionByName(second))


def kg_relation_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who ordered from whom, once for each customer and supplier, whichever way it is told."""
    line = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    head, tail = F.concat(F.lit("c"), F.col("o_custkey").cast("string")), F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
    turn = F.col("l_linenumber") % 2 == 0
    rows = line.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("ord"),
        F.when(turn, tail).otherwise(head).alias("head"),
        F.when(turn, "sold to").otherwise("ordered from").alias("relation"),
        F.when(turn, head).otherwise(tail).alias("tail"),
        F.lit("").alias("description"),
    )
    return graph.merge_relations(rows)


def kg_budget_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the exported context that a budget of 600 tokens leaves."""
    nodes, edges = _graph(spark, sf_dir)
    lines = graph.context_lines(graph.ranked_entities(nodes, edges), graph.ranked_triples(nodes, edges), graph.communities(nodes, edges))
    return graph.fit_budget(cut(lines), 600)


def kg_from_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of the graph of a small catalog: parameters of tools, and parameters that tools share."""
    rows: dict[str, list[str]] = {}
    for tool, param, kind in PARAMS:
        rows.setdefault(tool, []).append(f'"{param}": {{"type": "{kind}", "description": "{param} of {tool}"}}')
    catalog = relation(
        spark,
        tuple(
            (k, tool, f"Calls {tool}", '{"properties": {' + ", ".join(x) + '}, "required": ["user_id"]}') for k, (tool, x) in enumerate(
                rows.items()
            )
        ),
        "ord long, name string, description string, input_schema string",
    )
    return graph.tool_graph(catalog)[1]


QUERIES = {
    f.__name__: f for f in (
        kg_degree_topk,
        kg_entities_ranked,
        kg_triples_ranked,
        kg_components,
        kg_communities,
        kg_entity_merge,
        kg_relation_merge,
        kg_budget_prefix,
        kg_from_tools,
    )
}

_GRAPH_SQL = """nodes AS (
  SELECT 'region:' || r_regionkey AS id, r_name AS entity_name, 'region' AS entity_type, 'A region' AS description FROM region
  UNION ALL SELECT 'nation:' || n_nationkey, n_name, 'nation', '' FROM nation
  UNION ALL SELECT 'customer:' || c_custkey, c_name, 'customer', c_mktsegment FROM customer),
edges AS (
  SELECT 'nation:' || n_nationkey AS src, 'region:' || n_regionkey AS dst, 'in_region' AS relation, '' AS description FROM nation
  UNION ALL SELECT 'customer:' || c_custkey, 'nation:' || c_nationkey, '', c_mktsegment FROM customer WHERE c_custkey % 2 = 0
  UNION ALL SELECT 'customer:' || c_custkey, 'customer:' || (c_custkey - 2), 'knows', '' FROM customer WHERE c_custkey % 4 = 3),
ends AS (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges),
deg AS (SELECT n.id, count(e.id) AS degree FROM nodes n LEFT JOIN ends e USING (id) GROUP BY n.id),
ents AS (SELECT CAST(row_number() OVER (ORDER BY degree DESC, id) AS INTEGER) AS rank, entity_name AS name, entity_type, description, degree FROM deg JOIN nodes USING (id) ORDER BY rank LIMIT 40),
tris AS (
  SELECT CAST(row_number() OVER (ORDER BY a.degree + b.degree DESC, src, dst) AS INTEGER) AS rank, x.entity_name AS head,
         CASE WHEN relation <> '' THEN relation WHEN e.description <> '' THEN e.description ELSE 'related_to' END AS relation, y.entity_name AS tail, e.description
  FROM edges e JOIN deg a ON a.id = src JOIN deg b ON b.id = dst JOIN nodes x ON x.id = src JOIN nodes y ON y.id = dst ORDER BY rank LIMIT 60)"""

# Components without recursion: pairs of odd customers by rule, all others by the region that they lead to.
_COMP_SQL = _GRAPH_SQL + (
    """,
hub AS (
  SELECT 'region:' || r_regionkey AS id, 'region:' || r_regionkey AS hub FROM region
  UNION ALL SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey FROM nation
  UNION ALL SELECT 'customer:' || c_custkey, 'region:' || n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 2 = 0
  UNION ALL SELECT 'customer:' || c_custkey, 'customer:' || CASE WHEN c_custkey % 4 = 3 THEN c_custkey - 2 ELSE c_custkey END FROM customer WHERE c_custkey % 2 = 1),
comp AS (SELECT id, min(id) OVER (PARTITION BY hub) AS component FROM hub),
sizes AS (SELECT component, count(*) AS size FROM comp GROUP BY component),
best AS (SELECT *, CAST(row_number() OVER (ORDER BY size DESC, component) - 1 AS INTEGER) AS id FROM sizes WHERE size >= 2 ORDER BY id LIMIT 8),
placed AS (SELECT b.id, b.size, n.entity_name AS name, row_number() OVER (PARTITION BY b.id ORDER BY d.degree DESC, c.id) AS place FROM comp c JOIN best b USING (component) JOIN deg d ON d.id = c.id JOIN nodes n ON n.id = c.id),
comms AS (
  SELECT id, size, string_agg(name, ',' ORDER BY place) FILTER (WHERE place <= 8) AS members, string_agg(name, ', ' ORDER BY place) FILTER (WHERE place <= 8) AS told,
         'Topic cluster of ' || size || ' entities, centered on ' || string_agg(name, ', ' ORDER BY place) FILTER (WHERE place <= 5) || CASE WHEN size > 5 THEN ', …' ELSE '' END || '.' AS summary
  FROM placed GROUP BY id, size)"""
)

ORACLE_SQL = {
    "kg_degree_topk": f"WITH {_GRAPH_SQL} SELECT CAST(row_number() OVER (ORDER BY degree DESC, id) AS INTEGER) AS rank, id, degree FROM deg ORDER BY rank LIMIT 40",
    "kg_entities_ranked": f"WITH {_GRAPH_SQL} SELECT * FROM ents",
    "kg_triples_ranked": f"WITH {_GRAPH_SQL} SELECT * FROM tris",
    "kg_components": f"WITH {_COMP_SQL} SELECT component, size FROM sizes",
    "kg_communities": f"WITH {_COMP_SQL} SELECT id, size, members, summary FROM comms",
    "kg_entity_merge": """WITH e AS (SELECT c_custkey AS ord, 'party ' || c_custkey AS id, 'customer' AS type, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS description FROM customer
        UNION ALL SELECT s_suppkey + 1000000000, 'party ' || s_suppkey, 'supplier', CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE '' END FROM supplier),
      m AS (SELECT id, string_agg(DISTINCT type, '+' ORDER BY type) AS entity_type, arg_max(description, (length(description), -ord)) AS longest, arg_min(description, ord) AS first FROM e GROUP BY id)
      SELECT id, id AS entity_name, entity_type, CASE WHEN first <> '' OR length(longest) > length(id) THEN longest ELSE id END AS description FROM m""",
    "kg_relation_merge": """WITH r AS (SELECT l_orderkey * 100 + l_linenumber AS ord, l_linenumber % 2 = 0 AS turn, 'c' || o_custkey AS c, 's' || l_suppkey AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
      f AS (SELECT c, s, arg_min(turn, ord) AS turn FROM r GROUP BY c, s)
      SELECT CASE WHEN turn THEN s ELSE c END AS src, CASE WHEN turn THEN c ELSE s END AS dst, CASE WHEN turn THEN 'sold to' ELSE 'ordered from' END AS relation, CASE WHEN turn THEN s || ' sold to ' || c ELSE c || ' ordered from ' || s END AS description FROM f""",
    "kg_budget_prefix": f"""WITH {_COMP_SQL}, lines AS (
        SELECT 0 AS section, 0 AS worth, rank, '- ' || name || ' (' || entity_type || ')' || CASE WHEN description <> '' THEN ': ' || description ELSE '' END AS line FROM ents
        UNION ALL SELECT 1, 2, rank, '- ' || head || ' --' || relation || '--> ' || tail || CASE WHEN description <> '' THEN ' — ' || description ELSE '' END FROM tris
        UNION ALL SELECT 2, 1, id + 1, '- Cluster ' || id || ' (' || size || ' entities): ' || told || '. ' || summary FROM comms),
      s AS (SELECT *, sum(length(line) + 1) OVER (ORDER BY worth, rank) AS so_far FROM lines)
      SELECT section, rank, line FROM s WHERE so_far + {sum(map(len, graph.HEADINGS)) + len(graph.HEADINGS) - 1} < 4 * 601 OR (section = 0 AND rank = 1)""",
    "kg_from_tools": "WITH p(tool, param, type) AS (VALUES "
    + ", ".join(f"('{t}', '{p}', '{k}')" for t, p, k in PARAMS)
    + """), s AS (SELECT a.tool AS src, b.tool AS dst, min(a.param || ' (' || a.type || ')') AS told FROM p a JOIN p b ON a.param = b.param AND a.type = b.type AND a.tool < b.tool GROUP BY 1, 2)
      SELECT tool AS src, tool || '.' || param AS dst, 'has_parameter' AS relation, tool || ' takes parameter ' || param || ' (' || type || ')' || CASE WHEN param = 'user_id' THEN ' [required]' ELSE '' END AS description FROM p
      UNION ALL SELECT src, dst, 'shares_parameter_with', 'both take ' || told FROM s""",
}
