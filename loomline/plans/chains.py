"""Queries over executed chains: each user's events in their order, as calls of tools."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomline.functions.facts import expected_outcome
from loomline.functions.intent import intent_aligned, question_intent, tool_effect
from loomline.functions.text import estimate_tokens
from loomline.operators import composability, refine, sampling, traces, verify
from loomline.plans.literals import EDGES, EVENT_TOOLS, OUTPUTS, PARAMS, relation, values
from loomline.session import table

#: The input that each tool takes: a number below 90, by the catalog's schema a string for the page tools.
SCHEMAS = tuple(
    (tool, '{"properties": {"k": {"type": "%s"}}, "required": ["k"]}' % ("string" if tool == "open_link" else "integer")) for _, tool in EVENT_TOOLS if tool != "close_session"
)


def _steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, step, event_id, tool, tool_input, value) of each event."""
    tools = F.create_map(*(F.lit(x) for pair in EVENT_TOOLS for x in pair))
    events = table(spark, sf_dir, "events").withColumn("tool", F.try_element_at(tools, F.col("event_type")))
    return traces.numbered(
        events.select("user_id", "ts", "event_id", "tool", F.col("props").alias("tool_input"), "value"), "user_id", ["ts", "event_id"]
    )


def _chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.ordered_chain(
        _steps(spark, sf_dir).withColumn("result", F.concat(F.lit('{"status": "'), F.col("tool"), F.lit('"}'))),
        "user_id",
        ["step"],
        "tool",
        "tool_input",
        "result",
    )


def _edges(spark: SparkSession) -> DataFrame:
    return relation(spark, EDGES, "src string, dst string, score double")


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, steps, hits, coverage) by neighbours within each user, without building arrays."""
    w = Window.partitionBy("user_id").orderBy("step")
    pairs = _steps(spark, sf_dir).select("user_id", F.col("tool").alias("src"), F.lead("tool").over(w).alias("dst"))
    hit = pairs.join(F.broadcast(_edges(spark).select("src", "dst", F.lit(1).alias("hit"))), ["src", "dst"], "left")
    sums = hit.groupBy("user_id").agg(F.count("*").alias("steps"), F.count("hit").alias("hits"))
    return sums.withColumn("coverage", F.when(F.col("steps") == 1, None).otherwise(F.col("hits") / (F.col("steps") - 1)))


def chain_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    covered = _coverage(spark, sf_dir)
    passes = F.col("coverage").isNull() | (F.col("coverage") >= 0.2)
    return covered.select("user_id", "steps", "hits", F.round("coverage", 6).alias("coverage"), passes.alias("passes"))


def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coverage(spark, sf_dir).agg(
        F.count("*").alias("n"), F.count_if(F.col("coverage").isNull()).alias("not_applicable"), F.round(F.avg("coverage"), 6).alias("mean_coverage"), F.round(F.max("coverage"), 6).alias(
            "max_coverage"
        )
    )


def chain_coverage_operator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same coverage by the operator that takes chains as arrays."""
    return verify.coverage(_chains(spark, sf_dir), _edges(spark), ["user_id"]).select("user_id", F.round("coverage", 6).alias("coverage"))


def tool_effect_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _steps(spark, sf_dir).groupBy(tool_effect(F.col("tool")).alias("effect")).agg(
        F.count("*").alias("n"), F.countDistinct("user_id").alias("users")
    )


def tool_diversity_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = _steps(spark, sf_dir).groupBy("tool").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))
    return counted.orderBy(F.desc("n"), "first_event").limit(5)


def transition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.consecutive(_chains(spark, sf_dir), ["user_id"]).groupBy("src", "dst").agg(F.count("*").alias("n"))


def intent_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intent of each user turn, held against the tools of the user of the same number."""
    asked = table(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn", "text")
    tools = _chains(spark, sf_dir).select("user_id", traces.tools_of(F.col("chain")).alias("tools"))
    both = asked.join(tools, F.col("conv_id") == F.col("user_id"), "left")
    text = F.concat(F.lit("show me or open "), F.coalesce("text", F.lit("")))
    return both.select(
        "conv_id",
        "turn",
        F.coalesce(question_intent(F.col("text")), F.lit("NONE")).alias("intent"),
        question_intent(text).alias("asked_intent"),
        intent_aligned(text, F.col("tools")).alias("aligned"),
    )


def chain_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = _steps(spark, sf_dir).withColumn(
        "preview",
        F.concat(F.lit('{"value": 1.5, "state": "'), F.col("tool"), F.lit('", "id": '), F.get_json_object("tool_input", "$.k"), F.lit("}")),
    )
    return steps.select("user_id", "step", expected_outcome(F.col("tool"), F.col("preview")).alias("o")).select("user_id", "step", "o.*")


def schema_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _chains(spark, sf_dir)
    checked = verify.check_steps(rows, relation(spark, SCHEMAS, "tool string, input_schema string"), ["user_id"])
    return checked.select(
        "user_id",
        "step",
        "tool",
        "missing",
        F.array_join("problems", "; ").alias("problems"),
        "ok",
        F.coalesce("error", F.lit("")).alias("error"),
    )


def _qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question-answer row for each chain, drafted from its template."""
    chains = _chains(spark, sf_dir)
    c = F.col
    refs = F.filter(F.array(*(F.lit(x) for _, x in EVENT_TOOLS)), lambda n: F.array_contains(traces.tools_of(c("chain")), n))
    kept = chains.withColumn("entity_refs", refs)
    outcomes = F.transform("chain", lambda x: expected_outcome(x["tool"], x["result_preview"]))
    return kept.select(
        F.col("user_id").alias("sample_id"), F.lit(0).alias("chain_pos"), F.col("user_id").cast("string").alias("chain_id"), F.lit("").alias(
            "description"
        ),
        traces.template_question(c("chain"), c("entity_refs")).alias("question"), traces.template_answer(c("user_id").cast("string"), F.lit(""), c("chain")).alias(
            "answer_draft"
        ),
        traces.tools_of(c("chain")).alias("required_tools"), "chain", "entity_refs", outcomes.alias("expected_outcomes"),
        F.struct(F.lit("executed_trace").alias("source"), c("user_id").cast("string").alias("chain_id")).alias("provenance"),
    )


def _catalog(spark: SparkSession) -> DataFrame:
    return relation(spark, SCHEMAS, "tool string, input_schema string")


def _entities(spark: SparkSession) -> DataFrame:
    return relation(spark, tuple((k, tool) for k, (_, tool) in enumerate(EVENT_TOOLS)), "pos int, name string")


def verify_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = verify.verify(_qa(spark, sf_dir), _catalog(spark), ["sample_id", "chain_pos"])
    v = "verification."
    return checked.select(
        "sample_id",
        f"{v}chain_valid",
        F.size(f"{v}missing_tools").alias("n_missing"),
        F.size(f"{v}schema_mismatches").alias("n_mismatches"),
        f"{v}intent_aligned",
        f"{v}output_assertions_passed",
        f"{v}state_assertions_passed",
        f"{v}answer_faithful",
        f"{v}safe_to_review",
    )


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine.score(_qa(spark, sf_dir), _catalog(spark), _edges(spark), _entities(spark))


def critique_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir)
    return scored.select("sample_id", F.posexplode(refine.critique()).alias("pos", "issue")).select("sample_id", "pos", "issue")


def quality_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir)
    return scored.select(
        "sample_id",
        F.round("coverage", 6).alias("coverage"),
        "entity_grounded",
        "question_tokens",
        "answer_tokens",
        refine.passes().alias("passes"),
    )


def refine_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One round without a model to refine with: the ledger's counts."""
    _, ledger = refine.refine(_qa(spark, sf_dir), _catalog(spark), _edges(spark), _entities(spark))
    row = ledger["iterations"][0]
    keys = ("iteration", "num_pairs", "num_chain_valid", "num_entity_grounded", "num_kept", "num_rejected")
    return spark.createDataFrame(
        [(*(row[k] for k in keys), round(row["mean_coverage"], 6), ledger["stopped_reason"])],
        ", ".join(f"{k} long" for k in keys) + ", mean_coverage double, stopped_reason string",
    )


def call_budget_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains generated in order under a soft cap on calls, checked after each: one that crosses it is kept, none after.

    The running sum is taken per hundred users first, so that no task sees them all.
    """
    chains = _steps(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("calls")).withColumn("part", F.floor(F.col("user_id") / 100))
    sums = chains.groupBy("part").agg(F.sum("calls").alias("total"))
    before = sums.select(
        "part", F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")
    )
    inner = F.coalesce(
        F.sum("calls").over(Window.partitionBy("part").orderBy("user_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    spent = chains.withColumn("inner", inner).join(before, "part").withColumn("spent", F.col("before") + F.col("inner"))
    return spent.where("spent < 5000").select("user_id", "calls", (F.col("spent") + F.col("calls")).alias("total_calls"))


def _tools(spark: SparkSession) -> DataFrame:
    inputs = relation(spark, PARAMS, "tool string, name string, type string").groupBy("tool").agg(
        F.collect_list(F.struct("name", "type")).alias("inputs")
    )
    outputs = relation(spark, OUTPUTS, "tool string, pos int, name string, type string").groupBy("tool").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "name", "type"))), lambda x: F.struct(x["name"].alias("name"), x["type"].alias("type"))).alias(
            "outputs"
        )
    )
    return inputs.join(outputs, "tool")


def toolkg_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = relation(spark, OUTPUTS, "tool string, pos int, name string, type string")
    wanted = relation(spark, tuple((t, k, n, x) for k, (t, n, x) in enumerate(PARAMS)), "tool string, pos int, name string, type string")
    order = F.struct("score", -F.col("out_pos"), -F.col("in_pos"))
    best = composability.pair_scores(given, wanted).groupBy("src", "dst").agg(
        F.max("score").alias("score"), F.max_by(F.concat_ws("->", "out_name", "in_name"), order).alias("via")
    )
    return best.where(F.col("score") >= composability.THRESHOLD).select("src", "dst", F.round("score", 3).alias("score"), "via")


def toolkg_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = toolkg_edges(spark, sf_dir)
    return composability.graph_stats(_tools(spark), edges).withColumn("isolated", F.array_join("isolated", ","))


def neighborhood_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density of the tools that each user called."""
    called = _steps(spark, sf_dir).select(F.col("user_id").alias("group"), "tool")
    return composability.neighborhood_density(_edges(spark), called).select(
        F.col("group").alias("user_id"), "n", F.round("density", 6).alias("density")
    )


def random_walk_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tools for each user by a walk over the composability edges."""
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("call_no")).distinct()
    nodes = relation(spark, tuple((tool,) for _, tool in EVENT_TOOLS), "tool string")
    return sampling.sample_walks(sampling.call_seeds(users, 42), nodes, _edges(spark), 3)


def shared_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomline.operators.graph import shared_parameters

    return shared_parameters(relation(spark, PARAMS, "tool string, param string, type string"))


def conversation_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = estimate_tokens(F.col("text"))
    rows = table(spark, sf_dir, "conversations").select("role", tokens.alias("tokens"))
    return rows.groupBy("role").agg(
        F.count("*").alias("n"),
        F.round(F.avg("tokens"), 6).alias("mean"),
        F.min("tokens").alias("least"),
        F.max("tokens").alias("most"),
        F.round(F.stddev_pop("tokens"), 6).alias("stdev"),
    )


_TOOLS_SQL = f"tools(event_type, tool) AS (VALUES {values(EVENT_TOOLS)}), edges(src, dst, score) AS (VALUES {values(EDGES)})"
_STEPS_SQL = f"""{_TOOLS_SQL},
steps AS (
  SELECT e.user_id, CAST(row_number() OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id) - 1 AS INTEGER) AS step, e.event_id, t.tool, e.props
  FROM events e JOIN tools t USING (event_type)),
pairs AS (SELECT user_id, step, tool AS src, lead(tool) OVER (PARTITION BY user_id ORDER BY step) AS dst FROM steps),
cov AS (
  SELECT p.user_id, count(*) AS steps, count(e.src) AS hits FROM pairs p LEFT JOIN edges e ON p.src = e.src AND p.dst = e.dst GROUP BY p.user_id),
covered AS (SELECT *, CASE WHEN steps > 1 THEN hits / CAST(steps - 1 AS DOUBLE) END AS coverage FROM cov)"""
_EFFECT_SQL = "CASE WHEN tool IN ('get_page') THEN 'READ' WHEN tool IN ('open_link', 'create_account', 'submit_order') THEN 'CREATE' WHEN tool IN ('close_session') THEN 'DELETE' ELSE 'UNKNOWN' END"
_INTENT_SQL = r"""CASE WHEN regexp_matches({0}, '\b(status of|what is the status|what is status|look ?up|lookup|show me|get the|retrieve)\b', 'i') THEN 'READ'
  WHEN regexp_matches({0}, '\b(close|resolve|cancel|delete|remove)\b', 'i') THEN 'DELETE'
  WHEN regexp_matches({0}, '\b(create|file|open|raise|submit|add)\b', 'i') THEN 'CREATE' END"""
_WANT = {tool: "string" if tool == "open_link" else "integer" for _, tool in EVENT_TOOLS}

#: Each user's chain, with what its steps fail by.
_QA_SQL = f"""{_STEPS_SQL},
qa AS (
  SELECT user_id AS sample_id, list(tool ORDER BY step) AS tools, count(*) AS n,
         count(*) FILTER (WHERE tool = 'close_session') AS n_missing, count(*) FILTER (WHERE tool = 'open_link') AS n_mismatches,
         arg_min(tool, step) AS first_tool
  FROM steps GROUP BY user_id),
every AS (SELECT user_id AS sample_id, list_filter({[x for _, x in EVENT_TOOLS]}, lambda x: list_contains(list(tool), x)) AS refs FROM steps GROUP BY user_id),
drafted AS (
  SELECT q.*, e.refs, 'Use the ' || array_to_string(tools, ', ') || CASE WHEN n > 1 THEN ' tools' ELSE ' tool' END || ' to ' ||
         CASE split_part(first_tool, '_', 1) WHEN 'get' THEN 'look up' WHEN 'open' THEN 'open' WHEN 'create' THEN 'create' WHEN 'close' THEN 'close' ELSE 'use' END ||
         ' the following: ' || CASE WHEN len(refs) > 0 THEN array_to_string(refs, ', ') ELSE 'the data' END || '.' AS question,
         '(drafted mechanically from tool results; LLM refinement pending) Chain: ' || sample_id || ' (). Key result: {{"status": "' || first_tool || '"}}' AS answer
  FROM qa q JOIN every e USING (sample_id)),
intents AS (SELECT *, {_INTENT_SQL.format("question")} AS intent, list_transform(tools, lambda tool: {_EFFECT_SQL}) AS effects FROM drafted),
scored AS (
  SELECT i.*, c.coverage, n_missing = 0 AND n_mismatches = 0 AS valid, len(refs) > 0 AS grounded,
         CASE WHEN intent IS NULL THEN true WHEN intent = 'READ' THEN NOT list_contains(effects, 'CREATE') OR list_contains(effects, 'READ') ELSE list_contains(effects, intent) END AS aligned
  FROM intents i JOIN covered c ON c.user_id = i.sample_id)"""
_PASSES_SQL = "valid AND aligned AND (coverage IS NULL OR coverage >= 0.5) AND grounded"

QUERIES = {
    f.__name__: f
    for f in (
        chain_coverage, coverage_summary, chain_coverage_operator, tool_effect_counts, tool_diversity_top5, transition_counts, intent_alignment, chain_outcomes, schema_problems, verify_report,
        critique_issues, quality_gates, refine_ledger, call_budget_cutoff, toolkg_edges, toolkg_stats, neighborhood_density, random_walk_sample, shared_params, conversation_tokens,
    )
}

_TOKENS_SQL = r"""list_distinct(list_transform(list_filter(regexp_split_to_array(lower(regexp_replace({0}, '([a-z0-9])([A-Z])', '\1 \2', 'g')), '[^a-z0-9]+'), lambda x: x <> ''),
  lambda t: CASE WHEN length(t) > 4 AND t LIKE '%ies' THEN left(t, length(t) - 3) || 'y' WHEN length(t) > 3 AND t LIKE '%s' AND t NOT LIKE '%ss' AND t NOT LIKE '%us' THEN left(t, length(t) - 1) ELSE t END))"""
_GRAPH_SQL = f"""
WITH outs(src, out_pos, out_name, out_type) AS (VALUES {values(OUTPUTS)}),
ins(dst, in_pos, in_name, in_type) AS (VALUES {values(tuple((t, k, n, x) for k, (t, n, x) in enumerate(PARAMS)))}),
a AS (SELECT *, {_TOKENS_SQL.format("out_name")} AS ta FROM outs), b AS (SELECT *, {_TOKENS_SQL.format("in_name")} AS tb FROM ins),
m AS (SELECT *, list_intersect(ta, tb) AS shared FROM a JOIN b ON src <> dst),
s AS (
  SELECT *, 2.0 * len(shared) / (len(ta) + len(tb)) AS plain,
         len(list_filter(shared, lambda x: x NOT IN ({", ".join(f"'{x}'" for x in composability.GENERIC)}))) = 0 AS generic,
         out_type = in_type OR (out_type IN ('string', 'path') AND in_type IN ('string', 'path')) OR (out_type IN ('integer', 'number') AND in_type IN ('integer', 'number'))
           OR (out_type IN ('content', 'string') AND in_type IN ('content', 'string')) AS fits
  FROM m WHERE len(shared) > 0),
p AS (SELECT *, CASE WHEN generic THEN plain * 0.5 WHEN fits THEN least(1.0, plain + 0.15) ELSE plain END AS score FROM s),
g AS (SELECT src, dst, max(score) AS score, arg_max(out_name || '->' || in_name, (score, -out_pos, -in_pos)) AS via FROM p GROUP BY src, dst),
edges AS (SELECT src, dst, round(CAST(score AS DOUBLE), 3) AS score, via FROM g WHERE score >= 0.34)"""

ORACLE_SQL = {
    "chain_coverage": f"WITH {_STEPS_SQL} SELECT user_id, steps, hits, round(coverage, 6) AS coverage, coalesce(coverage >= 0.2, true) AS passes FROM covered",
    "coverage_summary": f"WITH {_STEPS_SQL} SELECT count(*) AS n, count(*) FILTER (WHERE coverage IS NULL) AS not_applicable, round(avg(coverage), 6) AS mean_coverage, round(max(coverage), 6) AS max_coverage FROM covered",
    "chain_coverage_operator": f"WITH {_STEPS_SQL} SELECT user_id, round(coverage, 6) AS coverage FROM covered",
    "tool_effect_counts": f"WITH {_STEPS_SQL} SELECT {_EFFECT_SQL} AS effect, count(*) AS n, count(DISTINCT user_id) AS users FROM steps GROUP BY 1",
    "tool_diversity_top5": f"WITH {_STEPS_SQL} SELECT tool, count(*) AS n, min(event_id) AS first_event FROM steps GROUP BY tool ORDER BY n DESC, first_event LIMIT 5",
    "transition_counts": f"WITH {_STEPS_SQL} SELECT src, dst, count(*) AS n FROM pairs WHERE dst IS NOT NULL GROUP BY src, dst",
    "intent_alignment": f"""WITH {_STEPS_SQL}, effects AS (SELECT user_id, list(DISTINCT {_EFFECT_SQL}) AS found FROM steps GROUP BY user_id),
      asked AS (SELECT conv_id, turn, text, 'show me or open ' || coalesce(text, '') AS q FROM conversations WHERE role = 'user')
      SELECT conv_id, turn, coalesce({_INTENT_SQL.format("coalesce(text, '')")}, 'NONE') AS intent, {_INTENT_SQL.format("q")} AS asked_intent,
             found IS NOT NULL AND (NOT list_contains(found, 'CREATE') OR list_contains(found, 'READ')) AS aligned
      FROM asked LEFT JOIN effects ON conv_id = user_id""",
    "chain_outcomes": f"""WITH {_STEPS_SQL} SELECT user_id, step, tool || ' result reports state=' || tool AS description, tool AS assertion,
      tool || CASE WHEN tool = 'get_page' THEN ' observed: ' ELSE ' applied: ' END || 'state=' || tool AS state_after FROM steps""",
    "schema_problems": f"""WITH {_STEPS_SQL} SELECT user_id, step, tool, tool = 'close_session' AS missing,
      CASE WHEN tool = 'open_link' THEN 'property ''k'' should be string, got int' ELSE '' END AS problems, tool NOT IN ('close_session', 'open_link') AS ok,
      CASE WHEN tool = 'close_session' THEN 'missing tool: ''close_session''' WHEN tool = 'open_link' THEN 'property ''k'' should be string, got int' ELSE '' END AS error FROM steps""",
    "verify_report": f"""WITH {_QA_SQL} SELECT sample_id, valid AS chain_valid, CAST(n_missing AS INTEGER) AS n_missing, CAST(n_mismatches AS INTEGER) AS n_mismatches, aligned AS intent_aligned,
      true AS output_assertions_passed, true AS state_assertions_passed, true AS answer_faithful, valid AND aligned AS safe_to_review FROM scored""",
    "critique_issues": f"""WITH {_QA_SQL}, m AS (SELECT user_id AS sample_id, row_number() OVER (PARTITION BY user_id ORDER BY step) AS k,
        'The chain calls tool ''close_session'' which is not available. Rewrite the question so it only needs available tools, or fix the tool name.' AS issue FROM steps WHERE tool = 'close_session'),
      b AS (SELECT user_id AS sample_id, 100 + step AS k, 'Step ' || step || ' (open_link) has invalid arguments: property ''k'' should be string, got int. Correct the tool arguments.' AS issue FROM steps WHERE tool = 'open_link'),
      f AS (SELECT user_id AS sample_id, 200 + step AS k, 'Step ' || step || ' (open_link) failed when executed: property ''k'' should be string, got int. Adjust the chain usage.' AS issue FROM steps WHERE tool = 'open_link'),
      t AS (SELECT sample_id, 300 AS k, 'Only ' || CAST(round(100 * coverage) AS INTEGER) || '% of consecutive tool pairs are composable according to the ToolKG (minimum 50%). Prefer tool sequences whose outputs feed the next tool''s inputs.' AS issue FROM scored WHERE coverage < 0.5),
      u AS (SELECT * FROM m UNION ALL SELECT * FROM b UNION ALL SELECT * FROM f UNION ALL SELECT * FROM t)
      SELECT sample_id, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY k) - 1 AS INTEGER) AS pos, issue FROM u""",
    "quality_gates": f"""WITH {_QA_SQL} SELECT sample_id, round(coverage, 6) AS coverage, grounded AS entity_grounded, greatest(1, length(question) // 4) AS question_tokens, greatest(1, length(answer) // 4) AS answer_tokens, {_PASSES_SQL} AS passes FROM scored""",
    "refine_ledger": f"""WITH {_QA_SQL} SELECT CAST(0 AS BIGINT) AS iteration, count(*) AS num_pairs, count(*) FILTER (WHERE valid) AS num_chain_valid, count(*) FILTER (WHERE grounded) AS num_entity_grounded,
      count(*) FILTER (WHERE {_PASSES_SQL}) AS num_kept, count(*) FILTER (WHERE NOT ({_PASSES_SQL})) AS num_rejected, round(avg(coverage), 6) AS mean_coverage, 'no_llm_refinement' AS stopped_reason FROM scored""",
    "call_budget_cutoff": """WITH c AS (SELECT user_id, count(*) AS calls FROM events GROUP BY user_id), s AS (SELECT *, CAST(sum(calls) OVER (ORDER BY user_id) AS BIGINT) AS total_calls FROM c)
      SELECT * FROM s WHERE total_calls - calls < 5000""",
    "toolkg_edges": f"{_GRAPH_SQL} SELECT * FROM edges",
    "toolkg_stats": f"""{_GRAPH_SQL}, nodes AS (SELECT DISTINCT src AS tool FROM outs) SELECT (SELECT count(*) FROM nodes) AS num_tools, count(*) AS num_edges, round(count(*) / 20.0::DOUBLE, 3) AS density, round(count(*) / 5.0::DOUBLE, 2) AS avg_out_degree,
      coalesce((SELECT string_agg(tool, ',' ORDER BY tool) FROM nodes WHERE tool NOT IN (SELECT src FROM edges UNION SELECT dst FROM edges)), '') AS isolated FROM edges""",
    "neighborhood_density": f"""WITH {_STEPS_SQL}, g AS (SELECT DISTINCT user_id, tool FROM steps), n AS (SELECT user_id, count(*) AS n FROM g GROUP BY user_id),
      t AS (SELECT a.user_id, sum(CAST(e.score AS DOUBLE)) AS total FROM g a JOIN g b ON a.user_id = b.user_id JOIN edges e ON e.src = a.tool AND e.dst = b.tool GROUP BY a.user_id)
      SELECT n.user_id, n, round(CASE WHEN n < 2 THEN 0 ELSE coalesce(total, 0) / (n * (n - 1)) END, 6) AS density FROM n LEFT JOIN t USING (user_id)""",
    "shared_params": f"WITH p(tool, param, type) AS (VALUES {values(PARAMS)}) SELECT a.tool AS a, b.tool AS b, a.param, a.type FROM p a JOIN p b ON a.param = b.param AND a.type = b.type AND a.tool < b.tool",
    "conversation_tokens": "SELECT role, count(*) AS n, round(avg(t), 6) AS mean, min(t) AS least, max(t) AS most, round(stddev_pop(t), 6) AS stdev FROM (SELECT role, greatest(1, length(coalesce(text, '')) // 4) AS t FROM conversations) GROUP BY role",
}
