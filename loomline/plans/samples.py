"""Queries over workflow samples, catalogs, replies and specs that are told from the driver's tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomline.functions.facts import ANSWER_FALLBACK, REQUEST_VERBS, request_verb
from loomline.operators import composability, corpus, graph, mix, refine, sampling, traces
from loomline.plans.chains import _STEPS_SQL, _steps, random_walk_sample
from loomline.plans.documents import _NORM_SQL, _SPLIT_SQL, _TURNS_SQL, _redacted_sql, _turns
from loomline.plans.graphs import ORACLE_SQL as GRAPHS_SQL
from loomline.plans.graphs import kg_budget_prefix
from loomline.plans.literals import EDGES, EVENT_TOOLS, relation, values
from loomline.session import cut, table
from loomline.sources.readers import merge_catalogs

#: Names to look for in chains, the last of which no chain holds.
ENTITIES = (*((k, tool) for k, (_, tool) in enumerate(EVENT_TOOLS)), (9, "submit_nothing"))
SAMPLE_ROWS = 25


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_id, api_use_chains) of each user: chain a holds the events of even numbers, b the others, c nothing.

    Steps of the event error name no tool. A step's action is JSON, its result as many letters as its event's number
    leaves of 400.
    """
    # an action as it is written, without blanks, so that both engines show the same input
    action = F.concat(
        F.lit('{"tool":"'), F.when(F.col("tool") == "close_session", "").otherwise(F.col("tool")), F.lit('","tool_input":'), F.replace("tool_input", F.lit(" "), F.lit("")), F.lit(',"log":""}')
    )
    steps = _steps(spark, sf_dir).withColumn("pair", F.array(action, F.repeat(F.lit("x"), (F.col("event_id") % 400).cast("int"))))
    chain = lambda rest: F.transform(F.array_sort(F.collect_list(F.when(F.col("event_id") % 2 == rest, F.struct("step", "pair")))), lambda x: x["pair"])
    told = lambda name, chain: F.struct(F.lit(name).alias("chain_id"), F.concat(F.lit("chain "), F.lit(name)).alias("description"), chain.alias("intermediate_steps"))
    grouped = steps.groupBy(F.col("user_id").alias("sample_id")).agg(chain(0).alias("even"), chain(1).alias("odd"))
    none = F.array().cast("array<array<string>>")
    return grouped.select(
        "sample_id",
        F.create_map(F.lit("a"), told("a", F.col("even")), F.lit("b"), told("b", F.col("odd")), F.lit("c"), told("c", none)).alias("api_use_chains"),
    )


def extracted_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    chains = traces.extract_chains(_samples(spark, sf_dir))
    steps = chains.select("sample_id", "chain_pos", "chain_id", "description", F.posexplode("chain").alias("step", "s"))
    return steps.select("sample_id", "chain_pos", "chain_id", "description", "step", "s.*")


def _qa(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    samples = _samples(spark, sf_dir)
    tracers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sample_id"), F.col("s_nationkey").cast("long").alias("seed"))
    edges = relation(spark, EDGES, "src string, dst string, score double")
    return samples, traces.qa_rows(samples, relation(spark, ENTITIES, "pos int, name string"), tracers, edges)


def drafted_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question-answer rows of the samples, drafted from templates, with the seeds of the runs that are known."""
    _, rows = _qa(spark, sf_dir)
    p = "provenance."
    return rows.select(
        "sample_id", "chain_pos", "question", F.md5("answer_draft").alias("answer"), F.array_join("required_tools", ",").alias("tools"), F.array_join(
            "entity_refs", ","
        ).alias("refs"),
        F.size("expected_outcomes").alias("n_outcomes"), f"{p}source", f"{p}trace_seed", f"{p}toolkg_edges_used", f"{p}kg_entity_count",
    )


def generation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.generation_stats(*_qa(spark, sf_dir))


def chain_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains as prompts show them, by their hashes."""
    chains = traces.extract_chains(_samples(spark, sf_dir))
    text = traces.chain_text(F.col("chain_id"), F.col("description"), F.col("chain"))
    return chains.select("sample_id", "chain_id", F.length(text).alias("chars"), F.md5(text).alias("hash"))


def tool_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as tools, listed with descriptions that are cut at 120 characters."""
    nation = table(spark, sf_dir, "nation")
    return traces.tool_summaries(
        nation.select(F.col("n_name").alias("tool"), F.repeat(F.lit("abc "), F.col("n_nationkey") * 2).alias("description"))
    )


def request_verbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verb of a request to a tool that is called after each part, in whatever case."""
    verbs = F.array(*map(F.lit, (*REQUEST_VERBS, "grind")))
    verb = F.get(verbs, (F.col("p_partkey") % F.size(verbs)).cast("int"))
    name = F.concat_ws("_", F.when(F.col("p_size") % 2 == 0, F.upper(verb)).otherwise(verb), F.replace("p_name", F.lit(" "), F.lit("_")))
    return table(spark, sf_dir, "part").select("p_partkey", request_verb(name).alias("verb"))


def parsed_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as replies of a text model: with both marks, without an answer for odd turns' conversations, or bare."""
    answer = F.concat(F.lit("\nAnswer: "), F.coalesce("answer", F.lit("")))
    reply = F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("question: "), F.col("question"), answer)).when(F.col("conv_id") % 3 == 1, F.concat(F.lit("QUESTION: "), F.col("question"))).otherwise(
        F.col("question")
    )
    rows = _turns(spark, sf_dir).select("conv_id", "turn", traces.parse_reply(reply).alias("r"))
    return rows.select("conv_id", "turn", F.md5("r.question").alias("question"), F.md5("r.answer").alias("answer"))


def parsed_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities and relations of replies that hold an object amid other words, one for each customer."""
    c = F.col
    found = F.to_json(
        F.struct(
            F.array(F.struct(c("c_name").alias("name"), c("c_mktsegment").alias("type"), F.lit("a {customer}").alias("description"))).alias("entities"),
            F.array(F.struct(c("c_name").alias("head"), F.lit("lives in").alias("relation"), c("c_nationkey").cast("string").alias("tail"))).alias("relations"),
        )
    )
    reply = F.concat(F.lit("Here it is:\n```json\n"), found, F.lit("\n```"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", corpus.parse_extraction(reply).alias("x"))
    first = F.get("x.entities", F.lit(0))
    link = F.get("x.relations", F.lit(0))
    return rows.select(
        "c_custkey", first["name"].alias("name"), first["type"].alias("type"), first["description"].alias("description"), link["tail"].alias("tail"), link["description"].alias("told")
    )


def _part_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ord, name, description, input_schema, server) of the parts as tools; many have the same name."""
    kind = F.col("p_partkey") % 5
    told = F.when(kind == 0, "Reads the file path").when(kind == 1, "Folder listing").when(kind == 2, "Grinds").when(kind == 3, "Summary text of a tree")
    schema = F.when(kind == 2, F.lit("none")).when(kind == 3, F.lit('{"type": "object"}')).otherwise(
        F.concat(F.lit('{"properties": {"size'), F.col("p_size").cast("string"), F.lit('": {"type": "integer", "description": "how big"}, "kind": {"type": ["string", "null"]}, "bad": 5}}'))
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ord"), F.col("p_name").alias("name"), told.alias("description"), schema.alias("input_schema"), F.col("p_brand").alias("server")
    )


def normalized_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs by schema and outputs by description of the parts as tools."""
    tools = composability.normalize_tools(
        _part_tools(spark, sf_dir).select(F.concat_ws("-", "name", "ord").alias("name"), "description", "input_schema")
    )
    listed = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["name"], x["type"])), ",")
    told = F.array_join(F.transform("inputs", lambda x: x["description"]), ",")
    return tools.select("tool", "description", listed("inputs").alias("inputs"), told.alias("told"), listed("outputs").alias("outputs"))


def merged_catalogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two catalogs, nations and then parts; a name that is taken gets its server in front."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("ord"), F.col("n_name").alias("name"), F.lit("").alias("description"), F.lit("{}").alias("input_schema"), F.lit("n").alias("server")
    )
    merged = merge_catalogs([nation, _part_tools(spark, sf_dir).select(nation.columns)])
    return merged.select("ord", "name", "server")


def _external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, messages) of each conversation."""
    message = F.struct("turn", F.col("role"), F.col("text").alias("content"))
    listed = F.transform(F.array_sort(F.collect_list(message)), lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    return table(spark, sf_dir, "conversations").groupBy(F.concat(F.lit("x"), F.col("conv_id").cast("string")).alias("key")).agg(
        listed.alias("messages")
    )


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as question-answer rows: valid where the document of the conversation's number is labelled good."""
    good = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("conv_id")).agg(F.max("quality").alias("quality"))
    turns = _turns(spark, sf_dir).withColumn("ord", F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("question", "answer")))
    return turns.join(good, "conv_id", "left").select(
        F.concat_ws("-", "conv_id", "turn", "ord").alias("key"),
        F.struct("conv_id", "turn", "ord").alias("ord"),
        "question",
        F.col("answer").alias("answer_draft"),
        F.array(F.lit("search")).alias("required_tools"),
        F.array(F.lit("e"), F.col("conv_id").cast("string")).alias("entity_refs"),
        F.array().cast(f"array<{traces.STEP}>").alias("chain"),
        F.struct((F.col("quality") == 1).alias("chain_valid")).alias("verification"),
        F.when(F.col("turn") > 0, F.lit(0.5)).alias("coverage"),
        F.struct(F.lit("executed_trace").alias("source"), F.col("conv_id").alias("chain_id")).alias("provenance"),
    )


def training_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows of the turns, and what their provenance says."""
    rows = mix.to_training_rows(_pairs(spark, sf_dir))
    said = lambda path: F.get_json_object("provenance", f"$.{path}")
    return rows.select(
        "key", "source", F.size("messages").alias("n_messages"), said("source").alias("said"), said("origin").alias("origin"), said("chain_id").alias("chain_id"), said("coverage").alias(
            "coverage"
        ),
        said("entity_refs[1]").alias("ref"), said("verification.chain_valid").alias("valid"), F.md5(said("question")).alias("question"),
    )


def assembled_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row of the mix of gated, de-duplicated turns and whole conversations, with its part of the split."""
    mixed, _ = mix.assemble(_pairs(spark, sf_dir), _external(spark, sf_dir))
    return mixed.select("key", "source", "split", F.size("messages").alias("n_messages"))


def assembled_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, report = mix.assemble(_pairs(spark, sf_dir), _external(spark, sf_dir))
    names = ("n_in", "n_after_cutoffs", "n_external_in", "n_dupes_removed", "n_records_total", "n_train", "n_valid")
    row = (*(report[x] for x in names), report["sources"].get("generated", 0))
    return spark.createDataFrame([row], ", ".join(f"{x} long" for x in names) + ", n_generated long")


def _few_words(row: dict) -> bool:
    """A filter on rows; it fails on texts without a space, and rows that it fails on stay."""
    return len(row["question"].split(" ", 40)) <= 40 if " " in row["question"] else 1 / 0


def semantic_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which turns a predicate on their rows accepts."""
    rows = _turns(spark, sf_dir).select("conv_id", "turn", F.coalesce("question", F.lit("")).alias("question"), F.coalesce("answer", F.lit("")).alias("answer"))
    return refine.semantic_filter(rows, _few_words).select("conv_id", "turn", F.md5("question").alias("question"), F.md5("answer").alias("answer"), "accepted")


def _decider(request: dict) -> dict:
    """A decision model that trusts coverage: it answers 2 where there is none, which is no probability, and fails on src0."""
    scores = request["state"]["keyless_scores"]
    if scores["entity_refs"] == ["src0"]:
        raise ValueError("no opinion")
    p = scores["coverage"] * (0.9 if scores["chain_valid"] else 0.4)
    return {"answers": {"verdict": {"probabilities": {"accept": p if p > 0 else 2.0}}, "grounded": {"noul": p} if scores["chain_valid"] else None}}


def model_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a decision model, or the gates where it fails, says about the documents that are labelled."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    rows = table(spark, sf_dir, "documents").join(labels, "doc_id").select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("question"),
        F.lit("").alias("answer_draft"),
        F.array().cast(f"array<{traces.STEP}>").alias("chain"),
        F.struct((F.col("quality") == 1).alias("chain_valid"), F.lit(True).alias("intent_aligned")).alias("verification"),
        F.when(F.col("toxic") == 1, 0.25).when(F.col("doc_id") % 7 > 0, 1.0).alias("coverage"),
        F.array(F.coalesce("source", F.lit(""))).alias("entity_refs"),
        (F.col("lang") == "en").alias("entity_grounded"),
    )
    return refine.decide(rows, _decider, 0.5).select("doc_id", "decision.*")


def redacted_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as question, answer and result of a row, redacted, by their hashes; the input stays."""
    text = F.coalesce("text", F.lit(""))
    step = F.struct(F.lit("read").alias("tool"), F.lit('{"k": "a@example.org"}').alias("tool_input"), text.alias("result_preview"))
    rows = table(spark, sf_dir, "documents").select("doc_id", text.alias("question"), text.alias("answer_draft"), F.array(step).alias("chain"))
    done = mix.redacted_rows(rows).withColumn("s", F.get("chain", F.lit(0)))
    return done.select(
        "doc_id", F.md5("question").alias("question"), F.md5("answer_draft").alias("answer"), F.md5("s.result_preview").alias("result"), F.col("s.tool_input").alias("input")
    )


def critique_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end of a prompt that lists what to mend, of each document's source and language."""
    return table(spark, sf_dir, "documents").select("doc_id", refine.critique_block(F.array("source", "lang")).alias("block"))


def spec_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spec(spark, sf_dir)[0]


def spec_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spec(spark, sf_dir)[1]


def _spec(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The graph of a spec of regions and their nations, which no entity of the spec names."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    entities = region.select(
        F.col("r_regionkey").alias("ord"), F.concat(F.lit(" "), "r_name").alias("name"), F.when(F.col("r_regionkey") > 1, "region").alias("type"), F.lit("part of the world").alias("description")
    )
    told = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    relations = told.select(
        F.col("n_nationkey").alias("ord"), F.col("n_name").alias("head"), F.lit("lies in").alias("relation"), F.col("r_name").alias("tail"), F.lit(None).cast("string").alias("description")
    )
    return graph.spec_graph(entities, relations)


def _two_graphs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Nations with their regions, joined with nations that suppliers live in, under the same names."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    node = lambda c, kind, told: (F.col(c).alias("id"), F.col(c).alias("entity_name"), F.lit(kind).alias("entity_type"), told.alias("description"))
    first = nation.select(*node("n_name", "nation", F.lit("a nation"))).unionByName(region.select(*node("r_name", "region", F.col("r_name"))))
    located = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    linked = located.select(F.col("n_name").alias("src"), F.col("r_name").alias("dst"), F.lit("lies in").alias("relation"), F.lit("").alias("description"))
    again = nation.select(*node("n_name", "market", F.lit("a market of some size")))
    back = located.select(F.col("r_name").alias("src"), F.col("n_name").alias("dst"), F.lit("holds").alias("relation"), F.lit("").alias("description"))
    return graph.union_graphs((first, linked), (again, back))


def united_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_graphs(spark, sf_dir)[0]


def united_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_graphs(spark, sf_dir)[1]


def rendered_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported context within its budget, as text."""
    return graph.render(kg_budget_prefix(spark, sf_dir))


def _ends(prompt: str) -> str:
    """A text model that finds the first and the last word of a text, and that one comes before the other."""
    words = prompt[len(corpus.PROMPT) :].split(" ")
    found = {
        "entities": [{"name": words[0], "type": "word", "description": "opens a text"}],
        "relations": [{"head": words[0], "relation": "before", "tail": words[-1], "description": ""}],
    }
    return f"Found: {json.dumps(found)}"


def corpus_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.corpus_graph(_files(spark, sf_dir), _ends)[0]


def corpus_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.corpus_graph(_files(spark, sf_dir), _ends)[1]


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark's items as files; the operator's own cap bounds how many of their chunks a model sees."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("path"), "text")


def uniform_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts drawn with equal chances; the number is the operator's."""
    return sampling.uniform_sample(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey", SAMPLE_ROWS, 42)


def walk_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of the walks of all users, whatever they draw: how many, how long, no tool twice, none unknown."""
    walks = cut(random_walk_sample(spark, sf_dir))
    tools = [tool for _, tool in EVENT_TOOLS]
    per = walks.groupBy("walk_id").agg(
        F.count("*").alias("n"),
        F.countDistinct("tool").alias("tools"),
        F.max("pos").alias("last"),
        F.count_if(~F.col("tool").isin(tools)).alias("unknown"),
    )
    return per.groupBy("n", "tools", "last").agg(F.count("*").alias("walks"), F.sum("unknown").alias("unknown"))


QUERIES = {
    f.__name__: f
    for f in (
        extracted_chains, drafted_pairs, generation_counts, chain_texts, tool_lines, request_verbs, parsed_replies, parsed_extractions, normalized_tools, merged_catalogs, training_records,
        assembled_mix, assembled_report, semantic_filtered, model_decisions, redacted_pairs, critique_blocks, spec_nodes, spec_edges, united_nodes, united_edges, rendered_context, corpus_nodes, corpus_edges, uniform_parts, walk_invariants,
    )
}

_CHAINS_SQL = f"""{_STEPS_SQL},
raw AS (
  SELECT user_id AS sample_id, CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS chain_id, step AS place, tool, replace(props, ' ', '') AS tool_input,
         CASE WHEN event_id % 400 > 300 THEN repeat('x', 300) || '...' ELSE repeat('x', event_id % 400) END AS result_preview
  FROM steps WHERE tool <> 'close_session'),
calls AS (
  SELECT sample_id, CASE WHEN chain_id = 'a' THEN 0 ELSE 1 END AS chain_pos, chain_id, 'chain ' || chain_id AS description,
         CAST(row_number() OVER (PARTITION BY sample_id, chain_id ORDER BY place) - 1 AS INTEGER) AS step, tool, tool_input, result_preview
  FROM raw)"""
_ENTITY_SQL = "[" + ", ".join(f"'{name}'" for _, name in ENTITIES) + "]"
_VERB_SQL = "CASE split_part(first_tool, '_', 1) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in REQUEST_VERBS.items()) + " ELSE 'use' END"
_DRAFTS_SQL = f"""{_CHAINS_SQL},
grouped AS (
  SELECT sample_id, chain_pos, any_value(chain_id) AS chain_id, list(tool ORDER BY step) AS tools, arg_min(tool, step) AS first_tool, arg_min(result_preview, step) AS first_result,
         count(*) AS n
  FROM calls GROUP BY sample_id, chain_pos),
linked AS (
  SELECT sample_id, chain_pos, count(*) AS used FROM (SELECT sample_id, chain_pos, tool AS src, lead(tool) OVER (PARTITION BY sample_id, chain_pos ORDER BY step) AS dst FROM calls) p
  JOIN edges USING (src, dst) GROUP BY sample_id, chain_pos),
named AS (SELECT *, list_filter({_ENTITY_SQL}, lambda x: list_contains(tools, x)) AS refs FROM grouped)"""
_LIST_SQL = "array_to_string({0}, ',')"
_PAIRS_SQL = f"""{_TURNS_SQL},
good AS (SELECT doc_id AS conv_id, max(quality) AS quality FROM labels GROUP BY doc_id),
pairs AS (
  SELECT t.*, conv_id || '-' || turn || '-' || row_number() OVER (PARTITION BY conv_id, turn ORDER BY question NULLS FIRST, answer NULLS FIRST) AS key,
         row_number() OVER (ORDER BY conv_id, turn, question NULLS FIRST, answer NULLS FIRST) AS ord, quality = 1 AS valid, question AS text
  FROM turns t LEFT JOIN good USING (conv_id))"""
_MIXED_SQL = f"""{_PAIRS_SQL},
uniq AS (SELECT key FROM (SELECT *, row_number() OVER (PARTITION BY {_NORM_SQL} ORDER BY ord) AS k FROM pairs WHERE valid) WHERE k = 1),
mixed AS (
  SELECT key AS doc_id, 'generated' AS source, 3 AS n_messages FROM uniq
  UNION ALL SELECT 'x' || conv_id, 'external', CAST(count(*) AS INTEGER) FROM conversations GROUP BY conv_id)"""
_LINES_SQL = r"array_to_string(list_transform(regexp_split_to_array({0}, '\r\n|\n|\r'), lambda x: trim(x)), ' ')"
#: The first and the last word of the chunks that the model sees; items are short enough to be chunks of their own.
_WORDS_SQL = f"""w AS (SELECT item_id, split_part(text, ' ', 1) AS a, split_part(text, ' ', -1) AS b FROM benchmark WHERE trim(regexp_replace(text, '\\s+', ' ', 'g')) <> '' ORDER BY item_id LIMIT {corpus.MAX_CHUNKS}),
l AS (SELECT least(a, b) AS x, greatest(a, b) AS y, arg_min(a, item_id) AS src, arg_min(b, item_id) AS dst FROM w WHERE a <> b AND a <> '' AND b <> '' GROUP BY 1, 2)"""
_SIZE_SQL = "CAST(p_partkey % 5 AS INTEGER)"

ORACLE_SQL = {
    "extracted_chains": f"WITH {_CHAINS_SQL} SELECT * FROM calls",
    "drafted_pairs": f"""WITH {_DRAFTS_SQL} SELECT sample_id, chain_pos,
        'Use the ' || array_to_string(tools, ', ') || CASE WHEN n > 1 THEN ' tools' ELSE ' tool' END || ' to ' || {_VERB_SQL} || ' the following: ' ||
          CASE WHEN len(refs) > 0 THEN array_to_string(refs, ', ') ELSE 'the data' END || '.' AS question,
        md5('{ANSWER_FALLBACK} Chain: ' || chain_id || ' (chain ' || chain_id || '). Key result: ' || first_result) AS answer, {_LIST_SQL.format("tools")} AS tools, {_LIST_SQL.format("refs")} AS refs,
        CAST(n AS INTEGER) AS n_outcomes, 'executed_trace' AS source, CAST(s_nationkey AS BIGINT) AS trace_seed, coalesce(used, 0) AS toolkg_edges_used, CAST({len(ENTITIES)} AS BIGINT) AS kg_entity_count
      FROM named LEFT JOIN linked USING (sample_id, chain_pos) LEFT JOIN supplier ON s_suppkey = sample_id""",
    "generation_counts": f"""WITH {_DRAFTS_SQL}, users AS (SELECT DISTINCT user_id AS sample_id FROM steps)
      SELECT (SELECT count(*) FROM users) AS num_samples, count(*) AS num_chains, (SELECT count(*) FROM users WHERE sample_id NOT IN (SELECT sample_id FROM grouped)) AS num_chains_empty, count(*) AS num_qa_pairs FROM grouped""",
    "chain_texts": f"""WITH {_CHAINS_SQL}, t AS (
        SELECT sample_id, chain_id, 'Chain ' || chain_id || ': chain ' || chain_id || chr(10) || string_agg('  ' || (step + 1) || '. ' || tool || '(' || tool_input || ') -> ' || result_preview, chr(10) ORDER BY step) AS text
        FROM calls GROUP BY sample_id, chain_id)
      SELECT sample_id, chain_id, CAST(length(text) AS INTEGER) AS chars, md5(text) AS hash FROM t""",
    "tool_lines": """WITH t AS (SELECT n_name, repeat('abc ', n_nationkey * 2) AS d FROM nation)
      SELECT string_agg('- ' || n_name || ': ' || CASE WHEN length(d) > 120 THEN left(d, 120) || '...' ELSE d END, chr(10) ORDER BY n_name) AS text FROM t""",
    "request_verbs": "WITH v(k, verb) AS (VALUES "
    + values(tuple((k, REQUEST_VERBS.get(x, "use")) for k, x in enumerate((*REQUEST_VERBS, "grind"))))
    + f") SELECT p_partkey, verb FROM part JOIN v ON k = p_partkey % {len(REQUEST_VERBS) + 1}",
    "parsed_replies": f"""WITH {_TURNS_SQL}, r AS (SELECT *, coalesce(trim(split_part(regexp_replace(trim(question), '\\r\\n|\\r', chr(10), 'g'), chr(10), 1)), '') AS head FROM turns)
      SELECT conv_id, turn, md5(CASE WHEN conv_id % 3 = 2 THEN head ELSE {_LINES_SQL.format("question")} END) AS question,
        md5(CASE WHEN conv_id % 3 = 0 THEN {_LINES_SQL.format("answer")} ELSE '{ANSWER_FALLBACK}' END) AS answer FROM r""",
    "parsed_extractions": "SELECT c_custkey, c_name AS name, c_mktsegment AS type, 'a {customer}' AS description, CAST(c_nationkey AS VARCHAR) AS tail, CAST(NULL AS VARCHAR) AS told FROM customer",
    "normalized_tools": f"""SELECT p_name || '-' || p_partkey AS tool,
        CASE {_SIZE_SQL} WHEN 0 THEN 'Reads the file path' WHEN 1 THEN 'Folder listing' WHEN 2 THEN 'Grinds' WHEN 3 THEN 'Summary text of a tree' ELSE '' END AS description,
        CASE WHEN {_SIZE_SQL} IN (2, 3) THEN '' ELSE 'size' || p_size || ':integer,kind:string,bad:string' END AS inputs,
        CASE WHEN {_SIZE_SQL} IN (2, 3) THEN '' ELSE 'how big,,' END AS told,
        CASE {_SIZE_SQL} WHEN 0 THEN 'path:path' WHEN 1 THEN 'path:path,listing:array' WHEN 3 THEN 'content:content,tree:object,metadata:object' ELSE '' END AS outputs FROM part""",
    "merged_catalogs": """WITH c AS (SELECT 0 AS pos, CAST(n_nationkey AS BIGINT) AS ord, n_name AS name, 'n' AS server FROM nation UNION ALL SELECT 1, p_partkey, p_name, p_brand FROM part)
      SELECT pos * 1099511627776 + ord AS ord, CASE WHEN row_number() OVER (PARTITION BY name ORDER BY pos, ord) > 1 THEN server || '__' || name ELSE name END AS name, server FROM c""",
    "training_records": f"""WITH {_PAIRS_SQL} SELECT key, 'generated' AS source, 3 AS n_messages, 'generated' AS said, 'executed_trace' AS origin, CAST(conv_id AS VARCHAR) AS chain_id,
        CASE WHEN turn > 0 THEN '0.5' END AS coverage, CAST(conv_id AS VARCHAR) AS ref, CAST(valid AS VARCHAR) AS valid, md5(question) AS question FROM pairs""",
    "assembled_mix": f"WITH {_MIXED_SQL} SELECT doc_id AS key, source, {_SPLIT_SQL} AS split, n_messages FROM mixed",
    "assembled_report": f"""WITH {_MIXED_SQL}, s AS (SELECT source, {_SPLIT_SQL} AS split FROM mixed), n AS (SELECT count(*) AS total, count(*) FILTER (WHERE source = 'external') AS ext,
        count(*) FILTER (WHERE source = 'generated') AS gen, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'valid') AS valid FROM s)
      SELECT (SELECT count(*) FROM pairs) AS n_in, (SELECT count(*) FROM pairs WHERE valid) AS n_after_cutoffs, ext AS n_external_in, (SELECT count(*) FROM pairs WHERE valid) - gen AS n_dupes_removed,
        total AS n_records_total, train AS n_train, valid AS n_valid, gen AS n_generated FROM n""",
    "semantic_filtered": f"""WITH {_TURNS_SQL}, t AS (SELECT conv_id, turn, coalesce(question, '') AS question, coalesce(answer, '') AS answer FROM turns)
      SELECT conv_id, turn, md5(question) AS question, md5(answer) AS answer, length(question) - length(replace(question, ' ', '')) < 40 OR NOT contains(question, ' ') AS accepted FROM t""",
    "model_decisions": """WITH l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
      r AS (SELECT doc_id, quality = 1 AS valid, CASE WHEN toxic = 1 THEN 0.25::DOUBLE WHEN doc_id % 7 > 0 THEN 1.0::DOUBLE END AS coverage, coalesce(source, '') AS ref, lang = 'en' AS known FROM documents JOIN l USING (doc_id)),
      p AS (SELECT *, coalesce(coverage, 0) * CASE WHEN valid THEN 0.9::DOUBLE ELSE 0.4::DOUBLE END AS p, valid AND coalesce(coverage >= 0.5, true) AND coalesce(known, false) AS gates FROM r)
      SELECT doc_id, CASE WHEN CASE WHEN ref = 'src0' OR p = 0 THEN gates ELSE p >= 0.5 END THEN 'accept' ELSE 'reject' END AS verdict, CASE WHEN ref <> 'src0' AND p > 0 THEN p END AS confidence,
        CASE WHEN ref <> 'src0' AND p > 0 AND valid THEN p END AS grounded, CASE WHEN ref = 'src0' OR p = 0 THEN 'heuristic_fallback' ELSE 'model' END AS source,
        CASE WHEN ref = 'src0' THEN 'ValueError: no opinion' WHEN p = 0 THEN 'ValueError: probability out of range: 2.0' END AS error FROM p""",
    "redacted_pairs": f"""WITH r AS (SELECT doc_id, md5({_redacted_sql()[0]}) AS h FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))
      SELECT doc_id, h AS question, h AS answer, h AS result, '{{"k": "a@example.org"}}' AS input FROM r""",
    "critique_blocks": "SELECT doc_id, '" + refine.CRITIQUE_HEAD + "' || array_to_string(list_transform(list_filter([source, lang], lambda x: x IS NOT NULL), lambda x: '- ' || x), chr(10)) || chr(10) AS block FROM documents",
    "spec_nodes": """SELECT r_name AS id, r_name AS entity_name, CASE WHEN r_regionkey > 1 THEN 'region' ELSE 'concept' END AS entity_type, 'part of the world' AS description FROM region
      UNION ALL SELECT n_name, n_name, 'concept', n_name FROM nation""",
    "spec_edges": "SELECT n_name AS src, r_name AS dst, 'lies in' AS relation, n_name || ' lies in ' || r_name AS description FROM nation JOIN region ON n_regionkey = r_regionkey",
    "united_nodes": """SELECT n_name AS id, n_name AS entity_name, 'market+nation' AS entity_type, 'a market of some size' AS description FROM nation
      UNION ALL SELECT r_name, r_name, 'region', r_name FROM region""",
    "united_edges": "SELECT n_name AS src, r_name AS dst, 'lies in' AS relation, n_name || ' lies in ' || r_name AS description FROM nation JOIN region ON n_regionkey = r_regionkey",
    "rendered_context": f"""WITH k AS ({GRAPHS_SQL["kg_budget_prefix"]}),
      h AS (SELECT section, rank, line FROM k UNION ALL VALUES (0, 0, 'Domain entities:'), (1, 0, chr(10) || 'Key relationships:'), (2, 0, chr(10) || 'Topic clusters:'))
      SELECT string_agg(line, chr(10) ORDER BY section, rank) AS text FROM h""",
    "corpus_nodes": f"""WITH {_WORDS_SQL} SELECT a AS id, a AS entity_name, 'word' AS entity_type, 'opens a text' AS description FROM (SELECT DISTINCT a FROM w WHERE a <> '')
      UNION ALL SELECT b, b, 'concept', b FROM (SELECT DISTINCT b FROM w WHERE a <> '' AND b <> '' AND b NOT IN (SELECT a FROM w))""",
    "corpus_edges": f"WITH {_WORDS_SQL} SELECT src, dst, 'before' AS relation, src || ' before ' || dst AS description FROM l",
    "uniform_parts": f"SELECT p_partkey, p_name FROM part ORDER BY md5(p_partkey || ':42'), p_partkey LIMIT {SAMPLE_ROWS}",
    "walk_invariants": "SELECT CAST(3 AS BIGINT) AS n, CAST(3 AS BIGINT) AS tools, 2 AS last, count(DISTINCT user_id) AS walks, CAST(0 AS BIGINT) AS unknown FROM events",
}
