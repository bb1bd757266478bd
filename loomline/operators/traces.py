"""From workflow samples to question-answer rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomline.functions.facts import ANSWER_FALLBACK, expected_outcome, request_verb
from loomline.functions.text import bound, clipped, filled
from loomline.session import ship

#: A sample as JSON: dynamic keys as a map, each step a pair of an action and a result as they are written.
SAMPLE_SCHEMA = "query string, response string, api_use_chains map<string, struct<chain_id:string, description:string, intermediate_steps:array<array<string>>>>"
ACTION_SCHEMA = "struct<tool:string, tool_input:string, log:string, tool_call_id:string, type:string>"
STEP = "struct<tool:string, tool_input:string, result_preview:string>"
PREVIEW_CHARS = 300

# The wording of messages and of drafts, with a place for each value.
SYSTEM_PROMPT = "You are a helpful assistant that answers questions by calling tools. Use the tools listed; do not rely on general knowledge."

USER_MESSAGE = "{}\n\nAvailable tools: {}"
ASSISTANT_MESSAGE = "Executed chain:\n{}\n\nAnswer: {}"
STEP_LINE = "{}. {}({}) -> {}"
QUESTION = "Use the {}{} to {} the following: {}."
ANSWER = ANSWER_FALLBACK + " Chain: {} ({}). Key result: {}"


def extract_chains(samples: DataFrame) -> DataFrame:
    """(sample_id, chain_pos, chain_id, description, chain): one row for each chain with a step that names a tool.

    ``samples`` has (sample_id, api_use_chains). Steps without a tool go, and then chains without steps. An input
    that is no object counts as an empty one.
    """
    pairs = samples.select("sample_id", F.posexplode(F.map_entries("api_use_chains")).alias("chain_pos", "entry"))

    def step(pair: Column) -> Column:
        result = clipped(F.coalesce(F.get(pair, 1), F.lit("null")), PREVIEW_CHARS)

        def told(action: Column) -> Column:
            given = F.when(F.ltrim(action["tool_input"]).startswith("{"), action["tool_input"]).otherwise("{}")
            return F.struct(action["tool"].alias("tool"), given.alias("tool_input"), result.alias("result_preview"))

        return bound(F.from_json(F.get(pair, 0), ACTION_SCHEMA), told)

    steps = F.filter(F.transform(F.col("entry.value.intermediate_steps"), step), lambda x: F.coalesce(x["tool"], F.lit("")) != "")
    # a chain is taken from an array of one, which is empty where the chain is: a filter on it would be pushed below, and
    # parse all actions once more
    filled_ones = F.filter(F.array(steps.cast(f"array<{STEP}>")), lambda x: F.size(x) > 0)
    return pairs.select(
        "sample_id",
        "chain_pos",
        F.col("entry.key").alias("chain_id"),
        F.coalesce("entry.value.description", F.lit("")).alias("description"),
        F.explode(filled_ones).alias("chain"),
    )


def tools_of(chain: Column) -> Column:
    return F.transform(chain, lambda x: x["tool"])


def haystack(chain: Column) -> Column:
    """What a chain mentions, in lower case: tools, results and the values of inputs."""
    def words(x: Column) -> Column:
        values = F.map_values(F.coalesce(F.from_json(x["tool_input"], "map<string,string>"), F.create_map().cast("map<string,string>")))
        return F.concat_ws("\n", x["tool"], x["result_preview"], F.array_join(values, "\n"))

    return F.lower(F.array_join(F.transform(chain, words), "\n"))


def ground_entities(chains: DataFrame, entities: DataFrame, chain_col: str = "chain") -> DataFrame:
    """``chains`` with entity_refs: the entities (pos, name) whose names the chain mentions, in their order.

    The entities are those of an exported context, whose caps bound them, so they go along as one array.
    """
    names = entities.where(F.coalesce("name", F.lit("")) != "").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]).alias("_names")
    )
    found = bound(haystack(F.col(chain_col)), lambda hay: F.filter("_names", lambda n: F.contains(hay, F.lower(n))))
    return chains.join(F.broadcast(names)).withColumn("entity_refs", found).drop("_names")


def grounded(refs: Column, names: Column, question: Column) -> Column:
    """Whether there are references, all of them are known, and the question names one."""
    asks = bound(F.lower(F.coalesce(question, F.lit(""))), lambda asked: F.exists(refs, lambda r: F.contains(asked, F.lower(r))))
    return (F.size(F.coalesce(refs, F.array().cast("array<string>"))) > 0) & F.forall(refs, lambda r: F.array_contains(names, r)) & asks


def template_question(chain: Column, refs: Column) -> Column:
    tools = tools_of(chain)
    anchor = F.when(F.size(refs) > 0, F.array_join(refs, ", ")).otherwise("the data")
    noun = F.when(F.size(tools) > 1, " tools").otherwise(" tool")
    return filled(QUESTION, F.array_join(tools, ", "), noun, request_verb(F.get(tools, 0)), anchor)


def template_answer(chain_id: Column, description: Column, chain: Column) -> Column:
    return filled(ANSWER, chain_id, description, F.get(chain, 0)["result_preview"])


def parse_reply(text: Column) -> Column:
    """(question, answer) of a reply with QUESTION: and ANSWER: lines, which may go on in the lines after them.

    Without a QUESTION: line the first line is the question; without an answer there is a fallback.
    """
    lines = F.split(F.coalesce(text, F.lit("")), r"\r\n|\n|\r")
    start = F.struct(F.lit("").alias("q"), F.lit("").alias("a"))

    def fold(state: Column, line: Column) -> Column:
        upper, rest = F.upper(F.trim(line)), F.trim(F.regexp_replace(line, r"^[^:]*:", ""))
        q = F.when(upper.startswith("QUESTION:"), rest).when(~upper.startswith("ANSWER:") & (state["q"] != "") & (state["a"] == ""), F.concat(state["q"], F.lit(" "), F.trim(line))).otherwise(
            state["q"]
        )
        more = ~upper.startswith("QUESTION:") & (state["a"] != "")
        a = F.when(upper.startswith("ANSWER:") & ~upper.startswith("QUESTION:"), rest).when(more, F.concat(state["a"], F.lit(" "), F.trim(line))).otherwise(
            state["a"]
        )
        return F.struct(q.alias("q"), a.alias("a"))

    out = F.aggregate(lines, start, fold)
    first = F.trim(F.get(F.split(F.trim(text), r"\r\n|\n|\r"), 0))
    return F.struct(
        F.when(out["q"] != "", out["q"]).otherwise(F.coalesce(first, F.lit(""))).alias("question"),
        F.when(out["a"] != "", out["a"]).otherwise(ANSWER_FALLBACK).alias("answer"),
    )


def with_model(df: DataFrame, prompt_col: str, out_col: str, model: Callable[[str], str]) -> DataFrame:
    """``df`` with what a text model replies to each prompt; the one place where a row meets Python code."""
    ship(df.sparkSession)

    def replies(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for prompts in batches:
            yield prompts.map(model)

    return df.withColumn(out_col, F.pandas_udf(replies, "string")(prompt_col))


def chain_text(chain_id: Column, description: Column, chain: Column) -> Column:
    """A chain as the prompt shows it."""
    lines = F.transform(chain, lambda x, i: filled("  " + STEP_LINE, i + 1, x["tool"], x["tool_input"], x["result_preview"]))
    return F.concat(F.lit("Chain "), chain_id, F.lit(": "), description, F.lit("\n"), F.array_join(lines, "\n"))


def tool_summaries(tools: DataFrame) -> DataFrame:
    """One row, ``text``: a line for each tool of the graph (tool, description) by name, descriptions cut at 120 characters."""
    line = F.concat(F.lit("- "), "tool", F.lit(": "), clipped(F.coalesce("description", F.lit("")), 120))
    every = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tool", line.alias("line")))), lambda x: x["line"]), "\n")
    return tools.agg(F.when(F.count("*") == 0, "(empty tool catalog)").otherwise(every).alias("text"))


PROMPT = (
    "You write training questions for an agent that calls tools.\n\nDomain knowledge:\n{context}\n\nExecuted chain:\n{chain}\n\n"
    "Write one request that names entities from the domain knowledge and that only the executed chain can fulfil, and draft "
    "the answer from the results.\nQUESTION: <the request>\nANSWER: <the draft answer>\n"
)


def prompt_column(context: str, tools: str) -> Column:
    """The prompt of a row with chain_id, description and chain."""
    shown = F.concat(chain_text(F.col("chain_id"), F.col("description"), F.col("chain")), F.lit(f"\n\nAvailable tools:\n{tools}"))
    before, _, after = PROMPT.replace("{context}", context).partition("{chain}")
    return F.concat(F.lit(before), shown, F.lit(after))


def qa_rows(samples: DataFrame, entities: DataFrame, tracers: DataFrame | None = None, edges: DataFrame | None = None, model: Callable[[str], str] | None = None, context: str = "", tools: str = "(no tool catalog graph)", copies: int = 1) -> DataFrame:
    """One row (times ``copies``) for each executed chain: question, draft answer, what it took and what it shows.

    ``tracers`` (sample_id, seed) gives the seed of the run; ``edges`` (src, dst) the composability graph, of which
    the consecutive pairs are counted. Without a model the texts come from a template.
    """
    chains = ground_entities(extract_chains(samples), entities)
    c = F.col
    if model is None:
        drafted = chains.withColumn(
            "reply",
            F.struct(
                template_question(c("chain"), c("entity_refs")).alias("question"),
                template_answer(c("chain_id"), c("description"), c("chain")).alias("answer"),
            ),
        )
    else:
        drafted = with_model(chains.withColumn("prompt", prompt_column(context, tools)), "prompt", "text", model)
        drafted = drafted.withColumn("reply", parse_reply(c("text")))
    seeded = drafted.join(tracers.select("sample_id", c("seed").alias("trace_seed")), "sample_id", "left") if tracers is not None else drafted.withColumn(
        "trace_seed", F.lit(None).cast("long")
    )
    if edges is None:
        counted = seeded.withColumn("edges_used", F.lit(0).cast("long"))
    else:
        used = edges_used(seeded.select("sample_id", "chain_pos", "chain"), edges, ["sample_id", "chain_pos"])
        counted = seeded.join(used, ["sample_id", "chain_pos"], "left").withColumn(
            "edges_used", F.coalesce("edges_used", F.lit(0)).cast("long")
        )
    known = entities.where(F.coalesce("name", F.lit("")) != "").agg(F.count("*").alias("kg_entity_count"))
    source = F.struct(
        F.lit("executed_trace").alias("source"), "chain_id", "trace_seed", c("edges_used").alias("toolkg_edges_used"), "kg_entity_count"
    )
    outcomes = F.transform("chain", lambda x: expected_outcome(x["tool"], x["result_preview"]))
    rows = counted.join(F.broadcast(known)).select(
        "sample_id", "chain_pos", "chain_id", c("reply.question").alias("question"), c("reply.answer").alias("answer_draft"), tools_of(c("chain")).alias(
            "required_tools"
        ),
        "chain", "entity_refs", outcomes.alias("expected_outcomes"), source.alias("provenance"),
    )
    return rows if copies <= 1 else rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")


def consecutive(chains: DataFrame, keys: list[str], chain_col: str = "chain") -> DataFrame:
    """(keys, src, dst) of each pair of neighbours among the steps that name a tool."""
    names = F.filter(tools_of(F.col(chain_col)), lambda x: F.coalesce(x, F.lit("")) != "")
    pairs = F.arrays_zip(
        F.slice(names, F.lit(1), F.greatest(F.size(names) - 1, F.lit(0))).alias("src"),
        F.slice(names, F.lit(2), F.greatest(F.size(names) - 1, F.lit(0))).alias("dst"),
    )
    return chains.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.src", "p.dst")


def edges_used(chains: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, edges_used): how many neighbours of a chain are edges."""
    return consecutive(chains, keys).join(edges.select("src", "dst").distinct(), ["src", "dst"], "left_semi").groupBy(*keys).agg(
        F.count("*").alias("edges_used")
    )


def generation_stats(samples: DataFrame, rows: DataFrame) -> DataFrame:
    """One row: num_samples, num_chains, num_chains_empty (samples without a chain) and num_qa_pairs."""
    per = samples.select("sample_id").join(rows.groupBy("sample_id").agg(F.countDistinct("chain_pos").alias("chains"), F.count("*").alias("pairs")), "sample_id", "left").na.fill(
        0
    )
    return per.agg(
        F.count("*").alias("num_samples"),
        F.coalesce(F.sum("chains"), F.lit(0)).alias("num_chains"),
        F.count_if(F.col("chains") == 0).alias("num_chains_empty"),
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("num_qa_pairs"),
    )


def chat_messages(question: Column, answer: Column, tools: Column, chain: Column) -> Column:
    """System, user and assistant messages; the assistant's shows the executed steps before the answer."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    lines = F.transform(chain, lambda x, i: filled(STEP_LINE, i + 1, x["tool"], x["tool_input"], x["result_preview"]))
    asked = filled(USER_MESSAGE, question, F.array_join(tools, ", "))
    told = filled(ASSISTANT_MESSAGE, F.array_join(lines, "\n"), answer)
    return F.array(message("system", F.lit(SYSTEM_PROMPT)), message("user", asked), message("assistant", told))


def ordered_chain(events: DataFrame, key: str, order: list[str], tool: str, tool_input: str, result: str) -> DataFrame:
    """(key, chain) from rows of single steps."""
    step = F.struct(
        *order, F.col(tool).alias("tool"), F.col(tool_input).alias("tool_input"), F.col(result).cast("string").alias("result_preview")
    )
    steps = F.transform(
        F.array_sort(F.collect_list(step)),
        lambda x: F.struct(x["tool"].alias("tool"), x["tool_input"].alias("tool_input"), x["result_preview"].alias("result_preview")),
    )
    return events.groupBy(key).agg(steps.alias("chain"))


def numbered(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    return df.withColumn("step", F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1)
