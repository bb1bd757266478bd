"""Scores, gates, critiques and the refinement loop."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.text import estimate_tokens, filled
from loomline.operators.traces import grounded, parse_reply, prompt_column, with_model
from loomline.operators.verify import coverage, verify
from loomline.session import cut, ship

KEYS = ["sample_id", "chain_pos"]

# The wording of a critique, with a place for each value.
MISSING_TOOL = "The chain calls tool '{}' which is not available. Rewrite the question so it only needs available tools, or fix the tool name."
BAD_ARGUMENTS = "Step {} ({}) has invalid arguments: {}. Correct the tool arguments."
FAILED_STEP = "Step {} ({}) failed when executed: {}. Adjust the chain usage."
LOW_COVERAGE = "Only {} of consecutive tool pairs are composable according to the ToolKG (minimum {}). Prefer tool sequences whose outputs feed the next tool's inputs."
UNGROUNDED = "The question is not anchored to any knowledge-graph entity."
NAME_ONE_OF = " Name one of these exact KG entities in the question: {}."
NAME_ANY = " Name a real entity from the KG context in the question."
EMPTY_ANSWER = "The answer draft is empty. Write an answer that the tool chain results support."
CRITIQUE_HEAD = "\n\n## Critique of your previous attempt\nAddress EVERY point below in your regenerated QUESTION and ANSWER:\n"


@dataclass(frozen=True)
class RefineConfig:
    max_iterations: int = 3
    min_coverage: float = 0.5
    require_chain_valid: bool = True
    require_entities: bool = True
    seed: int = 42


def score(rows: DataFrame, catalog: DataFrame, edges: DataFrame | None, entities: DataFrame, keys: list[str] = KEYS, **how) -> DataFrame:
    """``rows`` with verification, coverage, entity_grounded, question_tokens and answer_tokens."""
    names = entities.agg(F.collect_set("name").alias("_names"))
    checked = verify(rows, catalog, keys, **how).join(coverage(rows, edges, keys), keys, "left")
    return checked.join(F.broadcast(names)).withColumns({
        "entity_grounded": grounded(F.col("entity_refs"), F.col("_names"), F.col("question")),
        "question_tokens": estimate_tokens(F.col("question")),
        "answer_tokens": estimate_tokens(F.col("answer_draft")),
    }).drop("_names")


def passes(config: RefineConfig = RefineConfig()) -> Column:
    """Whether a scored row passes the gates: no coverage and no intent, where nothing is known, do not fail it."""
    valid = F.coalesce(F.col("verification.chain_valid"), F.lit(False)) if config.require_chain_valid else F.lit(True)
    aligned = F.coalesce(F.col("verification.intent_aligned"), F.lit(True))
    covered = F.col("coverage").isNull() | (F.col("coverage") >= config.min_coverage)
    known = F.coalesce("entity_grounded", F.lit(False)) if config.require_entities else F.lit(True)
    return valid & aligned & covered & known


def _percent(x: Column) -> Column:
    return F.concat(F.round(100 * x, 0).cast("int").cast("string"), F.lit("%"))


def critique(config: RefineConfig = RefineConfig()) -> Column:
    """What to mend in a scored row, in order: tools, arguments, failures, coverage, grounding, answer."""
    v, none = F.col("verification"), F.array().cast("array<string>")
    missing = F.transform(v["missing_tools"], lambda tool: filled(MISSING_TOOL, tool))
    bad = F.transform(v["schema_mismatches"], lambda m: filled(BAD_ARGUMENTS, m["step"], m["tool"], F.array_join(m["problems"], "; ")))
    broken = F.filter(v["executed_steps"], lambda s: ~s["ok"] & s["error"].isNotNull() & ~F.contains(s["error"], F.lit("missing tool")))
    failed = F.transform(broken, lambda s: filled(FAILED_STEP, s["step"], s["tool"], s["error"]))
    steps = F.when(v["chain_valid"], none).otherwise(F.concat(*(F.coalesce(x, none) for x in (missing, bad, failed))))
    thin = F.when(
        F.col("coverage") < config.min_coverage, filled(LOW_COVERAGE, _percent(F.col("coverage")), F.lit(f"{config.min_coverage:.0%}"))
    )
    name = F.when(F.size("entity_refs") > 0, filled(NAME_ONE_OF, F.array_join("entity_refs", ", "))).otherwise(NAME_ANY)
    loose = F.when(F.lit(config.require_entities) & ~F.col("entity_grounded"), F.concat(F.lit(UNGROUNDED), name))
    empty = F.when(F.trim(F.coalesce("answer_draft", F.lit(""))) == "", EMPTY_ANSWER)
    return F.concat(steps, F.filter(F.array(thin, loose, empty), lambda x: x.isNotNull()))


def critique_block(issues: Column) -> Column:
    """The critique as the end of a prompt."""
    return F.concat(F.lit(CRITIQUE_HEAD), F.array_join(F.transform(issues, lambda x: F.concat(F.lit("- "), x)), "\n"), F.lit("\n"))


def semantic_filter(rows: DataFrame, keep: Callable[[dict], bool] | None) -> DataFrame:
    """``rows`` with ``accepted``: what a predicate on the whole row says; true where it fails or there is none."""
    if keep is None:
        return rows.withColumn("accepted", F.lit(True))
    ship(rows.sparkSession)

    def judged(row: dict) -> bool:
        try:
            return bool(keep(row))
        except Exception:  # a broken filter keeps the row
            return True

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([judged(row) for row in batch.to_dict("records")])

    return rows.withColumn("accepted", F.pandas_udf(run, "boolean")(F.struct(*rows.columns)))


def decide(rows: DataFrame, decider: Callable[[str], dict], threshold: float, config: RefineConfig = RefineConfig()) -> DataFrame:
    """``rows`` with ``decision`` (verdict, confidence, grounded, source, error) of a decision model.

    The model takes the request as JSON and returns its response; it accepts from ``threshold`` on of P(accept). A
    failure, or a probability that is none, leaves the verdict to the gates.
    """
    import json

    ship(rows.sparkSession)
    fields = "verdict string, confidence double, grounded double, source string, error string"

    def one(request: str, gates: bool) -> dict:
        try:
            answers = decider(json.loads(request)).get("answers") or {}
            p = float(answers["verdict"]["probabilities"]["accept"])
            if not 0.0 <= p <= 1.0:
                raise ValueError(f"probability out of range: {p}")
            known = (answers.get("grounded") or {}).get("noul")
            return {
                "verdict": "accept" if p >= threshold else "reject",
                "confidence": p,
                "grounded": None if known is None else float(known),
                "source": "model",
                "error": None,
            }
        except Exception as e:  # the gates decide instead
            return {
                "verdict": "accept" if gates else "reject",
                "confidence": None,
                "grounded": None,
                "source": "heuristic_fallback",
                "error": f"{type(e).__name__}: {e}",
            }

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for requests, gates in batches:
            yield pd.DataFrame(
                [one(r, bool(g)) for r, g in zip(requests, gates, strict=True)], columns=[x.split()[0] for x in fields.split(", ")]
            )

    return rows.withColumn("decision", F.pandas_udf(run, fields)(decision_request(), passes(config)))


def decision_request() -> Column:
    """What the decision model is asked about a scored row, as JSON."""
    steps = F.transform(
        "chain", lambda x: F.struct(x["tool"].alias("tool"), (F.coalesce(x["result_preview"], F.lit("")) != "ERROR").alias("ok"))
    )
    scores = F.struct(
        F.col("verification.chain_valid").alias("chain_valid"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        "entity_grounded",
        "entity_refs",
    )
    return F.to_json(F.struct(F.struct("question", "answer_draft", steps.alias("chain"), scores.alias("keyless_scores")).alias("state")))


def iteration_metrics() -> Column:
    """The metrics of one round over rows with ``kept`` and ``accepted``, as one struct to aggregate."""
    kept, filtered = F.col("kept") & F.col("accepted"), F.col("kept") & ~F.col("accepted")
    return F.struct(
        F.count("*").alias("num_pairs"),
        F.count_if("verification.chain_valid").alias("num_chain_valid"),
        F.count_if("entity_grounded").alias("num_entity_grounded"),
        F.coalesce(F.avg("coverage"), F.lit(0.0)).alias("mean_coverage"),
        F.count_if(kept).alias("num_kept"),
        (F.count_if(~F.col("kept")) + F.count_if(filtered)).alias("num_rejected"),
        F.count_if(filtered).alias("num_semantic_filtered"),
    )


def refine(rows: DataFrame, catalog: DataFrame, edges: DataFrame | None, entities: DataFrame, model: Callable[[str], str] | None = None, keep: Callable[[dict], bool] | None = None, config: RefineConfig = RefineConfig(), context: str = "", tools: str = "(no tool catalog graph)", **how) -> tuple[
    DataFrame, dict
]:
    """The rows that pass, with their scores, and the ledger of the rounds.

    Each round scores, gates and filters; what the gates reject is drafted anew with its critique, and what the filter
    rejects goes. It ends when all pass, when there is no model to draft with, or after the last round, with a final
    gate. A round's rows are written to the shared folder, so that the plan doesn't grow, unless nothing can follow on
    them and nothing but columns judges them: then they are counted as they come. Rows are known by (sample_id, chain_pos).
    """
    ledger: dict = {"config": asdict(config), "iterations": [], "stopped_reason": ""}
    now = rows.withColumn("refinement_attempt", F.lit(0)).withColumn("critique", F.array().cast("array<string>"))
    columns = now.columns

    def gated(df: DataFrame) -> DataFrame:
        scored = score(df, catalog, edges, entities, **how).withColumn("kept", passes(config))
        if keep is None:
            judged = scored.withColumn("accepted", F.col("kept"))
            return judged if model is None and how.get("registry") is None else cut(judged)
        scored = cut(scored)
        good = semantic_filter(scored.where("kept"), keep)
        return cut(good.unionByName(scored.where("not kept").withColumn("accepted", F.lit(False))))

    for iteration in range(max(1, config.max_iterations)):
        scored = gated(now)
        found = scored.agg(iteration_metrics().alias("m")).first()["m"].asDict()
        metrics = {"iteration": iteration, **found, "num_refined": 0}
        ledger["iterations"].append(metrics)
        done = scored.where("kept and accepted")
        if not found["num_rejected"] or model is None:
            ledger["stopped_reason"] = "no_llm_refinement" if found["num_rejected"] else "all_pass"
            return done.drop("kept", "accepted"), ledger
        issues = scored.where("not kept").withColumn("critique", critique(config))
        described = issues if "description" in issues.columns else issues.withColumn("description", F.lit(""))
        text = F.concat(prompt_column(context, tools), critique_block(F.col("critique")))
        drafted = with_model(described.withColumn("prompt", text), "prompt", "text", model).withColumn("reply", parse_reply(F.col("text")))
        again = drafted.withColumns(
            {
                "question": F.col("reply.question"),
                "answer_draft": F.col("reply.answer"),
                "refinement_attempt": F.col("refinement_attempt") + 1,
            }
        )
        metrics["num_refined"] = found["num_pairs"] - found["num_kept"] - found["num_semantic_filtered"]
        now = cut(done.select(columns).unionByName(again.select(columns)))
    ledger["stopped_reason"] = "max_iterations"
    return gated(now).where("kept and accepted").drop("kept", "accepted"), ledger
