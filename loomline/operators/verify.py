"""Verification of executed chains: catalog, schema, execution, coverage and business checks."""

from __future__ import annotations

import asyncio
import inspect
import json
import queue
import threading
from collections.abc import Awaitable, Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.intent import intent_aligned
from loomline.functions.text import bound
from loomline.operators.traces import consecutive, tools_of
from loomline.session import ship

#: Seconds that a tool's function may take.
CALL_SECONDS = 60.0

# How a JSON value of each type is called, and which values a schema's type takes. A boolean passes as an
# integer and as a number.
ACCEPTED = {
    "string": ("str",),
    "integer": ("int", "bool"),
    "number": ("int", "float", "bool"),
    "boolean": ("bool",),
    "array": ("list",),
    "object": ("dict",),
}
VALUE_NAMES = {"STRING": "str", "BIGINT": "int", "BOOLEAN": "bool", "VOID": "NoneType"}


def value_name(kind: Column) -> Column:
    """What a JSON value is called, by its variant's schema."""
    named = F.create_map(*(F.lit(x) for pair in VALUE_NAMES.items() for x in pair))
    return F.when(kind.startswith("ARRAY"), "list").when(kind.startswith("OBJECT"), "dict").when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "float").otherwise(
        F.coalesce(F.try_element_at(named, kind), F.lit("NoneType"))
    )


def declared(schema: Column) -> tuple[Column, Column]:
    """The required properties of a JSON schema, and its properties' types by name; once for each tool."""
    parsed = F.from_json(schema, "required array<string>, properties map<string, struct<type:string>>")
    types = F.transform_values(parsed["properties"], lambda _, x: x["type"])
    return F.coalesce(parsed["required"], F.array().cast("array<string>")), F.coalesce(types, F.create_map().cast("map<string,string>"))


def schema_problems(tool_input: Column, required: Column, types: Column) -> Column:
    """What is wrong with an input: required properties it lacks, then values of another type than declared."""
    keys = F.json_object_keys(tool_input)
    missing = F.transform(
        F.filter(required, lambda x: ~F.array_contains(keys, x)), lambda x: F.concat(F.lit("missing required property '"), x, F.lit("'"))
    )
    accepted = F.create_map(*(x for kind, names in ACCEPTED.items() for x in (F.lit(kind), F.array(*map(F.lit, names)))))
    # the input is parsed once, each value's type is taken once
    values = F.map_entries(F.from_json(tool_input, "map<string, variant>"))
    kinds = F.transform(values, lambda x: F.struct(x["key"].alias("key"), F.schema_of_variant(x["value"]).alias("kind")))
    named = F.transform(kinds, lambda x: F.struct(x["key"].alias("key"), F.try_element_at(types, x["key"]).alias("want"), value_name(x["kind"]).alias("got")))
    wrong = F.filter(named, lambda x: ~F.coalesce(F.array_contains(F.try_element_at(accepted, x["want"]), x["got"]), F.lit(True)))
    told = F.transform(wrong, lambda x: F.concat(F.lit("property '"), x["key"], F.lit("' should be "), x["want"], F.lit(", got "), x["got"]))
    return F.when(keys.isNull(), F.array(F.lit("tool_input is not an object"))).otherwise(
        F.concat(missing, F.coalesce(told, F.array().cast("array<string>")))
    )


def explode_steps(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.select(*keys, F.posexplode("chain").alias("step", "s")).select(*keys, "step", "s.tool", "s.tool_input")


def check_steps(rows: DataFrame, catalog: DataFrame, keys: list[str], replay: DataFrame | None = None, registry: Mapping[str, Callable] | None = None, seconds: float = CALL_SECONDS) -> DataFrame:
    """(keys, step, tool, missing, problems, ok, error) of each step.

    A step fails if the catalog (tool, input_schema) lacks its tool, else if its input has problems, else if it can't be
    executed. Execution is looked up in ``replay`` (tool, tool_input, error: null if it went well) or tried with the
    functions of ``registry``, ``seconds`` each at most; with neither, it counts as well. A failed step doesn't stop later ones.
    """
    required, types = declared(F.col("input_schema"))
    known = catalog.select("tool", required.alias("required"), types.alias("types"), F.lit(True).alias("known"))
    steps = explode_steps(rows, keys).join(known, "tool", "left")
    checked = steps.withColumn("missing", F.col("known").isNull()).withColumn(
        "problems",
        F.when(F.col("missing"), F.array().cast("array<string>")).otherwise(schema_problems(F.col("tool_input"), F.col("required"), F.col("types"))),
    )
    if replay is not None:
        ran = checked.join(replay.select("tool", "tool_input", F.col("error").alias("ran")), ["tool", "tool_input"], "left")
    elif registry is not None:
        sound = ~F.col("missing") & (F.size("problems") == 0)
        # only steps that passed the gates are executed
        ran = checked.where(sound).withColumn("ran", executed(registry, seconds)("tool", "tool_input")).unionByName(
            checked.where(~sound).withColumn("ran", F.lit(None).cast("string"))
        )
    else:
        ran = checked.withColumn("ran", F.lit(None).cast("string"))
    error = F.when(F.col("missing"), F.concat(F.lit("missing tool: '"), F.coalesce("tool", F.lit("None")), F.lit("'"))).when(F.size("problems") > 0, F.array_join("problems", "; ")).otherwise(
        F.col("ran")
    )
    return ran.select(*keys, "step", "tool", "missing", "problems", error.isNull().alias("ok"), error.alias("error"))


def tried(call: Callable, given: Mapping, seconds: float = CALL_SECONDS) -> str | None:
    """The error of a call, null if there is none. What a function returns to be awaited is awaited.

    A call that takes longer is an error; its thread is left behind and ends with its worker.
    """
    ended: queue.SimpleQueue = queue.SimpleQueue()

    async def awaited(value: Awaitable) -> None:
        await value

    def run() -> None:
        try:
            value = call(**given)
            if inspect.isawaitable(value):
                asyncio.run(awaited(value))
        except BaseException as e:  # the error is the result
            ended.put(f"{type(e).__name__}: {e}")
        else:
            ended.put(None)

    threading.Thread(target=run, daemon=True).start()
    try:
        return ended.get(timeout=seconds)
    except queue.Empty:
        return f"TimeoutError: no result after {seconds:g} s"


def executed(registry: Mapping[str, Callable], seconds: float = CALL_SECONDS) -> Callable[..., Column]:
    """A column function: the error of calling a tool's function with its input, null if there is none."""

    def one(tool: str, tool_input: str) -> str | None:
        if tool not in registry:
            return f"KeyError: {tool!r}"
        return tried(registry[tool], json.loads(tool_input), seconds)

    def calls(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for tools, inputs in batches:
            yield pd.Series([one(t, i) for t, i in zip(tools, inputs, strict=True)], dtype=object)

    return F.pandas_udf(calls, "string")


def coverage(rows: DataFrame, edges: DataFrame | None, keys: list[str]) -> DataFrame:
    """(keys, coverage): the share of a chain's consecutive pairs that are edges.

    Null for a chain of one tool, which has no pair; zero for an empty one, and without a graph.
    """
    names = F.size(F.filter(tools_of(F.col("chain")), lambda x: F.coalesce(x, F.lit("")) != ""))
    sized = rows.select(*keys, names.alias("n"))
    if edges is None:
        counted = sized.withColumn("hits", F.lit(0))
    else:
        hits = consecutive(rows, keys).join(edges.select("src", "dst").distinct(), ["src", "dst"], "left_semi").groupBy(*keys).agg(
            F.count("*").alias("hits")
        )
        counted = sized.join(hits, keys, "left")
    share = F.coalesce("hits", F.lit(0)) / (F.col("n") - 1)
    return counted.select(*keys, F.when(F.col("n") == 0, 0.0).when(F.col("n") == 1, None).otherwise(share).alias("coverage"))


def business_checks(rows: DataFrame) -> dict[str, Column]:
    """The checks apart from execution, by name. ``rows`` has question, answer_draft, chain and expected_outcomes, and
    may have policy_ids."""
    outcomes = F.coalesce("expected_outcomes", F.array().cast(rows.schema["expected_outcomes"].dataType))
    previews = F.array_join(F.transform("chain", lambda x: F.coalesce(x["result_preview"], F.lit(""))), " ")
    claim = lambda x: F.coalesce(F.nullif(x["assertion"], F.lit("")), x["description"], F.lit(""))
    # what a step's own result shows needs no search through all results; of the rest each claim is looked for once
    own = lambda k: F.coalesce(F.get(F.col("chain"), k)["result_preview"], F.lit(""))
    elsewhere = F.array_distinct(F.transform(F.filter(outcomes, lambda x, k: ~F.contains(own(k), claim(x))), claim))
    shown_all = bound(elsewhere, lambda claims: (F.size(claims) == 0) | bound(previews, lambda all_: F.forall(claims, lambda x: F.contains(all_, x))))
    stated = F.filter(outcomes, lambda x: x["state_after"].isNotNull())
    answer = F.coalesce("answer_draft", F.lit(""))
    shown = F.filter("chain", lambda x: F.coalesce(x["result_preview"], F.lit("")) != "")
    policies = F.coalesce(F.size("policy_ids"), F.lit(0)) <= 0 if "policy_ids" in rows.columns else F.lit(True)
    return {
        "intent_aligned": intent_aligned(F.col("question"), tools_of(F.col("chain"))),
        "output_assertions_passed": (F.size(outcomes) > 0) & shown_all,
        "state_assertions_passed": (F.size(stated) > 0) & F.forall(stated, lambda x: x["state_after"] != ""),
        "policy_checks_passed": policies,
        "answer_faithful": (answer != "") & F.exists(shown, lambda x: F.contains(answer, F.substring(x["result_preview"], 1, 80))),
    }


def verify(rows: DataFrame, catalog: DataFrame, keys: list[str], **how) -> DataFrame:
    """``rows`` with ``verification``: whether all steps ran, what failed, and the business checks."""
    steps = check_steps(rows, catalog, keys, **how)
    record = F.struct("step", "tool", "ok", "error")
    mismatch = F.when(F.size("problems") > 0, F.struct("step", "tool", "problems"))
    per = steps.groupBy(*keys).agg(
        F.every("ok").alias("all_ok"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("missing"), F.struct("step", "tool")))), lambda x: x["tool"]).alias(
            "missing_tools"
        ),
        F.array_sort(F.collect_list(mismatch)).alias("schema_mismatches"),
        F.array_sort(F.collect_list(record)).alias("executed_steps"),
    )
    joined = rows.join(per, keys, "left").withColumn("_done", F.coalesce("all_ok", F.lit(False)))
    checks = business_checks(joined)
    # as columns of their own, so that the summary does not evaluate them again
    judged = joined.withColumns({f"_{name}": check for name, check in checks.items()})
    safe = F.col("_done")
    for name in checks:
        safe = safe & F.col(f"_{name}")
    report = F.struct(
        F.col("_done").alias("chain_valid"),
        F.col("_done").alias("execution_completed"),
        "missing_tools",
        "schema_mismatches",
        "executed_steps",
        *(F.col(f"_{name}").alias(name) for name in checks),
        safe.alias("safe_to_review"),
    )
    return judged.withColumn("verification", report).select(*rows.columns, "verification")


def verify_with(rows: DataFrame, catalog: DataFrame, keys: list[str], registry: Mapping[str, Callable], seconds: float = CALL_SECONDS) -> DataFrame:
    """``verify`` that executes the steps with functions by tool name, plain or to be awaited, for ``seconds`` each at most."""
    ship(rows.sparkSession)
    return verify(rows, catalog, keys, registry=registry, seconds=seconds)
