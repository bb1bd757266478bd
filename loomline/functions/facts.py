"""Facts in JSON results, and the outcomes that an executed step gives evidence of."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomline.functions.text import bound

# Keys by which a fact is preferred, and verbs of tools that change what they act on.
SALIENT_KEYS = ("status", "state", "id", "name", "title", "number", "key", "result", "count", "priority", "severity")
MUTATING_VERBS = (
    "create",
    "open",
    "add",
    "file",
    "update",
    "modify",
    "set",
    "append",
    "delete",
    "remove",
    "close",
    "assign",
    "escalate",
    "approve",
    "reject",
    "resolve",
    "submit",
    "cancel",
)
# Verbs of a request by the tool's verb, and the answer where none was drafted.
REQUEST_VERBS = {
    "create": "create", "open": "open", "add": "add", "file": "file", "get": "look up", "fetch": "fetch", "retrieve": "retrieve",
    "search": "search", "find": "find", "list": "list", "lookup": "look up", "update": "update", "modify": "modify",
    "set": "set", "append": "append", "delete": "delete", "remove": "remove", "close": "close",
}
ANSWER_FALLBACK = "(drafted mechanically from tool results; LLM refinement pending)"

_FACT = "struct<key:string,value:string>"


def tool_verb(tool: Column) -> Column:
    return F.lower(F.split(F.coalesce(tool, F.lit("")), "_")[0])


def request_verb(tool: Column) -> Column:
    verbs = F.create_map(*(F.lit(x) for pair in REQUEST_VERBS.items() for x in pair))
    return F.coalesce(F.try_element_at(verbs, tool_verb(tool)), F.lit("use"))


def _scalars(json: Column) -> Column:
    """Array of (key, value) of an object's usable scalars in document order: strings, integers and booleans of two
    characters at least. Null where ``json`` is no object."""

    def usable(x: Column) -> Column:
        text = x["value"].cast("string")
        shown = bound(F.schema_of_variant(x["value"]), lambda kind: F.when(kind == "BOOLEAN", F.initcap(text)).when(kind.isin("STRING", "BIGINT"), text))
        return F.struct(x["key"].alias("key"), shown.alias("value"))

    pairs = F.transform(F.map_entries(F.from_json(json, "map<string,variant>")), usable)
    return F.filter(pairs, lambda x: x["value"].isNotNull() & (F.length(F.trim(x["value"])) >= 2))


def _preferred(json: Column) -> Column:
    """The first salient key's usable scalar of an object, else its first; null without any."""

    def first(scalars: Column) -> Column:
        under = lambda key: F.try_element_at(F.filter(scalars, lambda x: x["key"] == key), F.lit(1))
        return F.coalesce(*map(under, SALIENT_KEYS), F.try_element_at(scalars, F.lit(1)))

    return bound(_scalars(json), first)


def salient_fact(preview: Column) -> Column:
    """(key, value) that a JSON object reports, at its top or else in an object directly below; null if none.

    The object is parsed once for its own values, and once more for the objects below where those tell nothing.
    """

    def fact(sound: Column) -> Column:
        nested = F.filter(F.map_values(F.from_json(sound, "map<string,string>")), lambda x: x.isNotNull() & x.startswith("{"))
        below = F.filter(F.transform(nested, _preferred), lambda x: x.isNotNull())
        return F.coalesce(_preferred(sound), F.try_element_at(below, F.lit(1))).cast(_FACT)

    # most that is no object is told by its first character, without an attempt to parse it
    sound = lambda x: F.when(F.ltrim(x).startswith("{") & F.try_parse_json(x).isNotNull(), x)
    return bound(preview, lambda x: bound(sound(x), lambda y: F.when(y.isNotNull(), fact(y))))


def expected_outcome(tool: Column, preview: Column) -> Column:
    """(description, assertion, state_after) of one step; state_after is null where the step gives no evidence."""
    mutating = tool_verb(tool).isin(*MUTATING_VERBS)

    def told_by(fact: Column) -> Column:
        told = F.concat(fact["key"], F.lit("="), fact["value"])
        applied = F.concat(tool, F.when(mutating, F.lit(" applied: ")).otherwise(F.lit(" observed: ")), told)
        return F.struct(
            F.when(fact.isNotNull(), F.concat(tool, F.lit(" result reports "), told)).otherwise(F.concat(tool, F.lit(" completed with the recorded result"))).alias(
                "description"
            ),
            F.coalesce(fact["value"], F.trim(F.substring(preview, 1, 60))).alias("assertion"),
            F.when(fact.isNotNull(), applied).when(mutating, F.concat(tool, F.lit(" applied"))).alias("state_after"),
        )

    return bound(salient_fact(preview), told_by)
