"""What a question asks for, what a tool does, and whether the two agree."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomline.functions.text import bound

# Verbs by effect, and the phrases of each intent in the order in which they are tried.
EFFECT_VERBS = {
    "READ": ("get", "fetch", "search", "find", "list", "lookup", "read", "retrieve", "show"),
    "CREATE": ("create", "open", "add", "file", "post", "insert", "submit", "raise"),
    "UPDATE": ("update", "modify", "set", "append", "change", "edit"),
    "DELETE": ("delete", "remove", "close", "cancel", "resolve"),
}
INTENT_PHRASES = (
    ("READ", r"\b(status of|what is the status|what is status|look ?up|lookup|show me|get the|retrieve)\b"),
    ("DELETE", r"\b(close|resolve|cancel|delete|remove)\b"),
    ("CREATE", r"\b(create|file|open|raise|submit|add)\b"),
)


def tool_effect(tool: Column) -> Column:
    """READ, CREATE, UPDATE or DELETE by the verb before the first underscore; else UNKNOWN."""
    verb = F.lower(F.split(F.coalesce(tool, F.lit("")), "_")[0])
    out = F.lit("UNKNOWN")
    for effect, verbs in reversed(EFFECT_VERBS.items()):
        out = F.when(verb.isin(*verbs), effect).otherwise(out)
    return out


def question_intent(question: Column) -> Column:
    """READ, DELETE or CREATE where the question says so; else null."""
    out = F.lit(None).cast("string")
    for intent, phrases in reversed(INTENT_PHRASES):
        out = F.when(F.coalesce(question, F.lit("")).rlike("(?i)" + phrases), intent).otherwise(out)
    return out


def intent_label(question: Column) -> Column:
    return F.coalesce(F.lower(question_intent(question)), F.lit("unknown"))


def intent_aligned(question: Column, tools: Column) -> Column:
    """Whether an array of tools does what the question asks for; true where it asks for nothing that is known."""
    named = F.filter(F.coalesce(tools, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))

    def judged(intent: Column, effects: Column) -> Column:
        has = lambda effect: F.array_contains(effects, effect)
        return (
            F.when(intent.isNull(), True)
            .when(F.size(effects) == 0, False)
            .when(intent == "READ", ~has("CREATE") | has("READ"))
            .otherwise(F.when(intent == "CREATE", has("CREATE")).otherwise(has("DELETE")))
        )

    # each tool's effect is taken once, and each of them is looked at
    effects = F.transform(F.array_distinct(named), tool_effect)
    return bound(question_intent(question), lambda intent: bound(effects, lambda found: judged(intent, found)))
