"""Redaction by ordered patterns, and counts of what each of them replaced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Pattern = tuple[str, str, str]

# Label, pattern and replacement, in the order in which they apply. Credentials come before the
# numeric rules, so that those do not eat into keys.
PATTERNS: tuple[Pattern, ...] = (
    ("email", r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}", "[REDACTED_EMAIL]"),
    ("api_key", r"\bsk-[A-Za-z0-9\-_]{20,}\b", "[REDACTED_KEY]"),
    ("openrouter_key", r"sk-or-[A-Za-z0-9\-_]{16,}", "[REDACTED_KEY]"),
    ("aws_access_key", r"AKIA[0-9A-Z]{16}", "[REDACTED_AWS_KEY]"),
    ("private_key_block", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*?-----END [A-Z ]*PRIVATE KEY-----", "[REDACTED_PRIVATE_KEY]"),
    (
        "api_key_assignment",
        r"(?i)\b(api[_-]?key|secret|client[_-]?secret|access[_-]?token)\b\s*[:=]\s*['\"]?[\w\-.]{12,}['\"]?",
        "[REDACTED_CREDENTIAL]",
    ),
    ("bearer_token", r"(?i)bearer\s+[A-Za-z0-9\-._~+/]{16,}={0,2}", "[REDACTED_TOKEN]"),
    ("phone", r"(?<!\d)(?:\+?1[-.\s]?)?(?:\(?\d{3}\)?[-.\s]?)?\d{3}[-.\s]?\d{4}(?!\d)", "[REDACTED_PHONE]"),
    ("ssn", r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)", "[REDACTED_SSN]"),
    ("credit_card", r"(?<!\d)(?:\d[ -]?){13,16}(?!\d)", "[REDACTED_CARD]"),
)


#: What a text needs, at the least, for a fixed pattern to be in it, as a quicker search: none of the fixed replacements
#: makes such a part, so that it is looked for in the text as it was.
NEEDS = {
    "email": "@",
    "api_key": "sk-",
    "openrouter_key": "sk-or-",
    "aws_access_key": "AKIA",
    "private_key_block": "PRIVATE KEY-----",
    "api_key_assignment": r"(?i:key|secret|token)\s*[:=]",
    "bearer_token": r"(?i:bearer)\s",
    "phone": r"\d{4}",
    "ssn": r"-\d{4}",
    "credit_card": r"\d[ -]?\d[ -]?\d[ -]?\d",
}


def _may_hold(text: Column, rule: Pattern, patterns: Sequence[Pattern]) -> Column:
    """Whether the quicker search leaves a rule's pattern possible; always, unless all rules are fixed ones."""
    need = NEEDS[rule[0]] if set(patterns) <= set(PATTERNS) else ""
    return F.lit(True) if not need else text.rlike(need) if "\\" in need else F.contains(text, F.lit(need))


def _replaced(text: Column, rule: Pattern) -> Column:
    return F.regexp_replace(text, rule[1], rule[2].replace("$", r"\$"))


def _step(text: Column, now: Column, rule: Pattern, patterns: Sequence[Pattern]) -> Column:
    """``now`` with one rule's matches replaced; a lambda binds it, as both branches take it."""
    found = _may_hold(text, rule, patterns)
    return F.get(F.transform(F.array(now), lambda x: F.when(found, _replaced(x, rule)).otherwise(x)), F.lit(0))


def redact(text: Column, patterns: Sequence[Pattern] = PATTERNS) -> Column:
    """``text`` with all patterns replaced, one after the other."""
    now = text
    for rule in patterns:
        now = _step(text, now, rule, patterns)
    return now


def _counted(df: DataFrame, text_col: str, patterns: Sequence[Pattern]) -> DataFrame:
    """``df`` with the text after each rule (_t0, _t1 ...) and the rule's replacements (_n0 ...).

    Each count is taken on the text as the rules before left it, of which each step is a column of its own, so that
    no expression is evaluated twice; only texts that a rule counts something in are replaced.
    """
    step = df.withColumn("_t0", F.col(text_col))
    for k, rule in enumerate(patterns):
        now, n = F.col(f"_t{k}"), F.col(f"_n{k}")
        count = F.when(_may_hold(F.col("_t0"), rule, patterns), F.regexp_count(now, F.lit(rule[1]))).otherwise(0).cast("long")
        step = step.withColumn(f"_n{k}", F.coalesce(count, F.lit(0).cast("long")))
        step = step.withColumn(f"_t{k + 1}", F.when(n > 0, _replaced(now, rule)).otherwise(now))
    return step


def with_redaction(df: DataFrame, text_col: str, out_col: str | None = None, hits_col: str = "pii_redactions", patterns: Sequence[Pattern] = PATTERNS) -> DataFrame:
    """``df`` with the redacted text and, per label, the number of replacements (labels without any left out)."""
    step = _counted(df, text_col, patterns)
    pairs = F.array(*(F.struct(F.lit(label).alias("key"), F.col(f"_n{k}").alias("value")) for k, (label, _, _) in enumerate(patterns)))
    hits = F.map_from_entries(F.filter(pairs, lambda x: x["value"] > 0))
    done = step.withColumn(hits_col, hits).withColumn(out_col or text_col, F.col(f"_t{len(patterns)}"))
    return done.drop(*(f"_{x}{k}" for k in range(len(patterns) + 1) for x in "nt"))


def hit_totals(df: DataFrame, text_col: str, patterns: Sequence[Pattern] = PATTERNS) -> DataFrame:
    """(label, hits): replacements by label over all rows, labels without any included."""
    counts = _counted(df.select(text_col), text_col, patterns)
    sums = counts.agg(*(F.coalesce(F.sum(f"_n{k}"), F.lit(0)).cast("long").alias(f"_n{k}") for k in range(len(patterns))))
    pairs = (F.struct(F.lit(label).alias("label"), F.col(f"_n{k}").alias("hits")) for k, (label, _, _) in enumerate(patterns))
    return sums.select(F.explode(F.array(*pairs)).alias("x")).select("x.*")
