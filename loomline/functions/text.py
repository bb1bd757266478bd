"""Column functions on text: estimates, truncation, canonical forms, name tokens and types."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the results depend on.
CHARS_PER_TOKEN = 4
TYPE_NAMES = {
    "str": "string", "string": "string", "text": "string",
    "int": "integer", "integer": "integer",
    "float": "number", "double": "number", "number": "number",
    "bool": "boolean", "boolean": "boolean",
    "list": "array", "array": "array",
    "dict": "object", "object": "object", "map": "object",
    "path": "path", "filepath": "path",
    "content": "content",
}


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is taken once for each row, however often the body names it, within lambdas too."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def estimate_tokens(text: Column) -> Column:
    """A quarter of the code points, one at least; null counts as empty."""
    return F.greatest(F.lit(1).cast("long"), F.floor(F.coalesce(F.length(text), F.lit(0)) / CHARS_PER_TOKEN))


def truncate(text: Column, most: int) -> Column:
    """As it is up to ``most`` characters, else cut with an ellipsis as the last of them."""
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.rtrim(F.substring(text, 1, most - 1)), F.lit("…")))


def clipped(text: Column, most: int, mark: str = "...") -> Column:
    """The first ``most`` characters, with ``mark`` after them if there were more."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit(mark))).otherwise(text)


def first_filled(*candidates: Column, default: str = "") -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in candidates), F.lit(default))


def filled(template: str, *values: Column) -> Column:
    """``template`` with a value in each place that is marked {}."""
    first, *rest = template.split("{}")
    return F.concat(F.lit(first), *(x for value, text in zip(values, rest, strict=True) for x in (value.cast("string"), F.lit(text))))


def normalize_question(text: Column) -> Column:
    """Lower case without punctuation, words one space apart."""
    bare = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_\s]", "")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def canon(text: Column) -> Column:
    """Lower case, words one space apart."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def singular(token: Column) -> Column:
    """-ies to -y in tokens of over four letters; a final s goes in those of over three, but not from -ss or -us."""
    size = F.length(token)
    ies = (size > 4) & token.endswith("ies")
    plural = (size > 3) & token.endswith("s") & ~token.endswith("ss") & ~token.endswith("us")
    return F.when(ies, F.concat(F.substring(token, F.lit(1), size - 3), F.lit("y"))).when(plural, F.substring(token, F.lit(1), size - 1)).otherwise(
        token
    )


def name_tokens(name: Column) -> Column:
    """Distinct tokens of a name: cut at camel-case bounds and at all but ASCII letters and digits, lower, singular."""
    parts = F.filter(F.split(name, r"(?<=[a-z0-9])(?=[A-Z])|[^a-zA-Z0-9]+"), lambda x: x != "")
    return F.array_distinct(F.transform(parts, lambda x: singular(F.lower(x))))


def normalize_type(kind: Column) -> Column:
    """The canonical name of a JSON-schema type; string where unknown or missing."""
    names = F.create_map(*(F.lit(x) for pair in TYPE_NAMES.items() for x in pair))
    return F.coalesce(F.try_element_at(names, F.lower(F.trim(F.coalesce(kind, F.lit(""))))), F.lit("string"))


def types_compatible(given: Column, wanted: Column) -> Column:
    """Equal, or both of {string, path}, {integer, number} or {content, string}."""
    pair = lambda a, b: given.isin(a, b) & wanted.isin(a, b)
    return (given == wanted) | pair("string", "path") | pair("integer", "number") | pair("content", "string")


def dice(a: Column, b: Column) -> Column:
    """Sørensen-Dice coefficient of two arrays of distinct tokens; zero if one is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(2.0 * both / (F.size(a) + F.size(b)))
