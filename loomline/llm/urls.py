"""URL filters: pattern rules indexed by their rarest literal token."""

from __future__ import annotations

import re
import re._parser as syntax
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import as_texts, map_batches

TOKEN = re.compile(r"[A-Za-z0-9]+")
_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
ALLOW, BLOCK = "allow", "block"


def url_tokens(url: str) -> set[str]:
    return {x.lower() for x in TOKEN.findall(url)}


def _may_be(kind, value) -> bool:
    """Whether one item of a pattern can match a character of tokens."""
    if kind is syntax.LITERAL:
        return chr(value) in _CHARS
    if kind is not syntax.IN:
        return True
    negated = value[0][0] is syntax.NEGATE
    members = set()
    for what, of in value[negated:]:
        if what is syntax.LITERAL:
            members.add(chr(of))
        elif what is syntax.RANGE:
            members.update(x for x in _CHARS if of[0] <= ord(x) <= of[1])
        else:
            return True
    return bool(_CHARS - members if negated else _CHARS & members)


def _edge(items: Sequence, step: int) -> tuple[bool, bool]:
    """Whether what ``items`` match may begin (``step`` 1) or end (-1) with a character of tokens, and may be empty."""
    may = False
    for kind, value in items[::step]:
        if kind is syntax.AT or kind in (syntax.ASSERT, syntax.ASSERT_NOT):
            continue
        if kind is syntax.SUBPATTERN:
            own, empty = _edge(value[3], step)
        elif kind is syntax.BRANCH:
            both = [_edge(x, step) for x in value[1]]
            own, empty = any(x for x, _ in both), any(x for _, x in both)
        elif kind in (syntax.MAX_REPEAT, syntax.MIN_REPEAT, syntax.POSSESSIVE_REPEAT):
            own, empty = _edge(value[2], step)
            empty = empty or value[0] == 0
        else:
            own, empty = _may_be(kind, value), kind is syntax.GROUPREF
        may = may or own
        if not empty:
            return may, False
    return may, True


def literal_tokens(pattern: str) -> tuple[str, ...]:
    """Tokens, in lower case, that every text in which ``pattern`` is found has in full.

    They are the runs of letters and digits that the pattern spells and on both sides of which it lets nothing but
    another character, or an end of the text, follow.
    """
    parsed = syntax.parse(pattern)
    flags = parsed.state.flags
    if flags & re.IGNORECASE and not flags & re.ASCII:
        return ()  # other letters than those of tokens match
    flat: list = []

    def flatten(items: Iterable) -> None:
        for kind, value in items:
            if kind is syntax.SUBPATTERN and not value[1] and not value[2]:
                flatten(value[3])
            else:
                flat.append((kind, value))

    flatten(parsed)

    def bounded(items: Sequence, step: int, anchors: tuple) -> bool:
        for item in items:
            if item[0] is syntax.AT and item[1] in anchors:
                return True
            may, empty = _edge([item], step)
            if may:
                return False
            if not empty:
                return True
        return False

    found, at = [], 0
    while at < len(flat):
        end = at
        while end < len(flat) and flat[end][0] is syntax.LITERAL and chr(flat[end][1]) in _CHARS:
            end += 1
        if end > at:
            starts, ends = (syntax.AT_BEGINNING, syntax.AT_BEGINNING_STRING), (syntax.AT_END, syntax.AT_END_STRING)
            if bounded(flat[:at][::-1], -1, starts) and bounded(flat[end:], 1, ends):
                found.append("".join(chr(x) for _, x in flat[at:end]).lower())
        at = end + 1
    return tuple(dict.fromkeys(found))


@dataclass(frozen=True)
class Rule:
    """A verdict for urls that ``pattern`` matches, searched in "host?path?" (neither part has a question mark).

    Of the rules that match, those of the highest rank decide, then the longest name. ``tokens`` come from the pattern.
    """

    name: str
    verdict: str
    pattern: str
    rank: int = 0
    tokens: tuple[str, ...] = field(init=False, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "tokens", literal_tokens(self.pattern))


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """A host with all its subdomains, and the start of a path."""
    return Rule(host + path, verdict, rf"^(?:[^?]*\.)?{re.escape(host)}\?{re.escape(path)}", 1)


def host_words(verdict: str, *words: str) -> list[Rule]:
    """Hosts with these words side by side in a label, joined by hyphens."""
    pattern = r"^(?:[^?]*[^A-Za-z0-9?])?{}(?:[^A-Za-z0-9?][^?]*)?\?"
    return [Rule("-".join(x.split()), verdict, pattern.format("-".join(map(re.escape, x.split())))) for x in words]


def read_rules(lines: Iterable[str], rank: int = 0) -> list[Rule]:
    """Rules of a public filter list: a block for each pattern, exceptions (@@) one rank above.

    ``||`` is the start of a host or of one of its labels, ``|`` an end of the address, ``*`` anything, and ``^`` a
    separator; letters match in either case. Comments and rules that hide elements have no verdict on urls, and those
    with options ($) depend on more than the url: neither is read. Regular expressions are an error; they are Rules.
    """
    out = []
    for line in lines:
        name = line.strip()
        if not name or name[0] in "![" or re.search(r"#[@?$]?#", name) or re.search(r"\$~?[a-z]", name):
            continue
        verdict, body = (ALLOW, name[2:]) if name.startswith("@@") else (BLOCK, name)
        if len(body) > 1 and body[0] == body[-1] == "/":
            raise ValueError(f"a regular expression, not a filter: {name}")
        start, end = "", ""
        if body.startswith("||"):
            start, body = r"^(?:[^?]*\.)?", body[2:]
        elif body.startswith("|"):
            start, body = "^", re.sub(r"^[A-Za-z]*://", "", body[1:])
        if body.endswith("|"):
            end, body = r"\?$", body[:-1]
        said = {"*": ".*", "^": r"[^A-Za-z0-9_.%-]", "/": r"\??/"}
        out.append(Rule(name, verdict, f"(?ai){start}{''.join(said.get(x) or re.escape(x) for x in body)}{end}", rank + (verdict == ALLOW)))
    return out


#: The rules that the contract names.
BASE_RULES = (
    host_rule("org", "/", ALLOW),
    host_rule("example.org", "/es/", BLOCK),
    host_rule("example.org", "/en/1", BLOCK),
    host_rule("com", "/fr/", ALLOW),
    host_rule("com", "/de/", BLOCK),
)
#: Spam by words of the host, and paths of trackers and shops; no list of sites.
PATTERN_RULES = (
    *host_words(
        BLOCK,
        "casino win",
        "casino",
        "free bets",
        "bets",
        "cheap pills",
        "pills",
        "poker online",
        "payday loans",
        "adult dating",
        "replica watches",
    ),
    Rule("path:ads", BLOCK, r"\?(?:/[^/?]+)*/ads/"),
    Rule("path:adserver", BLOCK, r"\?(?:/[^/?]+)*/adserver[/?]"),
    Rule("path:affiliate", BLOCK, r"\?(?:/[^/?]+)*/affiliate/"),
    Rule("path:cgi", BLOCK, r"\?/cgi-bin/"),
    Rule("path:calendar", BLOCK, r"\?(?:/[^/?]+)*/calendar/[0-9]{4}/[0-9]{1,2}[/?]"),
)
DEFAULT_RULES = BASE_RULES + PATTERN_RULES


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z in lower case; empty where there is none."""
    return F.translate(
        F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rarest(rules: Sequence[Rule], counts: Mapping[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """Rules by their rarest token, the longest of equally rare ones; and those without any, which all urls run."""
    index: dict[str, list[int]] = {}
    always = []
    for k, rule in enumerate(rules):
        if rule.tokens:
            index.setdefault(min(rule.tokens, key=lambda x: (counts.get(x, 0), -len(x), x)), []).append(k)
        else:
            always.append(k)
    return index, always


def decide(url: str, rules: Sequence[Rule], compiled: Sequence[re.Pattern], index: Mapping[str, list[int]], always: Iterable[int]) -> Rule | None:
    """The rule that decides on "host?path?"; only the candidates that the url's tokens fetch are run."""
    candidates = {k for token in url_tokens(url) for k in index.get(token, ())} | set(always)
    found = [rules[k] for k in candidates if compiled[k].search(url)]
    return max(found, key=lambda x: (x.rank, len(x.name), x.name), default=None)


def url_filter(pages: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES, default: str = ALLOW, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: page_id, host, path, verdict, rule (its name, null if none matched) and rank of the rule.

    Tokens of all urls are counted first, those of the rules only; each rule goes under the token that the fewest
    urls have. A url without :// has an empty host and path and takes the default, as does a null one; urls of any length
    are judged whole. Of rules of one rank and one length of name the last by name decides. Rows are independent: null
    ids, repeated rows and empty tables need no rule. Further columns have no part, whatever their names.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    )
    wanted = sorted({x for rule in rules for x in rule.tokens})
    whole = F.concat_ws("?", "host", "path")
    tokens = rows.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(whole), F.lit("([a-z0-9]+)"), 1))).alias("token"))
    # as many rows as the rules have tokens
    counts = {x["token"]: x["count"] for x in tokens.where(F.col("token").isin(wanted)).groupBy("token").count().collect()}
    index, always = rarest(rules, counts)
    patterns = [rule.pattern for rule in rules]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        compiled = [re.compile(x) for x in patterns]
        hosts, paths = as_texts(batch.column("host")), as_texts(batch.column("path"))
        found = [decide(f"{host}?{path}?", rules, compiled, index, always) for host, path in zip(hosts, paths, strict=True)]
        columns = [
            [x.verdict if x else default for x in found], [x.name if x else None for x in found], [x.rank if x else None for x in found]
        ]
        kinds = [pa.string(), pa.string(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))],
            [*batch.schema.names, "verdict", "rule", "rank"],
        )

    return map_batches(rows, work, "page_id long, host string, path string, verdict string, rule string, rank int")


def base_verdicts(judged: DataFrame) -> DataFrame:
    """page_id, host, path, rule (of the base rules, else null), verdict, and the pattern rule that decided."""
    base = F.col("rank") == 1
    return judged.select(
        "page_id", "host", "path", F.when(base, F.col("rule")).alias("rule"), "verdict", F.when(~base, F.col("rule")).alias("pattern")
    )
