"""Secret scans: fixed patterns, and windows of high entropy within candidate strings."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import as_bytes, map_batches

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
#: Runs of at least 24; a shorter run of the same characters can't hold one.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

KINDS = ("assign", "access", "hex", "entropy")
BASE = KINDS[:3]


@dataclass(frozen=True)
class CharClass:
    """A character class: its runs of at least ``window`` characters are candidates.

    A window is hot with at least ``bits`` of Shannon entropy and ``least`` characters of each of ``needs``.
    """

    name: str
    run: re.Pattern
    window: int
    bits: float
    needs: tuple[str, ...]
    least: int = 1


DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Keys in one case (base32, base36) need digits; short ones, which names may resemble, two of each kind.
CLASSES = (
    CharClass("hex", re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{24,}(?![0-9A-Za-z])"), 24, 3.0, (DIGITS, "abcdefABCDEF")),
    CharClass("alphanumeric", re.compile(r"(?<![0-9A-Za-z])[0-9A-Za-z]{24,}"), 24, 3.9, (DIGITS, LOWER, UPPER)),
    CharClass("base64", re.compile(r"(?<![0-9A-Za-z+/=_-])[0-9A-Za-z+/=_-]{32,}"), 32, 4.3, (DIGITS, LOWER, UPPER)),
    CharClass("lower case", re.compile(r"(?<![0-9A-Za-z])[0-9a-z]{24,}(?![0-9A-Za-z])"), 24, 3.9, (DIGITS, LOWER), 2),
    CharClass("upper case", re.compile(r"(?<![0-9A-Za-z])[0-9A-Z]{24,}(?![0-9A-Za-z])"), 24, 3.9, (DIGITS, UPPER), 2),
    CharClass("short", re.compile(r"(?<![0-9A-Za-z])[0-9A-Za-z]{16,23}(?![0-9A-Za-z])"), 16, 3.6, (DIGITS, LOWER, UPPER), 2),
)
#: Runs that hold the candidates of all classes.
WIDE = re.compile(r"[0-9A-Za-z+/=_-]{16,}")
DIGIT = re.compile("[0-9]")

#: Placeholders (letters in either case): a window with a character of one, however often its last one repeats, is none.
ALLOWED = (
    "example",
    "sample",
    "placeholder",
    "changeme",
    "dummy",
    "redacted",
    "xxxxxx",
    "000000",
    "123456789",
    "abcdefgh",
    "deadbeef",
    "loremipsum",
)
_PLACEHOLDER = re.compile("|".join(f"{x}{x[-1]}*" for x in ALLOWED), re.IGNORECASE)
#: Bytes of public digests. What follows the name of one is allowed as far as the digest goes, in hex or base64.
DIGEST_BYTES = {"md5": 16, "sha1": 20, "sha224": 28, "sha256": 32, "sha384": 48, "sha512": 64}
_DIGEST = re.compile(rf"({'|'.join(DIGEST_BYTES)})[-:=]([0-9A-Za-z+/_=-]*)", re.IGNORECASE)
#: Inline data and identifiers.
_PUBLIC = re.compile(r"base64,[0-9A-Za-z+/=_-]*|urn:uuid:[0-9a-f-]{36}", re.IGNORECASE)
#: The host and the plain path of an url: quotes, brackets, commas, ?, #, =, & and @ end it.
ADDRESS = re.compile(r"://([\w.~:/%+*!-]*)")
#: User info goes on to an @ ahead of the path.
USER_INFO = re.compile(r"[^\s/?#\"'<>@]*@")
#: Addresses whose paths are secrets.
WEBHOOKS = re.compile(r"hooks\.slack\.com/|discord(?:app)?\.com/api/webhooks/|webhook\.office\.com/|api\.telegram\.org/bot", re.IGNORECASE)

_TERM = [0.0] + [n * log2(n) for n in range(1, 257)]


def hot_windows(run: str, window: int, bits: float, needs: Sequence[str], least: int = 1) -> Iterator[tuple[int, int]]:
    """Merged windows of ``run`` that are hot. Counts change by one character in and one out at each step.

    Entropy is log2(window) - sum(c log2 c) / window over the counts c of the window's characters.
    """
    counts: dict[str, int] = {}
    held = [0] * len(needs)
    group = {c: k for k, chars in enumerate(needs) for c in chars}
    total, start, end = 0.0, -1, -1
    most = (log2(window) - bits) * window + 1e-9
    for i, c in enumerate(run):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += _TERM[n + 1] - _TERM[n]
        if c in group:
            held[group[c]] += 1
        if i >= window:
            gone = run[i - window]
            n = counts[gone]
            counts[gone] = n - 1
            total += _TERM[n - 1] - _TERM[n]
            if gone in group:
                held[group[gone]] -= 1
        at = i - window + 1
        if at >= 0 and total <= most and min(held) >= least:
            if at > end:
                if start >= 0:
                    yield start, end
                start = at
            end = i + 1
    if start >= 0:
        yield start, end


def base_spans(text: str, raw: bytes) -> list[tuple[str, int, int]]:
    """The fixed patterns' matches: leftmost, without overlap within a kind; those too short are dropped."""
    low, out = raw.lower(), []
    if any(word in low for word in ASSIGN_WORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if b"AKIA" in raw:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    return out + [("hex", *m.span()) for m in HEX.finditer(text)]


def allowed(text: str) -> list[tuple[int, int]]:
    """Stretches of ``text`` that are no secrets whatever they look like, by their start and without overlap.

    They are digests after their name, inline data, and hosts and plain paths of urls. User info, what follows a path,
    and the paths of webhooks are not among them.
    """
    found = [m.span() for m in _PUBLIC.finditer(text)]
    for m in _DIGEST.finditer(text):
        n = DIGEST_BYTES[m[1].lower()]
        hexed = re.match(r"(?i)[0-9a-f]{%d}" % (2 * n), m[2])
        found.append((m.start(), min(m.end(), m.start(2) + (2 * n if hexed else 4 * -(-n // 3)))))
    for m in ADDRESS.finditer(text):
        if not USER_INFO.match(text, m.start(1)) and not WEBHOOKS.search(m[1]):
            found.append(m.span(1))
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(b, merged[-1][1])
        else:
            merged.append((a, b))
    return merged


def after(spans: Sequence[tuple[int, int]], at: int) -> Iterator[tuple[int, int]]:
    """Those of ``spans``, which are in order, that end after ``at``."""
    return (spans[k] for k in range(bisect_right(spans, at, key=lambda x: x[1]), len(spans)))


def without(start: int, end: int, holes: Iterable[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What ``holes``, by their start, leave of a stretch."""
    for a, b in holes:
        if a >= end:
            break
        if b > start:
            if a > start:
                yield start, a
            start = b
    if start < end:
        yield start, end


def entropy_spans(text: str) -> list[tuple[str, int, int]]:
    """Hot windows of all classes, merged where they overlap. A window has no character that is allow-listed."""
    found: list[tuple[int, int]] = []
    holes: list[tuple[int, int]] | None = None
    for wide in WIDE.finditer(text):
        if not DIGIT.search(text, *wide.span()):  # all classes need one
            continue
        holes = allowed(text) if holes is None else holes
        free = [
            part for a, b in without(*wide.span(), after(holes, wide.start())) for part in without(a, b, (m.span() for m in _PLACEHOLDER.finditer(text, a, b)))
        ]
        for of in CLASSES:
            for run in of.run.finditer(text, *wide.span()):
                for a, b in after(free, run.start()):
                    if a >= run.end():
                        break
                    at, end = max(a, run.start()), min(b, run.end())
                    if end - at >= of.window:
                        found += [(at + x, at + y) for x, y in hot_windows(text[at:end], of.window, of.bits, of.needs, of.least)]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if merged and a < merged[-1][1]:
            merged[-1] = merged[-1][0], max(b, merged[-1][1])
        else:
            merged.append((a, b))
    return [("entropy", a, b) for a, b in merged]


def spans_of(raw: bytes) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end: code points) by start, then kind. Hot windows within a base span add nothing."""
    text = raw.decode("utf-8", "replace")
    base = base_spans(text, raw)
    new = [x for x in entropy_spans(text) if not any(a <= x[1] and x[2] <= b for _, a, b in base)]
    return sorted(base + new, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


SPANS = "array<struct<kind:string,start:long,end:long>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans of each row: array of (kind, start, end), by start, then kind as in KINDS.

    Null and empty texts have none; a text of any length is scanned whole, and a stretch of any length is allowed or not
    as a whole. Of spans that start together the one of the earlier kind comes first, then the shorter one. Rows are
    independent: null ids, repeated rows and empty tables need no rule. Further columns have no part, whatever their names.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [[dict(zip(("kind", "start", "end"), x, strict=True)) for x in spans_of(raw)] for raw in as_bytes(batch.column("text"))]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, _SPANS)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, work, f"doc_id long, spans {SPANS}")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def span_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of the rows of ``secret_spans``."""
    of = lambda *kinds: F.filter("spans", lambda x: x["kind"].isin(*kinds))
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(listed(of(*BASE)), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def masked(text: str, spans: Sequence[tuple[str, int, int]], mask: str = "[SECRET]") -> str:
    """``text`` with each stretch that spans cover replaced."""
    out, at = [], 0
    for _, a, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mask]
        at = b
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """All rows of ``docs``, with the secrets in their texts masked and ``chars_col``, if there is one, counted anew.

    Rows without a secret stay as they are, null and empty texts too; texts of any length are masked whole. Rows are
    independent, so that null ids, repeated rows and empty tables need no rule, and all columns are kept as they are.
    """
    text = docs.columns.index(text_col)
    chars = docs.columns.index(chars_col) if chars_col in docs.columns else None

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(batch.columns)
        texts = columns[text].to_pylist()
        changed = {}
        for k, raw in enumerate(as_bytes(columns[text])):
            if spans := spans_of(raw):
                texts[k] = changed[k] = masked(raw.decode("utf-8", "replace"), spans)
        if changed:
            columns[text] = pa.array(texts, columns[text].type)
            if chars is not None:
                counts = columns[chars].to_pylist()
                for k, new in changed.items():
                    counts[k] = len(new)
                columns[chars] = pa.array(counts, columns[chars].type)
        return pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return map_batches(docs, work, docs.schema)
