"""Quality rules: text statistics and the fertility of a public tokeniser, with bands by language or script."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import SPACES, as_bytes, as_texts, map_batches

VOCABULARY = "piece_bpe_32k.model"
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # per cent of the words
#: Tokens below which fertility says too little, and the method has no verdict.
MIN_TOKENS = 40

#: Least bits of token entropy by token count; between the counts the bits follow the logarithm of the count.
#: Calibrated on the rows of `labels` with quality 1 (3,700 texts): all of them lie above.
ENTROPY_FLOOR = {40: 3.9, 64: 4.35, 128: 5.05, 256: 5.5, 512: 5.9, 1024: 6.12, 2048: 6.3, 4096: 6.42, 8192: 6.5}


@dataclass(frozen=True)
class Band:
    """What a text may measure: characters of its words per token, share of byte-fallback tokens, entropy floor."""

    chars: tuple[float, float]
    fallback: float
    floor: float = 1.0  # times ENTROPY_FLOOR


#: By language tag.
BANDS: Mapping[str, Band] = {
    "en": Band((1.5, 6.0), 0.12),
    "de": Band((1.5, 6.0), 0.12),
    "fr": Band((1.3, 6.0), 0.12),
    "es": Band((1.3, 6.0), 0.12),
}
#: By script, for texts of other languages. Scripts that the vocabulary spells in bytes have other bands than Latin.
SCRIPT_BANDS: Mapping[str, Band] = {
    "latin": Band((1.1, 6.5), 0.25, 0.95),
    "cyrillic": Band((1.0, 5.5), 0.25, 0.95),
    "greek": Band((0.7, 4.0), 0.40, 0.9),
    "arabic": Band((0.6, 4.0), 0.50, 0.9),
    "han": Band((0.3, 2.5), 0.90, 0.8),
    "other": Band((0.15, 8.0), 1.00, 0.7),
}
#: First code points of ranges, with the script of each up to the next.
SCRIPTS = (
    (0x0, ""),
    (0x41, "latin"),
    (0x5B, ""),
    (0x61, "latin"),
    (0x7B, ""),
    (0xC0, "latin"),
    (0x250, ""),
    (0x370, "greek"),
    (0x400, "cyrillic"),
    (0x530, "other"),
    (0x600, "arabic"),
    (0x780, "other"),
    (0x2E80, "han"),
    (0xA000, "other"),
)


def script_of(text: str) -> str:
    """The script that most letters of the whole text have; other without letters."""
    names = sorted({name for _, name in SCRIPTS if name})
    counts = np.zeros(len(names), np.int64)
    where = np.array([names.index(name) if name else -1 for _, name in SCRIPTS])
    for at in range(0, len(text), 1 << 20):
        points = np.frombuffer(text[at : at + (1 << 20)].encode("utf-32-le", "surrogatepass"), np.uint32)
        found = where[np.searchsorted([x for x, _ in SCRIPTS], points, side="right") - 1]
        counts += np.bincount(found[found >= 0], minlength=len(names))
    return names[int(counts.argmax())] if counts.any() else "other"


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of eight words that occur twice or more in the text, first occurrences included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
    order = np.argsort(rolled, kind="stable")
    same = rolled[order[1:]] == rolled[order[:-1]]
    if not same.any():  # equal windows have equal hashes
        return 0
    maybe = np.sort(order[np.r_[same, False] | np.r_[False, same]])
    first: dict[tuple[bytes, ...], int] = {}
    marks = np.zeros(len(words) + 1, np.int64)
    for i in maybe.tolist():
        key = tuple(words[i : i + WINDOW])
        if key in first:
            for at in {i, first[key]} - {-1}:
                marks[at] += 1
                marks[at + WINDOW] -= 1
            first[key] = -1
        else:
            first[key] = i
    return int((np.cumsum(marks) > 0).sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    inner = text.translate(None, SPACES)
    chars = len(inner.decode("utf-8", "surrogatepass"))
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    return len(words), chars, len(inner) - len(inner.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


@lru_cache(maxsize=4)
def vocabulary_model(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model, np.array([model.is_byte(i) for i in range(model.get_piece_size())])


def fertility(ids: np.ndarray, fallback: np.ndarray, chars: int) -> tuple[int, float, float, float]:
    """Tokens, characters per token, byte-fallback share and bits of token entropy; zeros without tokens."""
    n = len(ids)
    if not n:
        return 0, 0.0, 0.0, 0.0
    counts = np.unique(ids, return_counts=True)[1]
    share = counts / n
    return n, chars / n, float(fallback[ids].sum()) / n, float(-(share * np.log2(share)).sum())


def floor_of(n: int) -> float:
    return float(np.interp(np.log2(max(n, 1)), np.log2(list(ENTROPY_FLOOR)), list(ENTROPY_FLOOR.values())))


def fits(band: Band, n: int, chars: float, fallback: float, bits: float) -> bool:
    """The method's verdict; too short a text passes."""
    return n < MIN_TOKENS or band.chars[0] <= chars <= band.chars[1] and fallback <= band.fallback and bits >= band.floor * floor_of(n)


def judge(texts: list[bytes], langs: list[str], path: str, bands: Mapping[str, Band] = BANDS, scripts: Mapping[str, Band] = SCRIPT_BANDS) -> list[tuple]:
    """A tuple in the order of COLUMNS for each text."""
    model, fallback = vocabulary_model(path)
    out = []
    for text, lang in zip(texts, langs, strict=True):
        whole = text.decode("utf-8", "replace")
        base = base_counts(text)
        measured = fertility(np.array(model.encode(whole, num_threads=1), np.int64), fallback, base[1])
        failed = base[0] < MIN_WORDS or 100 * base[4] > MAX_REPEATED * base[0]
        name = lang if lang in bands else script_of(whole)
        band = bands[lang] if lang in bands else scripts[name]
        out.append((*base, failed, not failed and fits(band, *measured), name, *measured))
    return out


COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, band string, n_tokens long, chars_per_token double, fallback_share double, token_entropy double"


def quality_rules(docs: DataFrame, vocabulary: str, bands: Mapping[str, Band] = BANDS, scripts: Mapping[str, Band] = SCRIPT_BANDS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id and COLUMNS for each row of ``docs``; ``vocabulary`` is the path of a public sentencepiece model.

    Null and empty texts have no words and fail the base rule. A null or unknown language takes the band of the
    text's main script, of equally common scripts the first by name. Rows with null ids and repeated rows are judged like
    any other, row by row; an empty table gives an empty result. Texts are measured whole, whatever their length. Further
    columns have no part, whatever their names.
    """
    names = [x.split()[0] for x in COLUMNS.split(", ")]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = judge(as_bytes(batch.column("text")), as_texts(batch.column("lang")), vocabulary, bands, scripts)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x) for x in zip(*rows, strict=True))], ["doc_id", *names])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return map_batches(rows, work, f"doc_id long, {COLUMNS}")


def keep_quality(docs: DataFrame, vocabulary: str, bands: Mapping[str, Band] = BANDS, scripts: Mapping[str, Band] = SCRIPT_BANDS, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns as they are.

    Null and empty texts go. Rows are judged one by one, on their whole texts: null ids, repeated rows, of which all or
    none stay, and empty tables need no rule, and other columns may hold nulls and have any names.
    """
    text, lang = docs.columns.index(text_col), docs.columns.index(lang_col)
    kept = [x.split()[0] for x in COLUMNS.split(", ")].index("kept")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = judge(as_bytes(batch.column(text)), as_texts(batch.column(lang)), vocabulary, bands, scripts)
        return batch.filter(pa.array([x[kept] for x in rows]))

    return map_batches(docs, work, docs.schema)
