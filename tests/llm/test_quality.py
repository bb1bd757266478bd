import math
import random
from collections import Counter

import pytest

from loomline.llm import quality
from loomline.llm.vocabularies import PIECES

SCHEMA = "doc_id long, text string, lang string"
WORDS = "time year people way day man thing woman life child world school state family student group country problem hand part place case week company system".split()


def brute_counts(text):
    text = text or ""
    blank = " \t\n\x0b\x0c\r"
    words, now = [], ""
    for c in text + " ":
        if c in blank:
            if now:
                words.append(now)
            now = ""
        else:
            now += c
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if any(c not in blank for c in line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)


def prose(seed, n=300):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(n))


def texts():
    rng = random.Random(0)
    out = [
        None,
        "",
        " \t\n",
        "one",
        "a b c",
        "x " * 50,
        "# $ % & | < > * **",
        prose(1),
        prose(2) + "\n" + prose(2),
        "line\nline\n\n\nline \nline",
    ]
    for seed in range(20):
        some = [rng.choice("abc") for _ in range(rng.randint(1, 60))]
        out.append(rng.choice([" ", "\n", "\t"]).join(some))
    return out


@pytest.mark.parametrize("text", texts())
def test_base_counts(text):
    assert quality.base_counts((text or "").encode()) == brute_counts(text)


def test_the_query_columns_follow_the_contract(spark):
    rows = [(k, text, None if k % 3 else "en") for k, text in enumerate(texts())] + [(None, prose(5), "xx"), (0, None, None)]
    found = quality.quality_rules(spark.createDataFrame(rows, SCHEMA), PIECES).collect()
    assert len(found) == len(rows)
    for row, (doc, text, _) in zip(found, rows, strict=True):
        counts = brute_counts(text)
        assert row["doc_id"] == doc
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == counts
        assert row["base_failed"] == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert not (row["base_failed"] and row["kept"])


def test_fertility_is_that_of_the_vocabulary(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    text = prose(3) + " 你好 \U0001f600"
    ids = model.encode(text)
    row = quality.quality_rules(spark.createDataFrame([(1, text, "en")], SCHEMA), PIECES).first()
    shares = [n / len(ids) for n in Counter(ids).values()]
    assert row["n_tokens"] == len(ids)
    assert row["chars_per_token"] == pytest.approx(row["word_chars"] / len(ids))
    assert row["fallback_share"] == pytest.approx(sum(map(model.is_byte, ids)) / len(ids))
    assert row["token_entropy"] == pytest.approx(-sum(p * math.log2(p) for p in shares))


def test_bands():
    band = quality.Band((1.5, 6.0), 0.1)
    assert quality.fits(band, 1000, 2.0, 0.0, 7.0)
    assert not quality.fits(band, 1000, 1.0, 0.0, 7.0)
    assert not quality.fits(band, 1000, 2.0, 0.2, 7.0)
    assert not quality.fits(band, 1000, 2.0, 0.0, 4.0)
    assert quality.fits(band, 10, 0.1, 1.0, 0.0)
    assert quality.floor_of(128) < quality.floor_of(200) < quality.floor_of(256)


@pytest.mark.parametrize(
    ("text", "script"),
    [("plain words", "latin"), ("Привет a", "cyrillic"), ("你好世界", "han"), ("αβγ", "greek"), ("123", "other"), ("", "other")],
)
def test_scripts(text, script):
    assert quality.script_of(text) == script


def test_tags_that_are_names_of_scripts_take_the_band_of_the_text(spark):
    docs = spark.createDataFrame([(k, prose(7), lang) for k, lang in enumerate(["other", "han", "xx", "", None])], SCHEMA)
    assert {x["band"] for x in quality.quality_rules(docs, PIECES).collect()} == {"latin"}


def test_repeated_junk_goes_and_rows_keep_their_columns(spark):
    junk = " ".join(f"{a} {b}" for a in "abcdefgh" for b in "ijklmnop") + " " + " ".join("zz yy xx".split() * 3)
    docs = spark.createDataFrame(
        [(1, prose(7), "en", "kept?"), (2, "the " * 300, "en", "x"), (3, None, "en", "y"), (4, junk, "fr", "z")], SCHEMA + ", kept string"
    )
    kept = quality.keep_quality(docs, PIECES)
    assert kept.columns == docs.columns
    assert 2 not in {x["doc_id"] for x in kept.collect()} and 3 not in {x["doc_id"] for x in kept.collect()}
    judged = {x["doc_id"]: x["kept"] for x in quality.quality_rules(docs, PIECES).collect()}
    assert {x["doc_id"] for x in kept.collect()} == {k for k, v in judged.items() if v}


def test_empty_table_and_long_text(spark):
    assert quality.quality_rules(spark.createDataFrame([], SCHEMA), PIECES).count() == 0
    assert quality.keep_quality(spark.createDataFrame([], SCHEMA), PIECES).count() == 0
    long = prose(9, 200_000)
    row = quality.quality_rules(spark.createDataFrame([(1, long, "en")], SCHEMA), PIECES).first()
    assert row["n_words"] == 200_000 and row["n_repeat_words"] == brute_counts(long)[4]
