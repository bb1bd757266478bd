import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__
import corpus_pipeline
from loomline.llm import quality, secrets
from tests.llm.test_mixing import brute_targets
from tests.llm.test_packing import brute_pieces, check_packed
from tests.llm.test_quality import brute_counts
from tests.llm.test_secrets import brute_base, brute_hot
from tests.llm.test_simhash import brute as brute_groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [
    a + b for a in "time year people way day man thing woman life child world school state".split() for b in (
        "", "s", "like", "less", "ward", "ly"
    )
]
TOKEN = "Zk3xT9qLm2Vb8NwR5yHs7PdF1cGj4AuE"


def corpus():
    rng = random.Random(1)
    rows = []
    for k in range(120):
        text = " ".join(rng.choices(WORDS, k=rng.choice([30, 200, 900, 3000])))
        if k % 10 == 1:
            text = rows[-1][1] + (" end" if k % 20 == 1 else "")
        if k % 15 == 2:
            text += ' token = "0123456789abcdef0123456789abcdef"'
        if k % 15 == 4:
            text += f" key {TOKEN} and <|endoftext|>"
        if k % 20 == 3:
            text = "junk " * 50
        rows.append((k, text, "en", f"s{k % 5}", len(text)))
    other = "the same text in two sources " + " ".join(WORDS)
    rows += [(600, other, "en", "s1", 1), (600, other, "en", "s4", 1)]
    return [*rows, (500, None, None, None, None), (501, "", "en", "s1", 0), (None, " ".join(WORDS), None, None, None), rows[0], rows[0]]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(corpus(), SCHEMA).write.parquet(f"file://{path}/documents.parquet")
    return f"file://{path}"


def brute_quality(rows):
    """Rows that the base rules and the bands of their language or script (all of the test's are Latin) keep."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.PIECES)
    floors = sorted(quality.ENTROPY_FLOOR.items())
    out = []
    for row in rows:
        words, chars, _, _, repeated = brute_counts(row[1])
        if words < 20 or 100 * repeated > 30 * words:
            continue
        ids = model.encode(row[1])
        n = len(ids)
        band = quality.BANDS.get(row[2]) or quality.SCRIPT_BANDS["latin"]
        (low, bits), (high, more) = [x for x in floors if x[0] <= max(n, floors[0][0])][-1], [x for x in floors if x[0] >= min(n, floors[-1][0])][0]
        floor = bits if high == low else bits + (more - bits) * math.log(n / low) / math.log(high / low)
        entropy = -sum(x / n * math.log2(x / n) for x in Counter(ids).values())
        fallback = sum(map(model.is_byte, ids)) / n
        if n < 40 or band.chars[0] <= chars / n <= band.chars[1] and fallback <= band.fallback and entropy >= band.floor * floor:
            out.append(row)
    return out


def brute_masked(text):
    """What is covered by a base pattern, or by a hot window outside one; the test's texts hold nothing allow-listed."""
    spans = [(a, b) for _, a, b in brute_base(text)]
    for of in secrets.CLASSES:
        for run in of.run.finditer(text):
            spans += [(run.start() + a, run.start() + b) for a, b in brute_hot(run[0], of.window, of.bits, of.needs, of.least)]
    covered = "".join("\0" if any(a <= i < b for a, b in spans) else c for i, c in enumerate(text)) if spans else text
    return re.sub("\0+", "[SECRET]", covered)


def brute_mix(rows):
    """How often each row is taken; one source a document, so that the flow is each source's quota."""
    of, sizes, times = defaultdict(list), Counter(), {}
    for row in rows:
        of[row[3]].append(row)
        sizes[row[3]] += len(row[1].split())
    targets = brute_targets(sizes)
    for source, own in of.items():
        rounds, rest = divmod(round(targets[source]), sizes[source])
        drawn = {row: hashlib.md5(f"42:{row[0]}".encode()).hexdigest() for row in own}
        size = {row: len(row[1].split()) for row in own}
        before, last = 0, {}
        for row in sorted(own, key=lambda r: (drawn[r], size[r], r[0] or 0)):
            last[row] = size[row] if rest - before > before + size[row] - rest else 0
            before += size[row]
        gap = rest - sum(last.values())
        closer = [r for r in own if rest and gap and abs(abs(gap) - size[r]) < abs(gap) and (gap > 0) == (last[r] == 0)]
        if closer:
            turned = min(closer, key=lambda r: (abs(abs(gap) - size[r]), drawn[r]))
            last[turned] = size[turned] - last[turned]
        times |= {row: rounds + last[row] // size[row] for row in own}
    return Counter({row: n for row, n in times.items() if n})


def test_the_run_is_that_of_a_brute_force(spark, folder):
    rows = corpus()
    kept = brute_quality(rows)
    assert 0 < len(kept) < len(rows)

    heads = {x[2] for x in brute_groups([r[:2] for r in kept])}
    single = [r for r in set(kept) if r[0] in heads and r[0] != 600]
    # of rows that share an id the smallest hash stays
    both = [r for r in set(kept) if r[0] == 600]
    found = list(map(tuple, corpus_pipeline.near_dedup(spark, spark.createDataFrame(kept, SCHEMA), folder).collect()))
    stays = [r for r in found if r[0] == 600]
    assert len(both) == 2 and len(stays) == 1 and stays[0] in both
    assert Counter(found) == Counter(single + stays)

    clean = []
    for row in found:
        text = brute_masked(row[1])
        clean.append((row[0], text, *row[2:4], len(text) if text != row[1] else row[4]))
    assert sum("[SECRET]" in r[1] for r in clean) > 5

    want = Counter()
    for row, n in brute_mix(clean).items():
        for piece in brute_pieces(row[1]):
            want[row[0], *piece] += n
    result = corpus_pipeline.run(spark, folder).collect()
    assert Counter((x["doc_id"], x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in result) == want
    check_packed(result, 1024)


def test_rows_of_one_id_keep_their_sources(spark, folder):
    text = " ".join(WORDS)
    rows = [(1, text, "en", "a", 1), (1, text, "en", "b", 1), (2, " ".join(WORDS * 8), "en", "a", 1)]
    taken = corpus_pipeline.mix(spark, spark.createDataFrame(rows, SCHEMA), folder)
    assert Counter(map(tuple, taken.collect())) == brute_mix(rows)


def test_run_leaves_one_copy(spark, folder):
    folders = lambda: {x.getPath().getName() for x in files.listStatus(root)}
    from loomline.session import shared_dir

    root = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    before = folders()
    corpus_pipeline.run(spark, folder).count()
    assert len([x for x in folders() - before if x.startswith("pipeline")]) == 1


EMPTY = SCHEMA + ", key string, extra int, row int, h string, times int, size int, sequence_id int"


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_tables(spark, stage):
    assert stage(spark, spark.createDataFrame([], EMPTY), "").count() == 0


def test_stages_take_nulls_ties_and_further_columns(spark):
    more = ("k", 1, 2, "h", 3, 4, 5)
    rows = [(None, None, None, None, None, *more), (1, "", "en", None, 0, *more), (1, "", "en", None, 0, *more), (2, "two words", None, "a", None, *more)]
    docs = spark.createDataFrame(rows, EMPTY)
    columns = [r[:5] for r in rows]
    assert corpus_pipeline.quality(spark, docs, "").collect() == []
    # null and empty texts are copies; the smallest id stays, of repeated rows one
    assert Counter(map(tuple, corpus_pipeline.near_dedup(spark, docs, "").collect())) == Counter([columns[1], columns[3]])
    assert Counter(map(tuple, corpus_pipeline.secrets(spark, docs, "").collect())) == Counter(columns)
    # one source has words: it gives them once, and no text without words is taken
    assert list(map(tuple, corpus_pipeline.mix(spark, docs, "").collect())) == [columns[3]] * 1
    found = corpus_pipeline.packing(spark, docs, "").collect()
    want = Counter((r[0], *piece) for r in columns for piece in brute_pieces(r[1]))
    assert Counter((x["doc_id"], x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in found) == want
    assert check_packed(found, 1024) == 1


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near-dedup", "secrets", "source mix", "packing"]
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert set(__spark_entry__.oracle_sql()) <= set(names)
