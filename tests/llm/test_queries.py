"""The registered queries on a small folder of tables, against brute force and, where there is one, their statement."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from loomline.llm import queries, secrets
from loomline.llm.vocabularies import PIECES
from tests.llm.test_licenses import APACHE, MIT, brute_scan
from tests.llm.test_mixing import brute_targets
from tests.llm.test_packing import brute_pieces, check_packed
from tests.llm.test_quality import brute_counts
from tests.llm.test_secrets import TOKEN, brute_base
from tests.llm.test_simhash import brute as brute_groups
from tests.llm.test_topk import brute as brute_top
from tests.llm.test_urls import addresses
from tests.llm.test_urls import brute as brute_url
from tests.llm.test_warc import brute as brute_warc

WORDS = "time year people way day man thing woman life child world school state family student group country".split()


def documents():
    rng = random.Random(9)
    rows = []
    for k in range(160):
        text = " ".join(rng.choices(WORDS, k=rng.choice([1, 5, 40, 300, 1500])))
        if k % 9 == 1:
            text = rows[-1][1]
        if k % 12 == 3:
            text += f"\n{rng.choice([MIT, APACHE])}\nsecret: {TOKEN}"
        rows.append((k, text, rng.choice(["en", "de", None]), rng.choice(["web", "web", "web", "book", None]), len(text)))
    return [*rows, (900, None, "en", "web", None), (901, "", "en", "book", 0)]


def pages():
    rng = random.Random(8)
    bodies = ["<p>" + "x" * n + "</p>" for n in (0, 10, 990, 992, 993, 1000, 5000)] + [None]
    return [(k, url, rng.choice(bodies)) for k, url in enumerate(addresses()[:120])]


def embeddings():
    rng = random.Random(7)
    return [(k, [rng.uniform(-1, 1) for _ in range(8)], 0) for k in range(210)] + [(300, None, 1), (350, [1.0] * 7 + [float("nan")], 1)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    tables = {
        "documents": (documents(), "doc_id long, text string, lang string, source string, n_chars long"),
        "pages": (pages(), "page_id long, url string, html string"),
        "embeddings": (embeddings(), "vec_id long, embedding array<float>, label int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"file://{path}/{name}.parquet")
    return str(path)


def run(spark, folder, name):
    return queries.QUERIES[name](spark, f"file://{folder}").collect()


@pytest.mark.parametrize("name", sorted(set(queries.ORACLE_SQL) - {"pipeline"}))
def test_statements_have_the_same_rows(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    told = con.execute(queries.ORACLE_SQL[name])
    names = [x[0] for x in told.description]
    want = Counter(tuple(r) for r in told.fetchall())
    assert Counter(tuple(x[c] for c in names) for x in run(spark, folder, name)) == want and want


def test_op1(spark, folder):
    docs = documents()
    counts = Counter(t for _, text, *_ in docs for t in set(re.findall("[a-z0-9]+", (text or "").lower())))
    own = {d[0]: brute_scan(d[1], counts, len(docs)) for d in docs}
    # every fourth document is a licence file of its source and language, and hands down the best of them
    handed = {}
    for doc, _, lang, source, _ in docs:
        if doc % 4 == 0 and own[doc]:
            key = (source or "none", lang or "none")
            handed[key] = min(handed.get(key, (9, "")), (-round(own[doc][1], 9), own[doc][0]))
    found = {x["doc_id"]: x for x in run(spark, folder, "op1_license_scan")}
    assert len(found) == len(docs)
    for doc, _, lang, source, _ in docs:
        home = (source or "none", lang or "none")
        if own[doc]:
            want = (own[doc][0], "file" if doc % 4 == 0 else "header", None)
        else:
            want = (handed[home][1], "inherited", "/".join(home)) if home in handed else (None, "none", None)
        assert (found[doc]["licence"], found[doc]["origin"], found[doc]["from_dir"]) == want
        name = f"LICENSE-{doc}" if doc % 4 == 0 else f"{doc % 10}/{doc}.txt"
        assert found[doc]["path"] == "/".join((*home, name))
    assert {x["origin"] for x in found.values()} == {"file", "header", "inherited", "none"}


def test_op2(spark, folder):
    for row, (page, url, _) in zip(sorted(run(spark, folder, "op2_url_filter"), key=lambda x: x["page_id"]), pages(), strict=True):
        host, path, rule, verdict = brute_url(url)
        assert (row["page_id"], row["host"], row["path"], row["rule"]) == (page, host, path, rule)
        assert rule is None or row["verdict"] == verdict


def test_op3(spark, folder):
    found = run(spark, folder, "op3_simhash_near_dedup")
    assert Counter((x["doc_id"], x["fingerprint"], x["component_id"]) for x in found) == Counter(brute_groups([d[:2] for d in documents()]))


def test_op4(spark, folder):
    found = {x["doc_id"]: x for x in run(spark, folder, "op4_secret_scan")}
    assert len(found) == len(documents())
    for doc, text, *_ in documents():
        base = brute_base(text or "")
        assert [found[doc][f"n_{k}"] for k in secrets.BASE] == [sum(x[0] == k for x in base) for k in secrets.BASE]
        assert set(filter(None, found[doc]["spans"].split(","))) >= {f"{k}:{a}:{b}" for k, a, b in base}


def test_op5(spark, folder):
    found = run(spark, folder, "op5_warc_salvage")
    assert sorted(map(tuple, found), key=str) == brute_warc(pages())


def test_op6(spark, folder):
    sizes, source_of, taken = Counter(), {d[0]: d[3] for d in documents()}, defaultdict(int)
    for _, text, _, source, _ in documents():
        sizes[source] += len((text or "").split())
    targets = brute_targets(sizes)
    for x in run(spark, folder, "op6_source_mix"):
        source = source_of[x["doc_id"]]
        assert x["source_size"] == sizes[source] and x["target"] == pytest.approx(targets[source])
        assert x["taken"] in {n * x["size"] for n in range(4)}
        taken[source] += x["taken"]
    assert all(abs(taken[s] - targets[s]) <= 750 for s in sizes)  # half of the largest document


def test_op7(spark, folder):
    found = run(spark, folder, "op7_bit_sliced_top_k")
    assert sorted(map(tuple, found)) == brute_top([r[:2] for r in embeddings()])


def test_op8(spark, folder):
    found = run(spark, folder, "op8_best_fit_packing")
    want = Counter((d[0], *piece) for d in documents() for piece in brute_pieces(d[1]))
    assert Counter((x["doc_id"], x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in found) == want
    assert check_packed(found, 1024) <= -(-sum(x["length"] for x in found) // 1024) + 1


def test_op9(spark, folder):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = {x["doc_id"]: x["n_tokens"] for x in run(spark, folder, "op9_token_counts")}
    assert found == {d[0]: len(model.encode(d[1] or "")) for d in documents()}


def test_op10(spark, folder):
    found = {x["doc_id"]: x for x in run(spark, folder, "op10_quality_rules")}
    for doc, text, *_ in documents():
        counts, row = brute_counts(text), found[doc]
        assert tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == counts
        assert row["base_failed"] == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert not (row["kept"] and row["base_failed"])
