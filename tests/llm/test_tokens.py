import numpy as np
import pytest
import sentencepiece

from loomline.llm import tokens
from loomline.llm.vocabularies import PIECES
from loomline.session import fresh_dir

END = 1


def brute(ids):
    """(n_tokens, ended) of each document."""
    out, n = [], 0
    for x in ids:
        if x == END:
            out.append((n, True))
            n = 0
        else:
            n += 1
    return out + ([(n, False)] if n else [])


@pytest.mark.parametrize("block_bytes", [2, 6, 64, 1 << 20])
@pytest.mark.parametrize("span", [2, 1024])
def test_counts_in_blocks_are_those_of_the_whole(spark, tmp_path, monkeypatch, block_bytes, span):
    monkeypatch.setattr(tokens, "SPAN", span)
    rng = np.random.default_rng(1)
    want = {}
    for k, (n, kinds) in enumerate([(0, 3), (1, 3), (1, 1 << 16), (40, 2), (150, 3), (150, 9), (150, 1 << 16), (64, 5)]):
        ids = rng.integers(0, kinds, n).astype("<u2")
        path = f"file://{tmp_path}/{k}.tokens"
        (tmp_path / f"{k}.tokens").write_bytes(ids.tobytes())
        want[path] = brute(ids.tolist())
    files = spark.createDataFrame([(x,) for x in want], "path string")
    found = {x: [] for x in want}
    for row in tokens.count_tokens(files.union(files), END, block_bytes=block_bytes).orderBy("path", "ordinal").collect():
        assert row["ordinal"] == len(found[row["path"]])
        found[row["path"]].append((row["n_tokens"], row["ended"]))
    assert found == want


def test_other_widths_and_a_broken_last_id(spark, tmp_path):
    ids = np.array([5, 6, END, END, 70000], "<u4")
    (tmp_path / "a").write_bytes(ids.tobytes() + b"\x01\x00")
    found = tokens.count_tokens(spark.createDataFrame([(f"file://{tmp_path}/a",)], "path string"), END, width=4, block_bytes=8)
    assert sorted((x["ordinal"], x["n_tokens"], x["ended"]) for x in found.collect()) == [(0, 2, True), (1, 0, True), (2, 1, False)]


def test_documents_get_their_counts(spark):
    rows = [(k, f"some words {'again ' * (k % 7)} 你好 </s>", k) for k in range(40)] + [
        (None, "no id", 0), (3, None, 0), (3, "", 0), (4, "long " * 50_000, 0)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ordinal int").repartition(3)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    files = tokens.write_tokens(docs, fresh_dir(spark, "tokens"), PIECES)
    found = tokens.named(tokens.count_tokens(files), files).collect()
    assert sorted(map(tuple, found), key=str) == sorted(((doc, len(model.encode(text or ""))) for doc, text, _ in rows), key=str)


def test_empty_table(spark):
    files = tokens.write_tokens(spark.createDataFrame([], "doc_id long, text string"), fresh_dir(spark, "tokens"), PIECES)
    assert tokens.named(tokens.count_tokens(files), files).count() == 0
