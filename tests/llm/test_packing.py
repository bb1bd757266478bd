import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from tokenizers import Tokenizer

from loomline.llm import packing
from loomline.llm.vocabularies import BYTE_BPE, BYTE_BPE_RANKS

SCHEMA = "doc_id long, text string"


def check_packed(rows, capacity):
    """Gapless, within the capacity, no piece over another."""
    by = {}
    for row in rows:
        by.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def brute_pieces(text):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
    n = len(ids)
    cuts = [0, *range(n % 1024 or 1024, n, 1024), n] if n > 1024 else [0, n]
    return [
        (k, a, b - a, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[a:b]))) for k, (a, b) in enumerate(
            zip(cuts, cuts[1:], strict=False)
        )
    ]


def test_pieces_and_places(spark):
    rng = random.Random(1)
    words = ["alpha", "beta", "Gamma", "déjà", "你好", "\U0001f600", "<|endoftext|>", "x​y", " ", "1234", "\x85"]
    rows = [(k, " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 200, 1500])))) for k in range(60)]
    rows += [(100, None), (101, ""), (None, "no id"), (5, rows[5][1]), (5, rows[5][1])]
    # columns of the names that the operator uses itself
    docs = spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], SCHEMA + ", length int, sequence_id int, _row int, piece string")
    found = packing.best_fit_packing(docs, BYTE_BPE, BYTE_BPE_RANKS).collect()
    want = Counter((doc, *piece) for doc, text in rows for piece in brute_pieces(text))
    assert Counter((x["doc_id"], x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in found) == want
    total = sum(x["length"] for x in found)
    assert check_packed(found, 1024) <= 1.1 * (-(-total // 1024)) + 2


def test_fast_and_exact_encoders_agree():
    exact = Tokenizer.from_file(BYTE_BPE)
    rng = random.Random(2)
    alphabet = "abc XYZ 019 ,.'\n\téñ¿ \u0085你́'ll 're<|endoftext|>"
    for _ in range(300):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 60)))
        assert packing.token_ids(text, BYTE_BPE, BYTE_BPE_RANKS).tolist() == exact.encode(text, add_special_tokens=False).ids
    assert packing.token_ids("a" * 20_000, BYTE_BPE, BYTE_BPE_RANKS).tolist() == exact.encode("a" * 20_000, add_special_tokens=False).ids
    assert packing.token_ids("hi <|endoftext|> there", BYTE_BPE, BYTE_BPE_RANKS).tolist() == [5303, 220, 50256, 612]
    assert not packing.PLAIN.fullmatch("\u0085") and packing.PLAIN.fullmatch("café")


@pytest.mark.parametrize("n", [1, 1023, 1024, 1025, 2048, 5000])
def test_cuts(n):
    pieces = packing.pieces_of(np.zeros(n))
    assert pieces[0][0] == 0 and sum(b for _, b in pieces) == n
    assert all(b == 1024 for _, b in pieces[1:]) and all(a + b == c for (a, b), (c, _) in zip(pieces, pieces[1:], strict=False))


@pytest.mark.parametrize(("seed", "capacity", "n"), [(1, 1024, 3000), (2, 64, 500), (3, 10, 50), (4, 1024, 1), (5, 1024, 40)])
def test_plans_hold_every_length_and_come_near_the_bound(seed, capacity, n):
    rng = random.Random(seed)
    histogram = Counter(min(capacity, max(1, int(rng.lognormvariate(np.log(capacity / 4), 0.8)))) for _ in range(n))
    plan = packing.plan(histogram, capacity)
    held = Counter()
    for config, times in plan.items():
        assert sum(config) <= capacity
        for length in config:
            held[length] += times
    assert held == histogram
    bound = -(-sum(k * v for k, v in histogram.items()) // capacity)
    assert bound <= plan.total() <= packing.best_fit(histogram, capacity).total()
    assert plan.total() <= 1.005 * bound + 2


@pytest.mark.parametrize("seed", range(20))
def test_the_fullest_configuration_is_the_fullest(seed):
    rng = random.Random(seed)
    left = Counter(rng.randint(1, 12) for _ in range(9))
    config = packing.fullest(left, 20)
    assert not Counter(config) - left and max(config) == max(left) and sum(config) <= 20
    rest = list((left - Counter([max(left)])).elements())
    best = max(sum(x) for n in range(len(rest) + 1) for x in combinations(rest, n) if sum(x) <= 20 - max(left))
    assert sum(config) == max(left) + best


def test_a_common_length_is_dealt_to_groups_and_full_pieces_stand_alone(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 2)
    lengths = [8] * 40 + [3] * 700 + [5] * 11 + [1] * 30
    pieces = spark.createDataFrame([(k, n) for k, n in enumerate(lengths)], "doc_id long, length long").repartition(5)
    found = packing.pack(pieces, 8).collect()
    assert Counter(x["length"] for x in found) == Counter(lengths)
    assert len({x["doc_id"] for x in found}) == len(lengths)
    used = check_packed(found, 8)
    assert used <= 40 + packing.best_fit(Counter(x for x in lengths if x < 8), 8).total()


def test_the_program_prices_the_best_knapsack():
    lengths, prices = np.array([3, 4, 6]), np.array([3.1, 4.3, 6.1])
    value, last = packing.priced(prices, lengths, 11)
    best = max(a * 3.1 + b * 4.3 + c * 6.1 for a in range(4) for b in range(3) for c in range(2) if 3 * a + 4 * b + 6 * c <= 11)
    assert value[11] == pytest.approx(best)
    held = packing.held_by(11, last, lengths)
    assert sum(prices[k] * n for k, n in held.items()) == pytest.approx(best)


def test_empty_table(spark):
    assert packing.best_fit_packing(spark.createDataFrame([], SCHEMA), BYTE_BPE, BYTE_BPE_RANKS).count() == 0
