import math
import random
import tracemalloc

import numpy as np
import pytest

from loomline.llm import topk

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, every=50, k=5):
    good = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(
            x is not None and math.isfinite(x) for x in v
        )
    ]
    out = []
    for n, (query, q) in enumerate(good):
        if query % every == 0:
            scores = [(-sum(a * b for a, b in zip(q, v, strict=True)), i) for m, (i, v) in enumerate(good) if m != n and len(v) == len(q)]
            out += [(query, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def run(spark, rows, **how):
    return sorted(tuple(x) for x in topk.top_k(spark.createDataFrame(rows, SCHEMA), **how).collect())


@pytest.mark.parametrize("how", [{}, {"block_rows": 16, "query_rows": 2}])
def test_results_are_those_of_all_pairs(spark, how):
    rng = random.Random(1)
    rows = [(k, [rng.uniform(-1.5, 1.5) for _ in range(6)]) for k in range(300)]
    rows += [(300 + k, rows[k % 3][1]) for k in range(60)]  # many ties
    rng.shuffle(rows)
    assert run(spark, rows, **how) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, -0.5]),
        (50, None),
        (100, [float("nan"), 1.0]),
        (1, [float("inf"), 0.0]),
        (2, [None, 1.0]),
        (None, [1.0, 1.0]),
        (3, [0.0, 0.0]),
        (4, [-0.1, 0.25]),
        (0, [1.0, -0.5]),
        (150, [0.5, 0.5]),
        (-50, [0.3, 0.3]),
        (5, [1.0, 2.0, 3.0]),
        (6, []),
        (200, []),
    ]
    assert run(spark, rows) == brute(rows)


def test_small_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(50, [1.0])]) == []
    assert run(spark, [(50, [1.0]), (1, [2.0])]) == [(50, 1, 1, 256 * 512)]
    assert run(spark, [(1, [1.0]), (2, [2.0])]) == []


def test_clashing_columns(spark):
    rows = [(0, [1.0], 1, 2, 3), (1, [0.5], 1, 2, 3)]
    found = topk.top_k(spark.createDataFrame(rows, SCHEMA + ", query int, score int, rank int"))
    assert [tuple(x) for x in found.collect()] == [(0, 1, 1, 256 * 128)]


@pytest.mark.parametrize("seed", range(20))
def test_sums_of_slices_are_inner_products(seed):
    rng = np.random.default_rng(seed)
    values = rng.integers(-300, 300, (rng.integers(1, 200), 5))
    query = rng.integers(-20, 20, 5)
    block = topk.BitSliced(values)
    total = np.zeros(block.words * 64, np.int64)
    for power, piece in enumerate(block.sums(query)):
        total += np.unpackbits(piece.view(np.uint8), bitorder="little").astype(np.int64) << power
    difference = total[: len(values)] - values @ query
    assert len(set(difference.tolist())) == 1  # one constant for all rows
    k = int(rng.integers(1, 10))
    best = sorted(range(len(values)), key=lambda r: (-(values[r] @ query), r))[:k]
    assert sorted(block.top(query, k).tolist()) == sorted(best)
    own = int(rng.integers(0, len(values)))
    assert own not in block.top(query, k, own).tolist()


def test_one_id_on_a_third_of_the_rows(spark):
    rng = random.Random(4)
    rows = [(50 if k % 3 == 0 else k, [rng.uniform(-1, 1) for _ in range(4)]) for k in range(90)]
    assert run(spark, rows, block_rows=16, query_rows=4) == brute(rows)


def test_components_beyond_64_bit_scores_are_an_error(spark):
    with pytest.raises(ValueError, match="64 bits"):
        run(spark, [(50, [1e30]), (1, [1.0])])


def test_an_index_of_many_attributes_is_little_more_than_its_rows():
    values = np.random.default_rng(1).integers(-256, 256, (topk.BLOCK_ROWS, 1536))
    tracemalloc.start()
    block = topk.BitSliced(values)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert block.slices.nbytes <= 9 * values.size / 8 + 1 and most < 64 << 20
    best = block.top(values[7], 5, 7)
    scores = values @ values[7]
    scores[7] = scores.min()
    assert sorted(best.tolist()) == sorted(np.argsort(-scores, kind="stable")[:5].tolist())
