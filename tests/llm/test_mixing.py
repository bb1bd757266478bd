import random
from collections import Counter, defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from loomline.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def brute_targets(sizes):
    order = sorted(sizes, key=lambda x: (x is None, x or ""))
    weight = {x: k % 3 + 1 for k, x in enumerate(order)}
    total, free, out = sum(sizes.values()), list(order), {}
    while True:
        rest = total - sum(out.values())
        shares = {x: rest * weight[x] / sum(weight[y] for y in free) for x in free}
        over = [x for x in free if shares[x] > 3 * sizes[x]]
        if not over:
            return out | shares
        for x in over:
            out[x] = 3 * sizes[x]
        free = [x for x in free if x not in out]


def corpus(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        source = rng.choice(["a"] * 10 + ["b", "ß", "Z", None, "tiny"] if k else ["tiny"])
        words = 1 if source == "tiny" else rng.choice([0, 1, 5, 30, 200])
        rows.append((k, rng.choice([" ", "\n\t "]).join(["w"] * words) if words or k % 2 else None, source))
    return rows


def run(spark, rows):
    return mixing.mix_sources(spark.createDataFrame(rows, SCHEMA)).collect()


def test_contract(spark):
    rows = corpus(1)
    found = run(spark, rows)
    assert sorted(x["doc_id"] for x in found) == [r[0] for r in rows]
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    targets, taken = brute_targets(sizes), defaultdict(int)
    source_of = {r[0]: r[2] for r in rows}
    for x in found:
        source = source_of[x["doc_id"]]
        assert x["size"] == len((rows[x["doc_id"]][1] or "").split())
        assert x["source_size"] == sizes[source]
        assert x["target"] == pytest.approx(targets[source])
        assert x["taken"] <= 3 * x["size"] and (x["taken"] == 0 or x["taken"] % x["size"] == 0)
        taken[source] += x["taken"]
    largest = max(len((t or "").split()) for _, t, _ in rows)
    for source, target in targets.items():
        assert abs(taken[source] - target) <= largest / 2 + 1
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, run(spark, random.Random(5).sample(rows, len(rows)))), key=str)


def test_a_source_below_its_share_gives_its_excess_away():
    targets = mixing.targets_of({"a": 100, "b": 1, None: 100}, {"a": 1, "b": 2, None: 3})
    assert targets["b"] == 3.0 and sum(targets.values()) == pytest.approx(201)
    assert targets[None] == pytest.approx(3 * targets["a"])


def brute_flow(capacities, quotas):
    """Least cost of meeting as much of the quotas as can be met, by all splits."""
    sets = list(capacities)
    splits = []
    for of in sets:
        most = 3 * capacities[of]
        splits.append([x for x in product(*(range(min(most, quotas[s]) + 1) for s in of)) if sum(x) <= most])
    best = (0, 0)
    for choice in product(*splits):
        given = Counter()
        for of, x in zip(sets, choice, strict=True):
            for s, n in zip(of, x, strict=True):
                given[s] += n
        if any(given[s] > quotas[s] for s in quotas):
            continue
        cost = sum(sum(1 + k // max(1, capacities[of]) for k in range(sum(x))) for of, x in zip(sets, choice, strict=True))
        best = min(best, (-sum(given.values()), cost))
    return best


@pytest.mark.parametrize("seed", range(6))
def test_flow_is_largest_and_cheapest(seed):
    rng = random.Random(seed)
    capacities = {("a",): rng.randint(0, 3), ("b",): rng.randint(0, 3), ("a", "b"): rng.randint(0, 3)}
    quotas = {"a": rng.randint(0, 6), "b": rng.randint(0, 6)}
    taken = mixing.flow(capacities, quotas)
    cost = sum(sum(1 + k // max(1, capacities[of]) for k in range(n)) for of, n in taken.items())
    assert (-sum(taken.values()), cost) == brute_flow(capacities, quotas)


def test_overlapping_sources(spark):
    rng = random.Random(3)
    kinds = [["a"], ["b"], ["a", "b"], ["b", "a", "a"], [], None]
    rows = [(k, "w " * rng.randint(1, 20), kinds[k % 6]) for k in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    found = {x["doc_id"]: x for x in mixing.mix_sources(docs).collect()}
    assert len(found) == len(rows)
    capacities, taken, most = Counter(), Counter(), Counter()
    for doc, text, sources in rows:
        of = tuple(sorted(set(sources or []))) or (None,)
        size = len(text.split())
        assert found[doc]["size"] == size and tuple(found[doc]["sources"]) == of
        assert found[doc]["taken"] in {0, size, 2 * size, 3 * size}
        capacities[of] += size
        taken[of] += found[doc]["taken"]
        most[of] = max(most[of], size)
    sizes = {s: sum(n for of, n in capacities.items() if s in of) for s in ("a", "b", None)}
    targets = mixing.targets_of(sizes, {"a": 1, "b": 2, None: 3})
    assert all(x["target"] == targets[x["sources"][0]] and x["source_size"] == sizes[x["sources"][0]] for x in found.values())
    # each set gives what the flow takes from it, to half of one of its documents; the flow itself has a brute force above
    flowed = mixing.flow(capacities, {s: round(t) for s, t in targets.items()})
    assert all(abs(taken[of] - flowed[of]) <= most[of] / 2 for of in capacities)
    assert abs(sum(taken.values()) - sum(targets.values())) <= sum(most.values()) / 2 + 2


def test_rows_of_equal_id_and_text_are_taken_from_their_own_source(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, "a"), (1, text, "b"), (2, "x " * 40, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"_0": F.lit(1), "times": F.lit(2), "row": F.lit("r")})
    want = Counter()
    for x in mixing.mixed(docs).where("taken > 0").collect():
        want[x["doc_id"], x["sources"][0]] += x["taken"] // x["size"]
    taken = mixing.take_mix(docs)
    assert taken.columns == docs.columns
    assert Counter((x["doc_id"], x["source"]) for x in taken.collect()) == want
    assert want[1, "a"] <= 1 and want[1, "b"] == 3


def test_edge_cases(spark):
    assert run(spark, []) == []
    assert [x["taken"] for x in run(spark, [(1, None, None), (None, "", "a")])] == [0, 0]
    rows = [(None, "one two", "a"), (None, "one two", "a"), (7, "x", "b"), (7, "x", "b")]
    found = run(spark, rows)
    assert len(found) == 4 and all(x["taken"] <= 3 * x["size"] for x in found)


def test_the_stage_takes_rows_as_often_as_the_mix_does(spark):
    rows = [(*r, 1) for r in corpus(2)]
    docs = spark.createDataFrame(rows, SCHEMA + ", size int")
    took = Counter(x["doc_id"] for x in mixing.take_mix(docs).collect())
    want = {x["doc_id"]: x["taken"] // x["size"] for x in mixing.mix_sources(docs).collect() if x["taken"]}
    assert took == want and max(took.values()) > 1
    again = docs.union(docs.where("doc_id < 3")).union(docs.where("doc_id < 3").withColumn("doc_id", docs["doc_id"] * 0 + None))
    assert mixing.take_mix(again.select(docs.columns)).columns == docs.columns
