import random

import numpy as np
import pytest
import xxhash

from loomline.llm import simhash

SCHEMA = "doc_id long, text string"


def brute_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """doc_id, fingerprint and component of each row, by all pairs."""
    prints = [brute_print(text) for _, text in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                group[find(i)] = find(j)
    ids = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(k)] = min(ids.get(find(k), doc), doc)
    return [(doc, f"{prints[k]:016x}", ids.get(find(k))) for k, (doc, _) in enumerate(rows)]


def texts(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(50)]
    base = [" ".join(rng.choices(words, k=rng.choice([1, 2, 3, 40, 400]))) for _ in range(n)]
    out = list(base)
    for text in base[:30]:
        for _ in range(rng.randint(0, 4)):
            parts = text.split()
            if len(parts) > 30:
                parts[rng.randrange(len(parts))] = "changed"
            out.append(" ".join(parts).upper() if rng.random() < 0.3 else "\n ".join(parts))
    return out


def key(rows):
    return sorted(rows, key=str)


def run(spark, rows):
    found = simhash.simhash_components(spark.createDataFrame(rows, SCHEMA))
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    return key([tuple(x) for x in found.collect()])


def test_components_are_those_of_all_pairs(spark):
    rows = list(enumerate(texts(1)))
    random.Random(2).shuffle(rows)
    assert run(spark, rows) == key(brute(rows))
    assert len({x[2] for x in brute(rows)}) < len(rows)


def test_nulls_empty_texts_and_repeated_rows(spark):
    rows = [(5, None), (3, ""), (None, " \t\n"), (7, "one"), (7, "one"), (None, "alone in the world of words"), (9, "Ünï çödé words here")]
    assert run(spark, rows) == key(brute(rows))


def test_empty_table(spark):
    assert run(spark, []) == []


def test_very_long_text_and_clashing_columns(spark):
    long = " ".join(f"word{k % 977}" for k in range(300_000))
    rows = [(1, long, 5, 6, 7), (2, long + " end", 5, 6, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp long, id long, key long")
    found = simhash.simhash_components(docs).collect()
    assert {x["component_id"] for x in found} == {1}
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns and [x["doc_id"] for x in kept.collect()] == [1]


@pytest.mark.parametrize("block", [3, 8, 4096])
def test_blocks_of_long_postings_lose_no_link(spark, block):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 63, dtype=np.uint64)
    near = {int(centre)}
    while len(near) < 120:  # a dense ball, and some strangers
        x = int(rng.choice(list(near)))
        for _ in range(rng.integers(1, 4)):
            x ^= 1 << int(rng.integers(0, 64))
        near.add(x)
    every = [*near, *map(int, rng.integers(0, 1 << 63, 60, dtype=np.uint64))]
    signed = [x - (1 << 64) if x >> 63 else x for x in every]
    links = [
        (x["a"] % (1 << 64), x["b"] % (1 << 64)) for x in simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"), block).collect()
    ]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    group = {x: x for x in every}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in links:
        group[find(a)] = find(b)
    brute_group = {x: x for x in every}
    for a in every:
        for b in every:
            if (a ^ b).bit_count() <= 3:
                x, y = a, b
                while brute_group[x] != x:
                    x = brute_group[x]
                while brute_group[y] != y:
                    y = brute_group[y]
                brute_group[x] = y

    def classes(f):
        out = {}
        for x in every:
            out.setdefault(f(x), set()).add(x)
        return sorted(map(sorted, out.values()))

    def brute_find(x):
        while brute_group[x] != x:
            x = brute_group[x]
        return x

    assert classes(find) == classes(brute_find)


def test_keys_bring_all_pairs_together_that_share_five_bytes():
    from itertools import combinations

    for shared in combinations(range(8), 5):
        assert any(set(k) <= set(shared) for k in simhash.KEYS)


def test_one_row_of_each_group_stays(spark):
    rows = list(enumerate(texts(4)))
    rows += [(None, "lonely words without any id at all"), (None, "lonely words without any id at all"), rows[0], rows[0]]
    kept = simhash.drop_near_copies(spark.createDataFrame(rows, SCHEMA)).collect()
    components = {x[2] for x in brute(rows)}
    assert key(x["doc_id"] for x in kept) == key(components)
    assert {tuple(x) for x in kept} <= set(rows)
