"""SimHash near-duplicates by a byte-position inverted index with count filtering."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import as_bytes, components, map_batches, picked, row_hash
from loomline.session import cut, ship

SHINGLE = 3
BITS = 64
DISTANCE = 3
#: Bytes of a fingerprint, and how many of them two fingerprints within DISTANCE share at least.
BYTES = BITS // 8
SHARED = BYTES - DISTANCE
#: Byte positions of the index's keys. Of any five shared positions three lie in one half of the eight,
#: so that the three-byte keys within both halves bring every pair that reaches the minimum together.
KEYS = [c for half in (range(4), range(4, 8)) for c in combinations(half, 3)]
#: Fingerprints of one posting that one task compares; longer postings are dealt out in blocks, pair by pair.
BLOCK = 4096
#: Postings up to this length have their pairs tallied together, with array operations.
SHORT = 32

_hash = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: bytes) -> int:
    """Unsigned fingerprint of a UTF-8 text; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    shingles = zip(*(words[i:] for i in range(SHINGLE)), strict=False) if len(words) >= SHINGLE else [words]
    hashes = np.fromiter(map(_hash, map(b" ".join, shingles)), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 255):  # sums of 255 bits fit a byte
        some = hashes[at : at + 255].view(np.uint8).reshape(-1, BYTES)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(0, dtype=np.uint8)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batch: pa.RecordBatch) -> pa.RecordBatch:
    prints = np.array([fingerprint(x) for x in as_bytes(batch.column("text"))], np.uint64)
    return pa.RecordBatch.from_arrays(
        [*(batch.column(x) for x in ("id", "h", "g")), pa.array(prints.view(np.int64))], ["id", "h", "g", "fp"]
    )


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """Byte positions that agree, from the exclusive or of two fingerprints."""
    return (x.view(np.uint8).reshape(*x.shape, BYTES) == 0).sum(-1)


def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs share the guaranteed number of bytes and, of those, differ in few enough bits."""
    x = a ^ b
    found = shared_bytes(x) >= SHARED
    found[found] = np.bitwise_count(x[found]) <= DISTANCE
    return found


def spanning(prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect all that is linked within ``prints``: one fewer than members, not all pairs."""
    edges, unseen = [], prints
    while unseen.size > 1:
        frontier, unseen = [unseen[:1]], unseen[1:]
        while frontier and unseen.size:
            u = frontier.pop()
            near = linked(unseen, u)
            if near.any():
                hits, unseen = unseen[near], unseen[~near]
                edges.append((np.repeat(u, hits.size), hits))
                frontier.extend(hits[i : i + 1] for i in range(hits.size))
    return edges


def _links(keys: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within each run of equal ``keys``."""
    starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
    sizes = np.diff(np.r_[starts, len(keys)])
    for size in np.unique(sizes[(sizes > 1) & (sizes <= SHORT)]):
        runs = prints[starts[sizes == size][:, None] + np.arange(size)]
        i, j = np.triu_indices(size, 1)
        a, b = runs[:, i].ravel(), runs[:, j].ravel()
        near = linked(a, b)
        yield a[near], b[near]
    for at in np.flatnonzero(sizes > SHORT):
        yield from spanning(np.unique(prints[starts[at] : starts[at] + sizes[at]]))


def _postings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by (key, lo, hi) to links; a run that the batch's end cuts waits for the next batch."""
    keys, prints = np.empty((0, 3), np.int64), np.empty(0, np.uint64)

    def found(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a, b in _links(keys, prints) if len(keys) else ():
            if a.size:
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        own = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "lo", "hi")], 1)
        keys = np.concatenate([keys, own])
        prints = np.concatenate([prints, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
        if len(keys):
            last = len(keys) - np.argmin(np.r_[(keys[::-1] == keys[-1]).all(1), False])
            yield from found(keys[:last], prints[:last])
            keys, prints = keys[last:], prints[last:]
    yield from found(keys, prints)


def near_links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect all of the distinct ``prints`` (fp: long) within DISTANCE bits.

    A posting holds the fingerprints with a three-byte key in common. Postings of single bytes, of which there are
    only 2048, would bring a fixed share of all pairs together; the wider keys keep the guarantee, and the
    tally of shared positions is taken for each pair they bring together. A posting of more than ``block``
    fingerprints is cut into blocks, and each pair of blocks is a unit of its own.
    """
    ship(prints.sparkSession)
    byte = [F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255)) for i in range(BYTES)]
    keys = [F.lit(k << 24) + F.shiftleft(byte[i], 16) + F.shiftleft(byte[j], 8) + byte[m] for k, (i, j, m) in enumerate(KEYS)]
    index = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    hot = cut(index.groupBy("key").count().where(F.col("count") > block).select("key", F.ceil(F.col("count") / block).alias("blocks")))
    if hot.isEmpty():
        dealt = index.select("key", F.lit(0).cast("long").alias("lo"), F.lit(0).cast("long").alias("hi"), "fp")
    else:
        own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
        each = index.join(hot, "key", "left").na.fill(1, ["blocks"]).select(
            "key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
        )
        dealt = each.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    dealt = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return dealt.mapInArrow(_postings, "a long, b long")


def grouped(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(id, h, g, fp) of each row, h and g its hash, and (fp, root, component_id) of each fingerprint, both written."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), row_hash(docs).alias("of"))
    prints = cut(map_batches(rows.select("id", "text", "of.*"), _fingerprints, "id long, h long, g long, fp long"))
    first = cut(prints.groupBy("fp").agg(F.min("id").alias("first")))
    roots = components(near_links(first.select("fp"))).select(F.col("node").alias("fp"), "root")
    both = cut(first.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    smallest = cut(both.groupBy("root").agg(F.min("first").alias("component_id")))
    return prints, cut(both.join(smallest, "root").select("fp", "root", "component_id"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row by row: doc_id, fingerprint (16 hex digits) and component_id (smallest id that links reach).

    A null or empty text has fingerprint zero and links like any other; a text of any length is shingled whole. Rows
    without an id get a fingerprint and a component, whose id is null if no row of it has one. Repeated rows come back
    as often as they came in; equal fingerprints are compared once, so exact copies cost nothing. A shingle hash bit
    that is set in just half the shingles is 0. Further columns have no part, whatever their names. An empty table gives
    an empty result.
    """
    prints, named = grouped(docs, id_col, text_col)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(named, "fp").select(F.col("id").alias("doc_id"), hexed, "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest id, or one without an id where no row has one.

    Of rows that share this id, the one with the smallest hash of all its columns stays; of repeated rows, one. Null and
    empty texts are copies of each other. Texts of any length, ties, empty tables and further columns are as in
    ``simhash_components``; all columns are kept.
    """
    prints, named = grouped(docs, id_col, text_col)
    order = F.struct(F.col("id").isNull().alias("no"), "id", "h", "g").alias("row")
    stays = prints.join(named, "fp").groupBy("root").agg(F.min(order).alias("row"))
    return picked(docs, cut(stays.select("row.h", "row.g"))).select("row.*")
