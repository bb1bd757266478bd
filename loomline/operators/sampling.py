"""Sampling tools: score-weighted walks over the composability graph, and uniform draws."""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.session import ship

RESTART = 0.15
#: What the seeds of a sampler's calls are spread by.
SPREAD = 1_000_003
#: Tools and edges that a walk's graph may have; it goes to each task.
MAX_EDGES = 1_000_000


def walk(successors: dict[str, dict[str, float]], nodes: Sequence[str], n: int, rng: random.Random, start: str | None = None, restart: float = RESTART) -> list[
    str
]:
    """``n`` different tools: from one to an unvisited successor by score, or, by chance or at a dead end, to any.

    Errors for no tools asked for, more than there are, an empty graph and an unknown start.
    """
    if n <= 0:
        raise ValueError(f"the number of tools must be positive, got {n}")
    if not nodes:
        raise ValueError("the graph is empty")
    if n > len(nodes):
        raise ValueError(f"{n} tools exceed the graph's {len(nodes)}")
    if start is not None and start not in set(nodes):
        raise KeyError(f"unknown tool {start!r}")
    now = start if start is not None else rng.choice(list(nodes))
    left = dict.fromkeys(nodes)
    del left[now]
    found = [now]
    while len(found) < n:
        near = sorted(x for x in successors.get(now, ()) if x in left)
        if near and rng.random() >= restart:
            now = rng.choices(near, [successors[now][x] or 0.5 for x in near])[0]
        else:
            now = rng.choice(list(left))
        del left[now]
        found.append(now)
    return found


def sample_walks(walks: DataFrame, nodes: DataFrame, edges: DataFrame, n: int, restart: float = RESTART) -> DataFrame:
    """(walk_id, pos, tool) of one walk for each row of ``walks`` (walk_id, seed, start: null for any).

    A walk is sequential, walks are independent: the graph, of at most MAX_EDGES edges, goes to the tasks.
    """
    ship(walks.sparkSession)
    listed = edges.select("src", "dst", F.coalesce("score", F.lit(0.5)).alias("score")).limit(MAX_EDGES + 1).collect()
    if len(listed) > MAX_EDGES:
        raise ValueError(f"a graph of over {MAX_EDGES} edges can't be walked")
    names = [x["tool"] for x in nodes.select("tool").distinct().orderBy("tool").collect()]
    successors: dict[str, dict[str, float]] = {}
    for x in listed:
        successors.setdefault(x["src"], {})[x["dst"]] = x["score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                (r["walk_id"], k, t) for r in batch.to_pylist() for k, t in enumerate(
                    walk(successors, names, n, random.Random(r["seed"]), r["start"], restart)
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out])],
                ["walk_id", "pos", "tool"],
            )

    return walks.select(F.col("walk_id").cast("long"), F.col("seed").cast("long"), F.col("start").cast("string")).mapInArrow(
        run, "walk_id long, pos int, tool string"
    )


def call_seeds(calls: DataFrame, seed: int) -> DataFrame:
    """``calls`` (call_no) as walks: each call of a sampler has a seed of its own."""
    return calls.select(
        F.col("call_no").alias("walk_id"),
        (F.lit(seed) * SPREAD + F.col("call_no")).alias("seed"),
        F.lit(None).cast("string").alias("start"),
    )


def uniform_sample(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows, each as likely as the next, the same ones for a seed."""
    size = rows.count()
    if not 0 < n <= size:
        raise ValueError(f"the number of rows should be between 1 and {size}, got {n}")
    return rows.orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), key).limit(n)
