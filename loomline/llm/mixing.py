"""Mixing overlapping sources to target weights by min-cost flow."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomline.llm.common import as_bytes, map_batches, picked, row_hash
from loomline.session import cut

#: Most times that a document may be taken; the k-th time costs k, so that every source takes new words first.
REPEATS = 3
WEIGHTS = (1, 2, 3)
#: Leading hexadecimal digits of the seeded order that make a coarse and a fine bucket.
BUCKET_DIGITS = (2, 5)
#: The number of source sets that the flow takes at most.
MAX_SETS = 200_000

Source = str | None
Sources = tuple[Source, ...]


def in_order(sources: Sequence[Source]) -> list[Source]:
    """By code point, null last."""
    return sorted(sources, key=lambda x: (x is None, x or ""))


def targets_of(sizes: Mapping[Source, int], weights: Mapping[Source, float], repeats: int = REPEATS) -> dict[Source, float]:
    """Shares of all sizes by weight, none above ``repeats`` times its source's size; the excess goes to the others."""
    free, total, weight = in_order(list(sizes)), sum(sizes.values()), sum(weights[x] for x in sizes)
    out: dict[Source, float] = {}
    while True:
        full = [x for x in free if total * weights[x] / weight > repeats * sizes[x]]
        for x in full:
            out[x] = float(repeats * sizes[x])
        if not full:
            return out | {x: total * weights[x] / weight for x in free}
        free = [x for x in free if x not in out]
        total -= sum(repeats * sizes[x] for x in full)
        weight -= sum(weights[x] for x in full)


def flow(capacities: Mapping[Sources, int], quotas: Mapping[Source, int], repeats: int = REPEATS) -> dict[Sources, int]:
    """Words taken from each set of sources: all quotas as far as they can be met, at least cost.

    Arcs lead from the start to each set (one for each repetition, its cost the number of the repetition, its
    capacity the set's size), from a set to each of its sources, and from a source to the end (its quota).
    Successive shortest paths with potentials.
    """
    heads: list[int] = []
    room: list[int] = []
    cost: list[int] = []
    out: dict[int, list[int]] = defaultdict(list)

    def arc(a: int, b: int, most: int, price: int) -> None:
        for u, v, r, c in ((a, b, most, price), (b, a, 0, -price)):
            out[u].append(len(heads))
            heads.append(v), room.append(r), cost.append(c)

    sets, sources = list(capacities), in_order(list(quotas))
    node = {x: 2 + len(sets) + k for k, x in enumerate(sources)}
    start_arcs: dict[int, list[int]] = defaultdict(list)
    for k, members in enumerate(sets):
        for repeat in range(1, repeats + 1):
            start_arcs[k].append(len(heads))
            arc(0, 2 + k, capacities[members], repeat)
        for x in members:
            arc(2 + k, node[x], repeats * capacities[members], 0)
    for x in sources:
        arc(node[x], 1, quotas[x], 0)
    potential: dict[int, int] = defaultdict(int)
    while True:
        far, via, queue = {0: 0}, {}, [(0, 0)]
        while queue:
            d, u = heapq.heappop(queue)
            if d > far[u]:
                continue
            for e in out[u]:
                if room[e] and (now := d + cost[e] + potential[u] - potential[heads[e]]) < far.get(heads[e], 1 << 60):
                    far[heads[e]], via[heads[e]] = now, e
                    heapq.heappush(queue, (now, heads[e]))
        if 1 not in far:
            break
        for u in list(out):
            potential[u] += far.get(u, max(far.values()))
        _blocking(out, heads, room, cost, potential)
    return {members: sum(room[e ^ 1] for e in start_arcs[k]) for k, members in enumerate(sets)}


def _blocking(out: Mapping[int, list[int]], heads: list[int], room: list[int], cost: list[int], potential: Mapping[int, int]) -> None:
    """Sends what fits along arcs of reduced cost zero, path by path, without following a dead end twice."""
    following = {u: 0 for u in out}
    path: list[int] = []
    on_path = {0}
    u = 0
    while True:
        if u == 1:
            sent = min(room[e] for e in path)
            for e in path:
                room[e] -= sent
                room[e ^ 1] += sent
            path, on_path, u = [], {0}, 0
            continue
        while following[u] < len(out[u]):
            e = out[u][following[u]]
            v = heads[e]
            if room[e] and v not in on_path and cost[e] + potential[u] - potential[v] == 0:
                path.append(e)
                on_path.add(v)
                u = v
                break
            following[u] += 1
        else:
            if u == 0:
                return
            e = path.pop()
            on_path.discard(u)
            u = heads[e ^ 1]
            following[u] += 1


def word_counts(batch: pa.RecordBatch) -> pa.RecordBatch:
    sizes = [len(x.split()) for x in as_bytes(batch.column("text"))]
    kept = [x for x in batch.schema.names if x != "text"]
    return pa.RecordBatch.from_arrays([*(batch.column(x) for x in kept), pa.array(sizes, pa.int64())], [*kept, "size"])


def mixed(docs: DataFrame, sources_col: str = "source", weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, h and g (its hash), sources (array), size, source_size, target and taken.

    ``sources_col`` is a string or an array of strings; null is a source of its own, the last, and an empty array
    counts as null. A document of several sources counts in full for each of them. ``weights`` go round the sources in
    the order of code points; the targets share the words of all documents. What the flow routes out of a set of
    sources is taken from its documents: whole rounds from all of them, and a last round from the first ones in the
    order of md5(seed, id). Where that leaves a gap to the flow, one document more or less is taken if its size comes
    closer. source_size and target are those of the row's first source.

    A null or empty text has size zero and is never taken; a text of any length is counted whole and taken whole. Rows
    without an id order by their hash; repeated rows count as often as they come, with ties of the seeded order taken
    in the order of their sizes. Further columns have no part, whatever their names. An empty table gives an empty
    result. Only sizes by set of sources come to the driver, MAX_SETS rows at most.
    """
    kind = docs.schema[sources_col].dataType.typeName()
    members = F.col(sources_col) if kind == "array" else F.array(F.col(sources_col).cast("string"))
    members = F.when(F.coalesce(F.size(members), F.lit(0)) < 1, F.array(F.lit(None).cast("string"))).otherwise(
        F.array_sort(F.array_distinct(members))
    )
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), row_hash(docs).alias("of"), members.alias("sources"), F.col(text_col).alias("text")
    ).select("id", "of.*", "sources", "text")
    named = F.coalesce(F.col("id").cast("string"), F.concat_ws(":", "h", "g"))
    rows = rows.withColumn("drawn", F.md5(F.concat_ws(":", F.lit(str(seed)), named)))
    sized = map_batches(rows, word_counts, "id long, h long, g long, sources array<string>, drawn string, size long")
    sized = cut(sized.withColumn("row", F.monotonically_increasing_id()))

    sets = sized.groupBy("sources").agg(F.sum("size").alias("size")).limit(MAX_SETS + 1).collect()
    if len(sets) > MAX_SETS:
        raise ValueError(f"more than {MAX_SETS} sets of sources")
    capacities: dict[Sources, int] = {tuple(x["sources"]): x["size"] for x in sets}
    sizes: dict[Source, int] = defaultdict(int)
    for of, size in capacities.items():
        for x in of:
            sizes[x] += size
    order = {x: weights[k % len(weights)] for k, x in enumerate(in_order(list(sizes)))}
    targets = targets_of(sizes, order, repeats) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
    taken = flow(capacities, {x: round(t) for x, t in targets.items()}, repeats)

    spark = docs.sparkSession
    shares = [
        (list(of), sizes[of[0]], float(targets[of[0]]), taken[of] // size if size else 0, taken[of] % size if size else 0) for of, size in capacities.items()
    ]
    plan = spark.createDataFrame(shares, "sources array<string>, source_size long, target double, rounds long, rest long")
    shared = sized.join(F.broadcast(plan), sized["sources"].eqNullSafe(plan["sources"])).drop(plan["sources"])

    # The last round: prefix sums over the buckets of the seeded order, first the coarse ones, then the fine ones
    # within the coarse one at the edge, then row by row within the fine one at the edge.
    edged = shared.withColumns({"edge": F.lit(""), "before": F.lit(0).cast("long")})
    for digits in BUCKET_DIGITS:
        bucket = F.substring("drawn", 1, digits)
        at_edge = edged.where((F.col("rest") > 0) & (F.col("size") > 0) & F.col("drawn").startswith(F.col("edge")))
        buckets = at_edge.groupBy("sources", bucket.alias("bucket"), "rest", "before").agg(F.sum("size").alias("words"))
        upto = Window.partitionBy("sources").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = buckets.withColumn("before", F.col("before") + F.coalesce(F.sum("words").over(upto), F.lit(0)))
        found = cut(
            sums.where("before < rest and before + words >= rest").select(
                F.col("sources").alias("of"), F.col("bucket").alias("edge"), "before"
            )
        )
        # one row for each set
        edged = shared.join(F.broadcast(found), shared["sources"].eqNullSafe(F.col("of")), "left").drop("of")
    inside = edged.where((bucket == F.col("edge")) & (F.col("size") > 0))
    running = Window.partitionBy("sources").orderBy("drawn", "size", "id").rowsBetween(Window.unboundedPreceding, -1)
    sums = inside.withColumn("sum", F.col("before") + F.coalesce(F.sum("size").over(running), F.lit(0)))
    near = F.col("rest") - F.col("sum") > F.col("sum") + F.col("size") - F.col("rest")  # the document's middle lies before the rest
    inside = sums.withColumn("last", F.when(near, F.col("size")).otherwise(0))
    outside = edged.where(~F.coalesce((bucket == F.col("edge")) & (F.col("size") > 0), F.lit(False)))
    outside = outside.withColumn("last", F.when((F.col("rest") > 0) & (bucket < F.col("edge")), F.col("size")).otherwise(0))
    first = cut(inside.select(*shared.columns, "last").unionByName(outside.select(*shared.columns, "last")))

    # One document more, or one less, of each set where that brings its words closer to the flow's.
    gaps = first.groupBy("sources", "rest").agg(F.sum("last").alias("last")).select(F.col("sources").alias("of"), (F.col("rest") - F.col("last")).alias("gap")).where(
        "gap <> 0"
    )
    gapped = first.join(F.broadcast(cut(gaps)), first["sources"].eqNullSafe(F.col("of")))  # one row for each set
    miss = F.abs(F.abs("gap") - F.col("size"))
    other = gapped.where((F.col("size") > 0) & (miss < F.abs("gap")) & ((F.col("gap") > 0) == (F.col("last") == 0)) & (F.col("rest") > 0))
    turned = cut(
        other.groupBy("sources").agg(F.min(F.struct(miss.alias("miss"), "drawn", "row")).alias("best")).select(
            "best.row", F.lit(True).alias("turn")
        )
    )
    turn = F.when(F.col("turn"), F.col("size") - F.col("last")).otherwise(F.col("last"))
    done = first.join(F.broadcast(turned), "row", "left")
    return done.select(
        F.col("id").alias("doc_id"),
        "h",
        "g",
        "sources",
        "size",
        "source_size",
        "target",
        (F.col("rounds") * F.col("size") + turn).alias("taken"),
    )


def mix_sources(docs: DataFrame, *args, **kwargs) -> DataFrame:
    """``mixed`` with doc_id, sources, size, source_size, target and taken alone."""
    return mixed(docs, *args, **kwargs).drop("h", "g")


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns.

    Rows that differ in any column are rows of their own, also where id and text are the same; repeated rows come as
    often as the mix takes all of them together. Null ids, null, empty and very long texts, ties and empty tables are as
    in ``mixed``; columns of ``docs`` may have any names.
    """
    taken = mixed(docs, id_col=id_col, text_col=text_col, **how).where("taken > 0").groupBy("h", "g")
    times = cut(taken.agg(F.sum(F.expr("taken div size")).cast("int").alias("times")))
    return picked(docs, times).select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
