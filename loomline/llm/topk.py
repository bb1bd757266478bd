"""Exact top-k search by inner product over a bit-sliced index."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomline.session import cut, ship

SCALE = 256
TOP = 5
EVERY = 50
#: Rows of an index block, and queries that meet a block in one task: a row is sent once for each QUERY_ROWS queries.
BLOCK_ROWS = 1 << 13
QUERY_ROWS = 1 << 13
#: Attributes whose slices are cut at a time.
ATTRIBUTES = 64


class BitSliced:
    """Bit slices of a block of integer rows: for each attribute, from the least significant bit upward, a bitmap over
    the rows. Attributes are stored less their minimum, so that all slices count up."""

    def __init__(self, values: np.ndarray):
        self.rows, width = values.shape
        self.low = values.min(0) if self.rows else np.zeros(width, np.int64)
        high = values.max(0) if self.rows else self.low
        self.bits = int(max((int(b) - int(a) for a, b in zip(self.low, high, strict=True)), default=0)).bit_length()
        self.words = -(-self.rows // 64)
        self.slices = np.zeros((width, self.bits, self.words), np.uint64)  # attribute, bit, words
        for at in range(0, width, ATTRIBUTES):
            some = np.zeros((min(ATTRIBUTES, width - at), self.words * 64), np.int64)
            some[:, : self.rows] = (values[:, at : at + ATTRIBUTES] - self.low[at : at + ATTRIBUTES]).T
            for b in range(self.bits):
                plane = ((some >> b) & 1).astype(np.uint8)
                self.slices[at : at + ATTRIBUTES, b] = np.packbits(plane, axis=-1, bitorder="little").view(np.uint64)
        self.all = np.packbits(np.arange(self.words * 64) < self.rows, bitorder="little").view(np.uint64)

    def sums(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of the weighted sum of all attributes, less a constant of the query, least significant first.

        A negative weight takes the complement of its attribute's slices. The slices of all attributes that weigh the
        same power of two are added with carry-save adders, three bitmaps to a sum and a carry.
        """
        weights = np.abs(query)
        flip = np.where(query < 0, ~np.uint64(0), np.uint64(0))
        columns: list[list[np.ndarray]] = []
        for a in range(int(weights.max(initial=0)).bit_length()):
            chosen = np.flatnonzero((weights >> a) & 1)
            for b in range(self.bits):
                while len(columns) <= a + b:
                    columns.append([])
                columns[a + b].append(self.slices[chosen, b] ^ flip[chosen, None])
        out, power = [], 0
        while power < len(columns):
            own = np.concatenate(columns[power]) if columns[power] else np.empty((0, self.words), np.uint64)
            while len(own) > 1:
                third = len(own) // 3
                if third:
                    x, y, z = own[:third], own[third : 2 * third], own[2 * third : 3 * third]
                    half = x ^ y
                    carry, own = (x & y) | (half & z), np.concatenate([half ^ z, own[3 * third :]])
                else:
                    carry, own = own[:1] & own[1:2], own[:1] ^ own[1:2]
                while len(columns) <= power + 1:
                    columns.append([])
                columns[power + 1].append(carry)
            out.append(own[0] if len(own) else np.zeros(self.words, np.uint64))
            power += 1
        return out

    def top(self, query: np.ndarray, k: int, without: int | None = None) -> np.ndarray:
        """Rows of the k largest sums (all, if fewer), and of those tied with the k-th the first ones.

        From the most significant slice downward: rows with the bit set are in if they are fewer than asked for,
        else only they stay in question. What is in question at the end is tied.
        """
        undecided, chosen = self.all.copy(), np.zeros(self.words, np.uint64)
        if without is not None:
            undecided[without // 64] &= ~(np.uint64(1) << np.uint64(without % 64))
        wanted = min(k, int(np.bitwise_count(undecided).sum()))
        for piece in reversed(self.sums(query)):
            ones = undecided & piece
            n = int(np.bitwise_count(ones).sum())
            if n > wanted:
                undecided = ones
            else:
                chosen |= ones
                undecided &= ~piece
                wanted -= n
            if not wanted:
                break
        first = rows_of(chosen)
        return np.concatenate([first, rows_of(undecided, wanted)]) if wanted else first


def rows_of(bitmap: np.ndarray, most: int | None = None) -> np.ndarray:
    """Numbers of the bits set, the first ``most`` of them."""
    words = np.flatnonzero(bitmap)
    if most is not None:
        words = words[:most]
    bits = np.unpackbits(bitmap[words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, bit = np.nonzero(bits)
    return (words[at] * 64 + bit)[:most]


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, q): floor(SCALE * x) of each component as double; rows with null or non-finite components are left out."""
    x = F.transform(F.col(vector_col), lambda v: F.floor(v.cast("double") * SCALE))
    bad = F.exists(F.col(vector_col), lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    sound = vectors.where(F.col(vector_col).isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.col(id_col).isNotNull())
    return sound.select(F.col(id_col).cast("long").alias("id"), x.alias("q"))


def _vectors(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length of the vectors: numbers of the rows of ``table``, and their vectors as a matrix."""
    q = table.column("q").combine_chunks()
    if isinstance(q, pa.ChunkedArray):
        q = q.chunk(0) if q.num_chunks else pa.array([], q.type)
    widths, flat, starts = q.value_lengths().to_numpy(zero_copy_only=False), q.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(q.value_lengths().to_numpy(zero_copy_only=False))]
    out = {}
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        at = starts[rows]
        whole = len(rows) == len(widths)
        out[width] = rows, flat.reshape(len(rows), width) if whole else flat[at[:, None] + np.arange(width)]
    return out


def _meet(index: pa.Table, asked: pa.Table, top: int) -> pa.Table:
    out: dict[str, list[np.ndarray]] = {"query": [], "number": [], "id": [], "score": []}
    index = index.sort_by([("id", "ascending"), ("row", "ascending")])
    ids, numbers = (index.column(x).to_numpy() for x in ("id", "row"))
    queries = _vectors(asked)
    for width, (rows, values) in _vectors(index).items():
        if width not in queries:
            continue
        block = BitSliced(values)
        place = {int(n): k for k, n in enumerate(numbers[rows].tolist())}
        of, vectors = queries[width]
        for query, number, q in zip(asked.column("query").to_numpy()[of], asked.column("number").to_numpy()[of], vectors, strict=True):
            best = block.top(q, top, place.get(int(number)))
            out["query"].append(np.full(len(best), query))
            out["number"].append(np.full(len(best), number))
            out["id"].append(ids[rows[best]])
            out["score"].append(values[best] @ q)
    return pa.table({k: pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64()) for k, x in out.items()})


def top_k(vectors: DataFrame, k: int = TOP, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row whose id is divisible by ``every``, the ``k`` other
    rows of the largest integer inner products, ties to the smaller id.

    Rows are dealt evenly to blocks, whatever their ids, queries to groups, and each group meets each block in a task of
    its own. A repeated row is a candidate for its copies, and a repeated query is answered as often as it comes.
    Rows without an id, without a vector, or with a null or non-finite component take no part; vectors of other
    lengths than the query's are no candidates, and those of any length are compared whole. Further columns have no part,
    whatever their names. A table of one row or none gives an empty result. Components so large that a score may not fit
    64 bits are an error.
    """
    ship(vectors.sparkSession)
    rows = cut(quantised(vectors, id_col, vector_col).withColumn("row", F.monotonically_increasing_id()))
    size = F.array_max(F.transform("q", lambda x: F.abs(x.cast("double"))))
    n, most, width = rows.agg(F.count("*"), F.max(size), F.max(F.size("q"))).first()
    if (most or 0) ** 2 * (width or 0) >= 2**62:
        raise ValueError(f"inner products of {width} components up to {most} may not fit 64 bits")
    blocks, groups = max(1, -(-n // block_rows)), max(1, -(-n // (every * query_rows)))
    queries = rows.where(F.col("id") % every == 0)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    index = rows.select("id", "row", "q", dealt(blocks).alias("block"), each(groups).alias("group"))
    asked = queries.select(F.col("id").alias("query"), F.col("row").alias("number"), "q", dealt(groups).alias("group"), each(blocks).alias("block"))
    met = index.groupBy("block", "group").cogroup(asked.groupBy("block", "group"))
    found = met.applyInArrow(lambda a, b: _meet(a, b, k), "query long, number long, id long, score long")
    best = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), "id"))
    ranked = found.withColumn("rank", best).where(F.col("rank") <= k)
    return ranked.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
