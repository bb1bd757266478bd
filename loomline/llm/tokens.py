"""Token counts of flat token files by a separator scan."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomline.llm.common import as_texts, slices
from loomline.llm.files import attempt_name, create, open_at
from loomline.llm.quality import vocabulary_model
from loomline.session import cut, ship

#: The separator after each document: the vocabulary's own end of text, which no text encodes to.
END = 2
WIDTH = 2
BLOCK_BYTES = 4 << 20
FILE_BYTES = 1 << 30
#: Blocks whose counts one task of the prefix scan sums up, before their sums are scanned in turn.
SPAN = 1024


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Flat files of little-endian unsigned ids, ``end`` after each document; returns (path, first, doc_ids).

    ``vocabulary`` is the path of a public sentencepiece model of at most 65,536 ids.
    The files hold ids and nothing else: no header, no index. The rows returned list documents of a file in their
    order, from ordinal ``first`` on, for whoever wants to name the counts. A null or empty text is the separator
    alone; null ids and repeated rows are written like any other.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary_model(vocabulary)[0]
        out, path, n, size, ids = None, "", 0, 0, []

        def noted() -> pa.RecordBatch:
            arrays = [pa.array([path]), pa.array([n - len(ids)], pa.int64()), pa.array([ids], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(arrays, ["path", "first", "doc_ids"])

        for batch in slices(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), as_texts(batch.column("text")), strict=True):
                if out is None:
                    path = attempt_name(folder, ".tokens")
                    out, n, size = create(path), 0, 0
                data = np.array([*model.encode(text, num_threads=1), end], f"<u{WIDTH}").tobytes()
                out.write(data)
                ids.append(doc)
                n, size = n + 1, size + len(data)
                if size >= FILE_BYTES:
                    out = out.close()
                    yield noted()
                    ids = []
            if ids:
                yield noted()
                ids = []
        if out is not None:
            out.close()

    return cut(rows.mapInArrow(write, "path string, first long, doc_ids array<long>"))


def named(counts: DataFrame, files: DataFrame) -> DataFrame:
    """(doc_id, n_tokens) from the counts of files and the rows that ``write_tokens`` returned for them."""
    listed = files.select("path", "first", F.posexplode("doc_ids").alias("k", "doc_id")).select(
        "path", (F.col("first") + F.col("k")).alias("ordinal"), "doc_id"
    )
    return listed.join(counts, ["path", "ordinal"]).select("doc_id", "n_tokens")


def scanned(block: np.ndarray, end: int) -> tuple[int, int, int, np.ndarray]:
    """Separators, ids before the first and after the last one (all, if none), and the lengths in between."""
    at = np.flatnonzero(block == end)
    if not at.size:
        return 0, len(block), len(block), at
    return at.size, int(at[0]), len(block) - 1 - int(at[-1]), np.diff(at) - 1


def _sizes(batch: pa.RecordBatch) -> pa.RecordBatch:
    paths = batch.column("path").to_pylist()
    sizes = []
    for path in paths:
        with open_at(path) as file:
            sizes.append(file.size())
    return pa.RecordBatch.from_arrays([batch.column("path"), pa.array(sizes, pa.int64())], ["path", "bytes"])


def count_tokens(files: DataFrame, end: int = END, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(path, ordinal, n_tokens) of each document in the flat token files of column ``path``.

    Each block is scanned on its own: whole documents in it are counted there and then. A document that crosses
    blocks is as long as what the blocks before its end left open, by a prefix scan over the blocks' counts: first
    within spans of SPAN blocks, then over the spans. Ids after the last separator of a file are a document that
    has not ended; it is counted as well, with ``ended`` false. Bytes beyond the last whole id are no id. An empty
    file has no documents, and two separators in a row enclose one without tokens.
    """
    ship(files.sparkSession)
    step = block_bytes // width * width
    paths = files.select("path").distinct()
    sized = cut(paths.mapInArrow(lambda batches: (_sizes(x) for x in batches if x.num_rows), "path string, bytes long"))
    starts = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(step).cast("long"))
    blocks = sized.where(F.col("bytes") >= width).select("path", F.explode(starts).alias("start")).repartition("path", "start")

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with open_at(path) as file:
                    file.seek(start)
                    data = file.read(step)
                n, head, tail, inner = scanned(np.frombuffer(data[: len(data) // width * width], f"<u{width}"), end)
                values = [path, start // step, n, head, tail, inner.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["path", "block", "ends", "head", "tail", "inner"]
                )

    counts = cut(blocks.mapInArrow(scan, "path string, block long, ends long, head long, tail long, inner array<long>"))

    # (ends, open) of a stretch of blocks: its separators and the ids after the last of them. Two stretches join to
    # (sum of ends, open of the second, and of the first too where the second has no separator).
    small = counts.select("path", "block", F.floor(F.col("block") / SPAN).alias("span"), "ends", "tail")
    inside = Window.partitionBy("path", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def joined(df: DataFrame, w: Window) -> DataFrame:
        """Prefixes by row: ends so far, and ids open after it."""
        last = F.last(F.when(F.col("ends") > 0, F.struct(F.col("all").alias("all"), "tail")), True).over(w)
        summed = df.withColumn("all", F.sum(F.when(F.col("ends") > 0, 0).otherwise(F.col("tail"))).over(w))
        both = summed.withColumn("last", last).withColumn("so_far", F.sum("ends").over(w))
        return both.withColumn("open", F.coalesce(F.col("last.tail"), F.lit(0)) + F.col("all") - F.coalesce(F.col("last.all"), F.lit(0)))

    spans = joined(small, inside)
    ends = spans.groupBy("path", "span").agg(
        F.max_by(F.struct(F.col("so_far").alias("ends"), F.col("open").alias("tail")), "block").alias("of")
    )
    across = Window.partitionBy("path").orderBy("span")
    upto = joined(ends.select("path", "span", "of.ends", "of.tail"), across.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = upto.select("path", "span", *(F.coalesce(F.lag(x).over(across), F.lit(0)).alias(f"span_{x}") for x in ("so_far", "open")))
    before = Window.partitionBy("path", "span").orderBy("block")
    lagged = spans.select("path", "span", "block", *(F.coalesce(F.lag(x).over(before), F.lit(0)).alias(x) for x in ("so_far", "open")))
    offsets = lagged.join(carried, ["path", "span"]).select(
        "path", "block", (F.col("span_so_far") + F.col("so_far")).alias("before"), F.when(F.col("so_far") > 0, F.col("open")).otherwise(F.col("span_open") + F.col("open")).alias(
            "carry"
        )
    )
    placed = cut(counts.join(cut(offsets), ["path", "block"]))
    crossing = placed.where("ends > 0").select(
        "path", F.col("before").alias("ordinal"), (F.col("carry") + F.col("head")).alias("n_tokens"), F.lit(True).alias("ended")
    )
    within = placed.where("ends > 1").select("path", "before", F.posexplode("inner").alias("k", "n_tokens")).select(
        "path", (F.col("before") + 1 + F.col("k")).alias("ordinal"), "n_tokens", F.lit(True).alias("ended")
    )
    final = placed.groupBy("path").agg(
        F.max_by(F.struct((F.col("before") + F.col("ends")).alias("ordinal"), F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("carry") + F.col("tail")).alias("n_tokens")), "block").alias(
            "of"
        )
    )
    open_ = final.where("of.n_tokens > 0").select("path", "of.ordinal", "of.n_tokens", F.lit(False).alias("ended"))
    return crossing.unionByName(within).unionByName(open_)
