"""What several operators share: words, Arrow columns, connected components and files in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.session import cut, discard, ship

#: Words of all contracts: runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
#: bytes.split() without arguments splits at exactly these six.
SPACES = b" \t\n\r\x0b\x0c"
WORD = r"[^\x20\x09-\x0D]+"


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    """Strings of a column; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


#: Rows of an Arrow batch that become Python objects at a time.
ROWS = 1024


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, without copying them."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` on slices of each Arrow batch (at most 64 MB by Spark's default) of ``df``."""
    ship(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(work, slices(batches))

    return df.mapInArrow(run, schema)


def unused(names: Iterable[str], name: str) -> str:
    """``name`` after so many underscores that no column of ``names`` is called so."""
    taken = {x.lower() for x in names}
    name = "_" + name
    while name in taken:
        name = "_" + name
    return name


def row_hash(df: DataFrame) -> Column:
    """128 bits of a row's columns, as a struct of two numbers: equal for repeated rows, and for no others."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        # maps and variants have no hash, and those of arrays and structs leave out nulls
        columns.append(F.to_json(F.struct(column)) if field.dataType.typeName() in ("array", "struct", "map", "variant") else column)
    nulls = F.concat(*(x.isNull().cast("int").cast("string") for x in columns))
    return F.struct(F.xxhash64(*columns, nulls).alias("h"), F.xxhash64(F.lit("again"), nulls, *columns).alias("g"))


def picked(docs: DataFrame, keep: DataFrame) -> DataFrame:
    """(row, and the further columns of ``keep``) of the rows of ``docs``, as structs, whose hash is in ``keep``.

    ``keep`` has each hash once, as (h, g). Repeated rows come once.
    """
    hashed = docs.select(F.struct(*(F.col(f"`{x}`") for x in docs.columns)).alias("row"), row_hash(docs).alias("of")).select("row", "of.*")
    found = hashed.join(keep, ["h", "g"])
    again = docs.select(row_hash(docs).alias("of")).groupBy("of").count().where("count > 1")
    if not again.isEmpty():
        found = found.dropDuplicates(["h", "g"])
    return found.drop("h", "g")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b: long); root is the smallest node that can be reached.

    Alternating large-star and small-star rounds. Minima are pre-aggregated before each shuffle, and every join
    has two plain exchanges below it, so that Spark can split a node with very many links.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while (state := tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())) != seen:
        seen = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = cut(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        discard(now, least)
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        discard(large, least)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
