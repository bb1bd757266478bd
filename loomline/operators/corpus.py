"""Text corpora: packing paragraphs into chunks, and graphs that a text model extracts from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.operators.graph import cap_entities, merge_entities, merge_relations
from loomline.operators.traces import with_model
from loomline.session import cut

CHUNK_CHARS = 4000
MAX_CHUNKS = 60
EXTRACTED = "struct<entities:array<struct<name:string,type:string,description:string>>,relations:array<struct<head:string,relation:string,tail:string,description:string>>>"
PROMPT = (
    "List the entities and relationships of the text below as one JSON object and nothing else:\n"
    '{"entities": [{"name": "...", "type": "...", "description": "..."}], "relations": [{"head": "...", "relation": "...", "tail": "...", "description": "..."}]}\n'
    "Use short canonical names, 15 entities and 20 relations at most.\n\n"
)


def chunks_of(text: Column, most: int = CHUNK_CHARS) -> Column:
    """Paragraphs (parted by blank lines) packed in their order: a chunk ends before the paragraph that would take its
    letters over ``most``. A longer paragraph is a chunk of its own; blank chunks go."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("now"), F.lit(0).alias("size"))

    def fold(state: Column, part: Column) -> Column:
        full = (state["size"] + F.length(part) > most) & state["now"].isNotNull()
        done = F.when(full, F.array_append(state["done"], state["now"])).otherwise(state["done"])
        now = F.when(full | state["now"].isNull(), part).otherwise(F.concat(state["now"], F.lit("\n\n"), part))
        size = F.when(full, F.length(part)).otherwise(state["size"] + F.length(part))
        return F.struct(done.alias("done"), now.alias("now"), size.alias("size"))

    packed = F.aggregate(F.split(F.coalesce(text, F.lit("")), "\n\n"), start, fold, lambda s: F.array_append(s["done"], s["now"]))
    return F.filter(packed, lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")) != "")


def corpus_chunks(files: DataFrame, most: int = CHUNK_CHARS) -> DataFrame:
    """(path, pos, chunk) of files (path, text)."""
    return files.select("path", F.posexplode(chunks_of(F.col("text"), most)).alias("pos", "chunk"))


def parse_extraction(reply: Column) -> Column:
    """The object between a reply's first { and last }; an error where there is none."""
    found = F.regexp_extract(F.coalesce(reply, F.lit("")), r"(?s)\{.*\}", 0)
    sound = F.when(F.try_parse_json(found).isNotNull() & found.startswith("{"), found)
    return F.from_json(
        F.coalesce(sound, F.raise_error(F.concat(F.lit("no JSON object in the reply: "), F.substring(reply, 1, 200))).cast("string")),
        EXTRACTED,
    )


def corpus_graph(files: DataFrame, model: Callable[[str], str] | None, max_entities: int = 200, max_chunks: int = MAX_CHUNKS) -> tuple[
    DataFrame, DataFrame
]:
    """(nodes, edges) that ``model`` finds in the first ``max_chunks`` chunks, in the order of paths and places.

    The limit on calls of the model is taken before it is called. Errors without a model and without chunks.
    """
    if model is None:
        raise ValueError("a corpus graph needs a text model")
    chunks = cut(corpus_chunks(files).orderBy("path", "pos").limit(max_chunks).withColumn("ord", F.monotonically_increasing_id()))
    if chunks.isEmpty():
        raise ValueError("no text in the corpus")
    replies = with_model(chunks.withColumn("prompt", F.concat(F.lit(PROMPT), "chunk")), "prompt", "reply", model)
    found = cut(replies.select("ord", parse_extraction(F.col("reply")).alias("x")))
    place = (F.col("ord") * 1000 + F.col("pos")).alias("ord")
    entities = found.select("ord", F.posexplode("x.entities").alias("pos", "e")).where("trim(e.name) <> ''").select(
        place, "e.name", F.coalesce("e.type", F.lit("concept")).alias("type"), "e.description"
    )
    relations = found.select("ord", F.posexplode("x.relations").alias("pos", "r")).where("r.head <> '' and r.relation <> '' and r.tail <> ''").select(
        place, "r.head", "r.relation", "r.tail", "r.description"
    )
    ends = relations.select(
        (F.col("ord") + 1_000_000_000).alias("ord"),
        F.explode(F.array("head", "tail")).alias("name"),
        F.lit("concept").alias("type"),
        F.lit("").alias("description"),
    )
    new = ends.join(entities.select(F.trim("name").alias("name")), "name", "left_anti").select("ord", "name", "type", "description")
    return cap_entities(merge_entities(entities.unionByName(new)), merge_relations(relations), max_entities)
