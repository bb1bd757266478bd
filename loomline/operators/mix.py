"""Assembling a training mix: gates, dedupe, messages, split and report."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import ROUND_FLOOR, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomline.functions.redaction import redact
from loomline.functions.text import normalize_question
from loomline.operators.traces import chat_messages

# Roles of the other conversation format.
ROLES = {"human": "user", "gpt": "assistant", "system": "system"}


@dataclass(frozen=True)
class MixConfig:
    valid_frac: float = 0.1
    seed: int = 42
    dedupe: bool = True
    min_coverage: float = 0.0
    require_chain_valid: bool = True
    require_entities: bool = False


def passes_cutoffs(config: MixConfig = MixConfig()) -> Column:
    """The mix's gate: a row without a verification is not valid; one without a coverage is covered."""
    valid = F.coalesce(F.col("verification.chain_valid"), F.lit(False)) if config.require_chain_valid else F.lit(True)
    covered = F.col("coverage").isNull() | (F.col("coverage") >= config.min_coverage)
    named = F.coalesce(F.size("entity_refs"), F.lit(0)) > 0 if config.require_entities else F.lit(True)
    return valid & covered & named


def first_by_text(rows: DataFrame, text_col: str, order: list[str]) -> DataFrame:
    """The first row, by ``order``, of each normalised text.

    The smallest order is found by aggregation, before rows meet: a text that very many rows share is no burden.
    """
    keyed = rows.withColumn("_key", F.md5(normalize_question(F.coalesce(F.col(text_col), F.lit("")))))
    first = keyed.groupBy("_key").agg(F.min(F.struct(*order)).alias("_first"))
    same = [keyed[c].eqNullSafe(F.col(f"_first.{c}")) for c in order]
    joined = keyed.join(first.withColumnRenamed("_key", "_key2"), (keyed["_key"] == F.col("_key2")) & same[0])
    for c in same[1:]:
        joined = joined.where(c)
    return joined.select(rows.columns)


def ranked(rows: DataFrame, key: str, seed: int) -> DataFrame:
    """``rows`` with ``_rank`` from 1 in the order of md5(key, seed).

    Ranks come from counts of the hash's first two bytes plus the rank within them, so no task sorts all rows.
    """
    hashed = rows.withColumn("_hash", F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))).withColumn(
        "_bucket", F.substring("_hash", 1, 4)
    )
    counts = hashed.groupBy("_bucket").agg(F.count("*").alias("_n"))  # 65536 rows at most
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop(
        "_n"
    )
    inner = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", key))
    return hashed.withColumn("_inner", inner).join(F.broadcast(before), "_bucket").withColumn("_rank", F.col("_before") + F.col("_inner")).drop(
        "_hash", "_bucket", "_before", "_inner"
    )


def valid_count(n: Column, frac: float) -> Column:
    """How many rows validate: the share rounded down, but one at least; none of none."""
    return F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(n * F.lit(frac))))


def valid_frac_of(train_split: float) -> float:
    """The rest of a training share, in decimals: 0.1 for 0.9."""
    return float(Decimal(1) - Decimal(str(train_split)))


def exact_valid_count(n: int, train_split: float) -> int:
    """Validation rows by a training share, without the rounding of binary fractions."""
    share = (Decimal(n) * (Decimal(1) - Decimal(str(train_split)))).to_integral_value(ROUND_FLOOR)
    return 0 if n == 0 else max(1, int(share))


def split(rows: DataFrame, key: str, config: MixConfig = MixConfig()) -> DataFrame:
    """``rows`` with ``split``: the first of the seeded order validate, the others train."""
    size = rows.agg(F.count("*").alias("_all"))
    return ranked(rows, key, config.seed).join(F.broadcast(size)).withColumn("split", F.when(F.col("_rank") <= valid_count(F.col("_all"), config.valid_frac), "valid").otherwise("train")).drop(
        "_rank", "_all"
    )


def to_training_rows(rows: DataFrame) -> DataFrame:
    """(key, messages, source, provenance: JSON) of question-answer rows; ``key`` tells rows apart."""
    kept = [c for c in ("question", "entity_refs", "required_tools", "chain", "verification", "coverage") if c in rows.columns]
    origin = F.col("provenance.source").alias("origin")
    rest = [
        F.col(f"provenance.{f.name}").alias(f.name) for f in rows.schema["provenance"].dataType.fields if f.name not in {"source", *kept}
    ]
    detail = F.to_json(F.struct(F.lit("generated").alias("source"), origin, *kept, *rest), {"ignoreNullFields": "false"})
    messages = chat_messages(F.col("question"), F.col("answer_draft"), F.col("required_tools"), F.col("chain"))
    return rows.select("key", messages.alias("messages"), F.lit("generated").alias("source"), detail.alias("provenance"))


def external_rows(rows: DataFrame) -> DataFrame:
    """Training rows of other makers: ``messages`` as they are, or ``conversations`` with the roles renamed.

    A row with neither is an error. Further columns go into the provenance.
    """
    names = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    turned = F.lit(None)
    if "conversations" in rows.columns:
        turned = F.transform(
            "conversations",
            lambda t: F.struct(F.coalesce(F.try_element_at(names, t["from"]), t["from"]).alias("role"), t["value"].alias("content")),
        )
    own = F.col("messages") if "messages" in rows.columns else F.lit(None)
    extra = [c for c in rows.columns if c not in ("messages", "conversations", "key")]
    detail = F.to_json(F.struct(F.lit("external").alias("source"), *extra), {"ignoreNullFields": "false"})
    shape = "array<struct<role:string,content:string>>"
    messages = F.coalesce(
        own.cast(shape), turned.cast(shape), F.raise_error(F.lit("a row with neither messages nor conversations")).cast(shape)
    )
    return rows.select("key", messages.alias("messages"), F.lit("external").alias("source"), detail.alias("provenance"))


def assemble(pairs: DataFrame, external: DataFrame | None = None, config: MixConfig = MixConfig()) -> tuple[DataFrame, dict]:
    """The mix (key, messages, source, provenance, split) and its report.

    ``pairs`` has ``key`` and ``ord``. Gates and dedupe apply to them alone; rows of other makers count as curated.
    """
    passed = pairs.where(passes_cutoffs(config))
    unique = first_by_text(passed, "question", ["ord"]) if config.dedupe else passed
    rows = to_training_rows(unique)
    if external is not None:
        rows = rows.unionByName(external_rows(external))
    mixed = split(rows, "key", config)
    counts = pairs.agg(F.count("*").alias("n_in"), F.count_if(passes_cutoffs(config)).alias("n_after_cutoffs")).first()
    by = {(x["source"], x["split"]): x["count"] for x in mixed.groupBy("source", "split").count().collect()}
    sources: dict[str, int] = {}
    for (source, _), n in by.items():
        sources[source] = sources.get(source, 0) + n
    report = {
        **counts.asDict(), "n_external_in": sources.get("external", 0), "n_dupes_removed": counts["n_after_cutoffs"] - sources.get(
            "generated", 0
        ),
        "n_records_total": sum(by.values()), "n_train": sum(n for (_, x), n in by.items() if x == "train"), "n_valid": sum(n for (_, x), n in by.items() if x == "valid"), "sources": sources,
    }
    return mixed, report


def redacted_rows(rows: DataFrame) -> DataFrame:
    """Question-answer rows with question, answer and result previews redacted; tool inputs stay."""
    chain = F.transform("chain", lambda s: s.withField("result_preview", redact(s["result_preview"])))
    return rows.withColumns({"question": redact(F.col("question")), "answer_draft": redact(F.col("answer_draft")), "chain": chain})
