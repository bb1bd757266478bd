"""Queries over documents, pages and conversations: dedupe, gates, mix, redaction, leaks and release."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions import redaction
from loomline.functions.text import canon, clipped, estimate_tokens, normalize_question, truncate
from loomline.operators import corpus, credentials, metrics, mix, release, search, traces
from loomline.session import cut, table

SEED = 42
#: Runs of words of the benchmark (8 bytes each) that are sent to all tasks; more are joined by a shuffle.
HELD_GRAMS = 1 << 21


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def first_wins_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.first_by_text(_docs(spark, sf_dir).select("doc_id", "text", "source"), "text", ["doc_id"]).select("doc_id", "source")


def dedupe_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.md5(normalize_question(F.coalesce("text", F.lit(""))))
    counts = _docs(spark, sf_dir).groupBy(key.alias("key")).agg(F.count("*").alias("n"))
    return counts.agg(
        F.sum("n").alias("n_in"), F.count("*").alias("n_unique"), (F.sum("n") - F.count("*")).alias("n_dupes"), F.max("n").alias("largest")
    )


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a verification (valid: quality 1; policy: not toxic) where they are labelled."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    docs = _docs(spark, sf_dir).join(labels, "doc_id", "left")
    known = F.when(F.col("quality").isNotNull(), F.struct((F.col("quality") == 1).alias("chain_valid")))
    return docs.withColumn("verification", known).withColumn("coverage", F.when(F.col("toxic") == 1, 0.25).when(F.col("toxic") == 0, 1.0)).withColumn(
        "entity_refs", F.array("source")
    )


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = mix.MixConfig(min_coverage=0.5)
    return _judged(spark, sf_dir).select("doc_id", mix.passes_cutoffs(config).alias("passes"))


def mix_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.split(_docs(spark, sf_dir).select("doc_id", "source"), "doc_id").select("doc_id", "split")


def mix_sources_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources after gates, dedupe and split."""
    passed = _judged(spark, sf_dir).where(mix.passes_cutoffs(mix.MixConfig(min_coverage=0.5)))
    unique = mix.first_by_text(passed.select("doc_id", "text", "source"), "text", ["doc_id"])
    return mix.split(unique.select("doc_id", "source"), "doc_id").groupBy("source", "split").agg(F.count("*").alias("n"))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, turn, question, answer): user turns with the assistant turn right after."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    told = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return asked.join(told, ["conv_id", "turn"]).distinct()


def sft_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = F.array().cast(f"array<{traces.STEP}>")
    messages = traces.chat_messages(F.col("question"), F.col("answer"), F.array(F.lit("search"), F.lit("read")), chain)
    rows = _turns(spark, sf_dir).select("conv_id", "turn", F.posexplode(messages).alias("pos", "m"))
    return rows.select("conv_id", "turn", "pos", "m.role", "m.content")


def external_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in the other format, with its roles, and as messages again."""
    role = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise(F.col("role"))
    item = F.struct("turn", role.alias("from"), F.col("text").alias("value"))
    listed = F.transform(F.array_sort(F.collect_list(item)), lambda x: F.struct(x["from"].alias("from"), x["value"].alias("value")))
    given = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("key")).agg(listed.alias("conversations"))
    rows = mix.external_rows(given).select(F.col("key").alias("conv_id"), "source", F.posexplode("messages").alias("pos", "m"))
    return rows.select("conv_id", "source", "pos", "m.role", "m.content")


def eval_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation rows of the question-answer turns, their scalar columns."""
    outcomes = F.array(
        F.struct(
            F.lit("answered").alias("description"),
            F.substring("answer", 1, 60).alias("assertion"),
            F.lit(None).cast("string").alias("state_after"),
        )
    )
    rows = _turns(spark, sf_dir).select(
        "question", F.col("answer").alias("answer_draft"), F.array().cast(f"array<{traces.STEP}>").alias("chain"), F.array(F.lit("e")).alias("entity_refs"), outcomes.alias(
            "expected_outcomes"
        ),
        F.struct(F.concat_ws("-", "conv_id", "turn").alias("chain_id")).alias("provenance"),
    )
    rows = release.evaluation_rows(release.scenario_packages(rows))
    return rows.select(
        "scenario_id",
        "category",
        "prompt",
        "expected_answer",
        F.get("expected_outcomes", F.lit(0)).alias("outcome"),
        "ground_truth.intent_type",
        "ground_truth.verified",
        F.size("expected_tool_calls").alias("n_calls"),
    )


def token_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = estimate_tokens(F.col("text"))
    found = _docs(spark, sf_dir).agg(*metrics.stats(tokens, "tokens"))
    return found.select(*(F.round(c, 6).alias(c) if c != "tokens_n" else c for c in found.columns))


def text_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncated and clipped texts, by their hashes."""
    c = F.col("text")
    return _docs(spark, sf_dir).select(
        "doc_id", F.md5(truncate(c, 300)).alias("truncated"), F.md5(clipped(c, 300)).alias("clipped"), F.md5(canon(c)).alias("canon")
    )


def redact_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, pattern, replacement = redaction.PATTERNS[0]
    return _docs(spark, sf_dir).select("doc_id", F.md5(F.regexp_replace("text", pattern, replacement)).alias("redacted"))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).select(F.lit("documents").alias("tbl"), F.col("doc_id").alias("id"), "text")
    return docs.unionByName(
        table(spark, sf_dir, "pages").select(F.lit("pages").alias("tbl"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    )


def redact_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("tbl", "id", F.md5(redaction.redact(F.col("text"))).alias("redacted"))


def pii_hit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redaction.hit_totals(_texts(spark, sf_dir), "text")


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials.findings(_texts(spark, sf_dir).withColumn("path", F.concat_ws("/", "tbl", "id")))
    return found.select("path", "line_no", "kind")


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that share a run of eight words with a benchmark item."""
    grams = lambda df, key: df.select(key, F.split(canon(F.col("text")), " ").alias("w")).select(key, F.explode(F.when(F.size("w") >= 8, F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - 7, F.lit(1))), lambda i: F.xxhash64(F.array_join(F.slice("w", i, F.lit(8)), " "))))).alias("gram"))
    held = cut(grams(table(spark, sf_dir, "benchmark"), "item_id").select("gram").distinct())
    if held.count() <= HELD_GRAMS:  # then the documents' runs need no shuffle
        held = F.broadcast(held)
    return grams(_docs(spark, sf_dir), "doc_id").join(held, "gram", "left_semi").select("doc_id").distinct()


def holdout_leak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir)


def release_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on the documents that pass the gate, without those that leak, and one with them."""
    passed = cut(_judged(spark, sf_dir).where(mix.passes_cutoffs(mix.MixConfig(min_coverage=0.5))).select(F.col("doc_id").alias("id")))
    toxic = table(spark, sf_dir, "labels").agg(F.count_if(F.col("toxic") == 1).alias("n_failure_variants"))
    leaks = cut(_leaks(spark, sf_dir).select(F.col("doc_id").alias("id")))
    n_valid = mix.valid_count(F.col("n_accepted"), 0.1)

    def facts(accepted: DataFrame, name: str) -> DataFrame:
        counted = accepted.agg(F.count("*").alias("n_accepted")).join(release.leaked(accepted, leaks).agg(F.count("*").alias("n_leaked"))).join(
            toxic
        )
        whole = counted.withColumns({"n_validation": n_valid.cast("long"), "n_train": F.col("n_accepted") - n_valid.cast("long")})
        return whole.withColumns(
            {"name": F.lit(name), "expert_decisions": F.lit(1), "outcome_assertions": F.lit(True), "privacy_clean": F.lit(True)}
        )

    every = facts(passed, "all").unionByName(facts(passed.join(leaks, "id", "left_anti"), "without leaks"))
    judged = release.assess_release(every)
    return judged.select(
        "name", "n_accepted", "n_train", "n_validation", "n_leaked", F.array_join("reasons", "; ").alias("reasons"), "status"
    )


def entity_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of a few names each document mentions."""
    names = ("the", "entre", "schule", "world", "token", "license")
    entities = spark.createDataFrame(list(enumerate(names)), "pos int, name string")
    chain = F.array(
        F.struct(F.lit("read").alias("tool"), F.lit("{}").alias("tool_input"), F.coalesce("text", F.lit("")).alias("result_preview"))
    )
    found = traces.ground_entities(_docs(spark, sf_dir).select("doc_id", chain.alias("chain")), entities)
    return found.select("doc_id", F.array_join("entity_refs", ",").alias("refs"))


def parametric_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that stand in the context, which here are the opening texts of the user turns."""
    rows = _turns(spark, sf_dir).withColumn("answer_draft", F.concat(F.col("answer"), F.lit(""))).withColumn(
        "ord", F.col("conv_id") * 1000 + F.col("turn")
    )
    flagged = metrics.parametric_flags(rows, "domain entities: the and of in")
    return flagged.agg(
        F.count("*").alias("n"),
        F.count_if("flagged").alias("flagged"),
        F.round(F.avg(F.col("flagged").cast("double")), 6).alias("fraction"),
    )


def corpus_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a blank line after each line, packed into chunks."""
    files = _docs(spark, sf_dir).select(F.col("doc_id").alias("path"), F.regexp_replace("text", "\n", "\n\n").alias("text"))
    return corpus.corpus_chunks(files).select(
        F.col("path").alias("doc_id"), "pos", F.length("chunk").alias("chars"), F.md5("chunk").alias("hash")
    )


def kb_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents, titled by their source and language, of three queries."""
    docs = _docs(spark, sf_dir)
    articles = docs.select(
        F.col("doc_id").alias("article_id"),
        F.concat_ws(" ", "source", "lang").alias("title"),
        F.col("text").alias("body"),
        F.lit("").alias("tags"),
        F.col("lang").alias("category"),
    )
    return search.search(articles, ["license token src1 en", "The password of src2", "de una"]).select(
        "query", "place", "article_id", "category", F.round("score", 6).alias("score"), F.md5("snippet").alias("snippet")
    )


def agreement_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality labels against toxicity labels, as two judges; a made-up latency comes from the id."""
    verdict = lambda good: F.when(good, "accept").otherwise("reject")
    runs = F.array(F.lit(0.5), F.col("doc_id") % 10 / 10, F.lit(0.6))
    labels = table(spark, sf_dir, "labels")
    return search.agreement(
        labels.select(
            verdict(F.col("quality") == 1).alias("first"),
            verdict(F.col("toxic") == 0).alias("second"),
            runs.alias("runs"),
            (F.col("doc_id") % 97).alias("latency_ms"),
        )
    )


QUERIES = {
    f.__name__: f
    for f in (
        first_wins_dedupe, dedupe_report, quality_gate, mix_split, mix_sources_report, sft_messages, external_messages, eval_rows, token_length_stats, text_shapes, redact_email, redact_all,
        pii_hit_counts, secret_scan, holdout_leak, release_verdict, entity_grounding, parametric_flags, corpus_chunks, kb_search, agreement_report,
    )
}

_NORM_SQL = r"trim(regexp_replace(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g'))"
_CANON_SQL = r"trim(regexp_replace(lower({0}), '\s+', ' ', 'g'))"
_JUDGED_SQL = """l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
judged AS (SELECT d.*, coalesce(quality = 1, false) AND coalesce(toxic, 0) <> 1 AS passes FROM documents d LEFT JOIN l USING (doc_id))"""
_SPLIT_SQL = "CASE WHEN row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id) <= CASE WHEN count(*) OVER () = 0 THEN 0 ELSE greatest(1, floor(count(*) OVER () * 0.1::DOUBLE)) END THEN 'valid' ELSE 'train' END"
_TURNS_SQL = "turns AS (SELECT DISTINCT u.conv_id, u.turn, u.text AS question, a.text AS answer FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND u.role = 'user' AND a.role = 'assistant' AND a.turn = u.turn + 1)"
_TEXTS_SQL = "texts AS (SELECT 'documents' AS tbl, doc_id AS id, text FROM documents UNION ALL SELECT 'pages', page_id, html FROM pages)"
#: Rules without look-around, which the oracle lacks: a digit's absence at both ends is written as a character that
#: stays, and the replacement runs twice, as neighbouring hits share such a character.
_GUARDED = {
    "phone": r"(?:\+?1[-.\s]?)?(?:\(?\d{3}\)?[-.\s]?)?\d{3}[-.\s]?\d{4}", "ssn": r"\d{3}-\d{2}-\d{4}", "credit_card": r"(?:\d[ -]?){13,16}"
}


def _redacted_sql() -> tuple[str, list[str]]:
    """The nested replacements, and the statement of each step."""
    text, steps = "text", []
    for label, pattern, replacement in redaction.PATTERNS:
        quoted = (_GUARDED.get(label) or pattern).replace("'", "''")
        if label in _GUARDED:
            for _ in range(2):
                text = f"regexp_replace({text}, '(^|[^0-9])({quoted})([^0-9]|$)', '\\1{replacement}\\3', 'g')"
        else:
            text = f"regexp_replace({text}, '{quoted}', '{replacement}', 'g')"
        steps.append(text)
    return text, steps


def _hits_sql() -> str:
    """Hits by how much longer the text would be if the marks were longer by one character."""
    parts = []
    ctes = [_TEXTS_SQL, "t0 AS (SELECT coalesce(text, '') AS text FROM texts)"]
    for k, (label, pattern, _) in enumerate(redaction.PATTERNS):
        quoted = (_GUARDED.get(label) or pattern).replace("'", "''")
        now, longer = (
            f"regexp_replace(regexp_replace(text, '(^|[^0-9])({quoted})([^0-9]|$)', '\\1{m}\\3', 'g'), '(^|[^0-9])({quoted})([^0-9]|$)', '\\1{m}\\3', 'g')" if label in _GUARDED else f"regexp_replace(text, '{quoted}', '{m}', 'g')" for m in (
                "<" + label.upper() + ">", "<" + label.upper() + "+>"
            )
        )
        ctes.append(f"t{k + 1} AS (SELECT {now} AS text, length({longer}) - length({now}) AS hits FROM t{k})")
        parts.append(f"SELECT '{label}' AS label, CAST(coalesce(sum(hits), 0) AS BIGINT) AS hits FROM t{k + 1}")
    return "WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(parts)


def _kinds_sql() -> str:
    cases = " UNION ALL ".join(
        f"""SELECT path, line_no, '{kind}' AS kind FROM lines WHERE regexp_matches(line, '{pattern.replace("'", "''")}')""" for kind, pattern in credentials.KINDS
    )
    return f"WITH {_TEXTS_SQL}, split AS (SELECT tbl || '/' || id AS path, string_split(text, chr(10)) AS parts FROM texts), lines AS (SELECT path, unnest(range(1, len(parts) + 1)) AS line_no, unnest(parts) AS line FROM split) {cases}"


_GRAMS_SQL = f"""w AS (SELECT doc_id, string_split({_CANON_SQL.format("text")}, ' ') AS w FROM documents),
bw AS (SELECT item_id, string_split({_CANON_SQL.format("text")}, ' ') AS w FROM benchmark),
g AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i : i + 7], ' '))) AS gram FROM w WHERE len(w) >= 8),
bg AS (SELECT DISTINCT unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i : i + 7], ' '))) AS gram FROM bw WHERE len(w) >= 8),
leaks AS (SELECT DISTINCT doc_id FROM g JOIN bg USING (gram))"""

_WORDS_SQL = "list_distinct(regexp_extract_all(lower({0}), '[a-z0-9]+'))"

ORACLE_SQL = {
    "corpus_chunks": r"""WITH p AS (SELECT doc_id, string_split(replace(coalesce(text, ''), chr(10), chr(10) || chr(10)), chr(10) || chr(10)) AS parts FROM documents),
      f AS (SELECT doc_id, list_reduce(list_transform(parts, lambda part: {'done': CAST([] AS VARCHAR[]), 'now': part, 'size': length(part)}),
        lambda acc, nxt: CASE WHEN acc.size + nxt.size > 4000 THEN {'done': list_append(acc.done, acc.now), 'now': nxt.now, 'size': nxt.size}
          ELSE {'done': acc.done, 'now': acc.now || chr(10) || chr(10) || nxt.now, 'size': acc.size + nxt.size} END) AS s FROM p),
      c AS (SELECT doc_id, list_filter(list_append(s.done, s.now), lambda chunk: regexp_matches(chunk, '\S')) AS chunks FROM f),
      u AS (SELECT doc_id, unnest(chunks) AS chunk, CAST(unnest(range(0, len(chunks))) AS INTEGER) AS pos FROM c)
      SELECT doc_id, pos, CAST(length(chunk) AS INTEGER) AS chars, md5(chunk) AS hash FROM u""",
    "kb_search": f"""WITH q(query) AS (VALUES ('license token src1 en'), ('The password of src2'), ('de una')), qw AS (SELECT query, {_WORDS_SQL.format("query")} AS w FROM q),
      d AS (SELECT doc_id, lang, coalesce(text, '') AS text, {_WORDS_SQL.format("source || ' ' || lang")} AS t, {_WORDS_SQL.format("source || ' ' || lang || ' ' || coalesce(text, '')")} AS h FROM documents),
      s AS (SELECT query, doc_id, lang, text, (len(list_intersect(w, h)) + len(list_intersect(w, t))) / CAST(len(w) + 1 AS DOUBLE) AS score FROM d, qw),
      r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS INTEGER) AS place FROM s WHERE score > 0)
      SELECT query, place, doc_id AS article_id, lang AS category, round(score, 6) AS score, md5(CASE WHEN length(text) > 220 THEN left(text, 220) || '...' ELSE text END) AS snippet FROM r WHERE place <= 5""",
    "agreement_report": """WITH j AS (SELECT quality = 1 AS a, toxic = 0 AS b, doc_id % 10 / 10.0::DOUBLE AS p, doc_id % 97 AS l FROM labels)
      SELECT count(*) AS n, round(avg(CASE WHEN a = b THEN 1.0 ELSE 0 END), 4) AS agreement, count(*) FILTER (WHERE a) AS first_accepts, count(*) FILTER (WHERE b) AS second_accepts,
        round(coalesce(avg(greatest(p, 0.6) - least(p, 0.5)) FILTER (WHERE a), 0), 3) AS mean_spread, count(*) FILTER (WHERE a AND p < 0.5) AS flips, max(l) AS latency_max,
        (SELECT l FROM j ORDER BY l LIMIT 1 OFFSET (SELECT count(*) // 2 FROM j)) AS latency_p50 FROM j""",
    "first_wins_dedupe": f"SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY {_NORM_SQL} ORDER BY doc_id) AS k FROM documents) WHERE k = 1",
    "dedupe_report": f"SELECT CAST(sum(n) AS BIGINT) AS n_in, count(*) AS n_unique, CAST(sum(n) - count(*) AS BIGINT) AS n_dupes, max(n) AS largest FROM (SELECT {_NORM_SQL} AS k, count(*) AS n FROM documents GROUP BY 1)",
    "quality_gate": f"WITH {_JUDGED_SQL} SELECT doc_id, passes FROM judged",
    "mix_split": f"SELECT doc_id, {_SPLIT_SQL} AS split FROM documents",
    "mix_sources_report": f"WITH {_JUDGED_SQL}, u AS (SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY {_NORM_SQL} ORDER BY doc_id) AS k FROM judged WHERE passes) WHERE k = 1), s AS (SELECT source, {_SPLIT_SQL} AS split FROM u) SELECT source, split, count(*) AS n FROM s GROUP BY source, split",
    "sft_messages": f"""WITH {_TURNS_SQL} SELECT conv_id, turn, 0 AS pos, 'system' AS role, '{traces.SYSTEM_PROMPT}' AS content FROM turns
      UNION ALL SELECT conv_id, turn, 1, 'user', question || chr(10) || chr(10) || 'Available tools: search, read' FROM turns
      UNION ALL SELECT conv_id, turn, 2, 'assistant', 'Executed chain:' || chr(10) || chr(10) || chr(10) || 'Answer: ' || answer FROM turns""",
    "external_messages": "SELECT conv_id, 'external' AS source, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos, role, text AS content FROM conversations",
    "eval_rows": rf"""WITH {_TURNS_SQL} SELECT conv_id || '-' || turn AS scenario_id, 'normal' AS category, question AS prompt, answer AS expected_answer, left(answer, 60) AS outcome,
      CASE WHEN regexp_matches(question, '\b(status of|what is the status|what is status|look ?up|lookup|show me|get the|retrieve)\b', 'i') THEN 'read' WHEN regexp_matches(question, '\b(close|resolve|cancel|delete|remove)\b', 'i') THEN 'delete'
        WHEN regexp_matches(question, '\b(create|file|open|raise|submit|add)\b', 'i') THEN 'create' ELSE 'unknown' END AS intent_type, false AS verified, 0 AS n_calls FROM turns""",
    "token_length_stats": "SELECT round(avg(t), 6) AS tokens_mean, CAST(min(t) AS DOUBLE) AS tokens_min, CAST(max(t) AS DOUBLE) AS tokens_max, round(stddev_pop(t), 6) AS tokens_stdev, count(*) AS tokens_n FROM (SELECT greatest(1, length(coalesce(text, '')) // 4) AS t FROM documents)",
    "text_shapes": f"SELECT doc_id, md5(CASE WHEN length(text) <= 300 THEN text ELSE rtrim(left(text, 299), ' ') || '…' END) AS truncated, md5(CASE WHEN length(text) > 300 THEN left(text, 300) || '...' ELSE text END) AS clipped, md5({_CANON_SQL.format('text')}) AS canon FROM documents",
    "redact_email": f"SELECT doc_id, md5(regexp_replace(text, '{redaction.PATTERNS[0][1]}', '{redaction.PATTERNS[0][2]}', 'g')) AS redacted FROM documents",
    "redact_all": f"WITH {_TEXTS_SQL} SELECT tbl, id, md5({_redacted_sql()[0]}) AS redacted FROM texts",
    "pii_hit_counts": _hits_sql(),
    "secret_scan": _kinds_sql(),
    "holdout_leak": f"WITH {_GRAMS_SQL} SELECT doc_id FROM leaks",
    "release_verdict": f"""WITH {_JUDGED_SQL}, {_GRAMS_SQL}, p AS (SELECT doc_id, doc_id IN (SELECT doc_id FROM leaks) AS leak FROM judged WHERE passes),
      c AS (SELECT 'all' AS name, count(DISTINCT doc_id) AS n, count(*) FILTER (WHERE leak) AS k FROM p UNION ALL SELECT 'without leaks', count(*), 0 FROM p WHERE NOT leak),
      v AS (SELECT *, CASE WHEN n = 0 THEN 0 ELSE greatest(1, CAST(floor(n * 0.1::DOUBLE) AS BIGINT)) END AS valid, (SELECT count(*) FROM labels WHERE toxic = 1) AS toxic FROM c),
      r AS (SELECT *, array_to_string(list_filter([CASE WHEN k > 0 THEN 'holdout leakage' END, CASE WHEN n < 100 THEN 'insufficient accepted rows' END, CASE WHEN n - valid < 80 THEN 'insufficient training rows' END,
        CASE WHEN valid < 10 THEN 'insufficient validation rows' END, CASE WHEN toxic < 10 THEN 'insufficient failure variants' END], lambda x: x IS NOT NULL), '; ') AS reasons FROM v)
      SELECT name, n AS n_accepted, n - valid AS n_train, valid AS n_validation, k AS n_leaked, reasons, CASE WHEN k > 0 THEN 'failed' WHEN n = 0 THEN 'machine_verified' WHEN reasons <> '' THEN 'accepted' ELSE 'released' END AS status FROM r""",
    "entity_grounding": "SELECT doc_id, array_to_string(list_filter(['the', 'entre', 'schule', 'world', 'token', 'license'], lambda n: contains(lower(coalesce(text, '')) || chr(10) || 'read', n)), ',') AS refs FROM documents",
    "parametric_flags": f"WITH {_TURNS_SQL}, f AS (SELECT length({_CANON_SQL.format('answer')}) >= 40 AND contains('domain entities: the and of in', {_CANON_SQL.format('answer')}) AS flagged FROM turns) SELECT count(*) AS n, count(*) FILTER (WHERE flagged) AS flagged, round(avg(CASE WHEN flagged THEN 1.0 ELSE 0 END), 6) AS fraction FROM f",
}
