import re

import pytest
from pyspark.sql import functions as F

from loomline.functions import facts, intent, redaction, text


def values(spark, rows, schema, *columns):
    return [tuple(x) for x in spark.createDataFrame(rows, schema).select(*columns).collect()]


def one(spark, value, function, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(function(F.col("x"))).first()[0]


@pytest.mark.parametrize(("given", "want"), [("", 1), (None, 1), ("abc", 1), ("a" * 8, 2), ("é" * 11, 2)])
def test_token_estimate(spark, given, want):
    assert one(spark, given, text.estimate_tokens) == want


def test_truncation(spark):
    assert one(spark, "abcdef", lambda c: text.truncate(c, 6)) == "abcdef"
    assert one(spark, "abc efg", lambda c: text.truncate(c, 5)) == "abc…"
    assert one(spark, "abcdef", lambda c: text.clipped(c, 3)) == "abc..."


def test_first_filled(spark):
    found = values(
        spark,
        [("", None, "c"), (None, "b", "c"), ("", "", "")],
        "a string, b string, c string",
        text.first_filled(F.col("a"), F.col("b"), F.col("c"), default="none"),
    )
    assert found == [("c",), ("b",), ("none",)]


@pytest.mark.parametrize(("given", "want"), [("  What IS,\n the Time?! ", "what is the time"), ("ñandú² — x_y", "ñandú² x_y"), ("", "")])
def test_normalised_question(spark, given, want):
    assert one(spark, given, text.normalize_question) == want


@pytest.mark.parametrize(
    ("name", "tokens"),
    [
        ("filePath", ["file", "path"]),
        ("directories", ["directory"]),
        ("ticket_ids", ["ticket", "ids"]),
        ("status", ["status"]),
        ("class", ["class"]),
        ("bus", ["bus"]),
        ("ties", ["tie"]),
        ("a.b-c a", ["a", "b", "c"]),
        ("HTTPServer2Name", ["httpserver2", "name"]),
        ("", []),
    ],
)
def test_name_tokens(spark, name, tokens):
    assert one(spark, name, text.name_tokens) == tokens


@pytest.mark.parametrize(
    ("kind", "want"),
    [
        ("int", "integer"),
        (" Text ", "string"),
        ("float", "number"),
        ("weird", "string"),
        (None, "string"),
        ("filepath", "path"),
        ("map", "object"),
    ],
)
def test_types(spark, kind, want):
    assert one(spark, kind, text.normalize_type) == want


def test_compatible_types(spark):
    pairs = [
        ("string", "path", True),
        ("integer", "number", True),
        ("content", "string", True),
        ("path", "content", False),
        ("array", "array", True),
        ("array", "string", False),
    ]
    assert [x[0] for x in values(spark, pairs, "a string, b string, w boolean", text.types_compatible(F.col("a"), F.col("b")))] == [
        p[2] for p in pairs
    ]


def test_dice(spark):
    rows = [(["a", "b"], ["b", "c"]), ([], ["a"]), (["a"], ["a"])]
    assert values(spark, rows, "a array<string>, b array<string>", text.dice(F.col("a"), F.col("b"))) == [(0.5,), (0.0,), (1.0,)]


@pytest.mark.parametrize(
    ("tool", "effect"),
    [
        ("get_ticket", "READ"),
        ("Create_x", "CREATE"),
        ("close", "DELETE"),
        ("set_state", "UPDATE"),
        ("frob_x", "UNKNOWN"),
        (None, "UNKNOWN"),
        ("lookup_user", "READ"),
    ],
)
def test_effects(spark, tool, effect):
    assert one(spark, tool, intent.tool_effect) == effect


@pytest.mark.parametrize(
    ("question", "want"),
    [
        ("What is the status of T-1?", "READ"),
        ("look up and close it", "READ"),
        ("Close and file it", "DELETE"),
        ("please OPEN one", "CREATE"),
        ("reopened filing", None),
        (None, None),
    ],
)
def test_intents(spark, question, want):
    assert one(spark, question, intent.question_intent) == want
    assert one(spark, question, intent.intent_label) == (want or "unknown").lower()


@pytest.mark.parametrize(
    ("question", "tools", "want"),
    [
        ("What is the status of T-1?", ["create_ticket"], False), ("What is the status of T-1?", ["create_ticket", "get_ticket"], True), (
            "Create a ticket", ["create_ticket"], True
        ),
        ("Close it", ["get_ticket"], False), ("Hello there", ["create_ticket"], True), ("Create a ticket", [], False), ("Create a ticket", None, False), ("show me", ["update_x"], True), (
            "show me", ["", None], False
        ),
    ],
)
def test_alignment(spark, question, tools, want):
    assert values(spark, [(question, tools)], "q string, t array<string>", intent.intent_aligned(F.col("q"), F.col("t"))) == [(want,)]


REDACTIONS = [
    ("mail a.b@c.org now", "mail [REDACTED_EMAIL] now", {"email": 1}),
    ("sk-" + "a" * 24, "[REDACTED_KEY]", {"api_key": 1}),
    ("AKIA" + "A1B2" * 4, "[REDACTED_AWS_KEY]", {"aws_access_key": 1}),
    ("-----BEGIN RSA PRIVATE KEY-----\nx\n-----END RSA PRIVATE KEY-----", "[REDACTED_PRIVATE_KEY]", {"private_key_block": 1}),
    ("api_key = 'abcdef123456'", "[REDACTED_CREDENTIAL]", {"api_key_assignment": 1}),
    ("Bearer abcdefghijklmnop12", "[REDACTED_TOKEN]", {"bearer_token": 1}),
    ("call 555-123-4567 or 555-987-6543", "call [REDACTED_PHONE] or [REDACTED_PHONE]", {"phone": 2}),
    ("ssn 123-45-6789", "ssn [REDACTED_SSN]", {"ssn": 1}),
    ("card 4111111111111111", "card [REDACTED_CARD]", {"credit_card": 1}),
    ("4111 1111 1111 1111", "4111 [REDACTED_PHONE] 1111", {"phone": 1}),
    ("nothing", "nothing", {}),
    (None, None, {}),
]


def test_redaction_and_its_counts(spark):
    df = spark.createDataFrame([(k, x[0]) for k, x in enumerate(REDACTIONS)], "k int, x string")
    found = redaction.with_redaction(df, "x").orderBy("k").collect()
    assert [(r["x"], r["pii_redactions"]) for r in found] == [(x[1], x[2]) for x in REDACTIONS]
    assert [r[0] for r in df.orderBy("k").select(redaction.redact(F.col("x"))).collect()] == [x[1] for x in REDACTIONS]
    totals = {r["label"]: r["hits"] for r in redaction.hit_totals(df, "x").collect()}
    assert totals["phone"] == 3 and totals["ssn"] == 1 and totals["openrouter_key"] == 0 and len(totals) == 10


FACTS = [
    ('{"zeta": "abc", "status": "open"}', ("status", "open")),
    ('{"zeta": "abc", "eta": "xyz"}', ("zeta", "abc")),
    ('{"a": 1.5, "b": null, "c": "x", "d": 42}', ("d", "42")),
    ('{"ok": true}', ("ok", "True")),
    ('{"inner": {"name": "box"}, "f": 2.5}', ("inner.name"[6:], "box")),
    ('{"id": 7, "list": [1, 2]}', None),
    ('["status"]', None),
    ("plain text", None),
    ('{"status": "cut off', None),
    (None, None),
    ('{"with.dot": "value", "q": "z"}', ("with.dot", "value")),
]


@pytest.mark.parametrize(("preview", "want"), FACTS)
def test_salient_facts(spark, preview, want):
    found = one(spark, preview, facts.salient_fact)
    assert (found and tuple(found)) == want


def test_outcomes(spark):
    rows = [("create_ticket", '{"id": "T-1"}'), ("get_ticket", '{"status": "open"}'), ("close_ticket", "done"), ("get_ticket", "some text")]
    found = [tuple(x[0]) for x in values(spark, rows, "t string, p string", facts.expected_outcome(F.col("t"), F.col("p")))]
    assert found == [
        ("create_ticket result reports id=T-1", "T-1", "create_ticket applied: id=T-1"),
        ("get_ticket result reports status=open", "open", "get_ticket observed: status=open"),
        ("close_ticket completed with the recorded result", "done", "close_ticket applied"),
        ("get_ticket completed with the recorded result", "some text", None),
    ]
    assert one(spark, "get_x", facts.request_verb) == "look up" and one(spark, "frob", facts.request_verb) == "use"


def test_outcomes_take_each_value_once(spark):
    df = spark.createDataFrame([("get_x", '{"k\'s": "abc"}')], "t string, p string")
    found = df.select(facts.expected_outcome(F.col("t"), F.col("p")).alias("o"))
    assert found.first()["o"]["assertion"] == "abc"  # a key that a path can't name
    plan = found._jdf.queryExecution().analyzed().toString()
    # the check that it parses, its own values, and what lies below if those tell nothing (its texts, then their values)
    assert plan.count("parse_json") == 1 and plan.count("from_json") == 3 and "get_json_object" not in plan


def test_intents_search_a_question_once(spark):
    df = spark.createDataFrame([("Show me it", ["get_x", None, "", "create_y"])], "q string, t array<string>").select(intent.intent_aligned(F.col("q"), F.col("t")).alias("x"))
    assert df.first()[0] is True and df._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 3


def test_hits_side_by_side_are_each_redacted(spark):
    """What the DuckDB statement, which has no look-around, leaves a part of; rules are those of Python's engine."""
    given = ["555-1234 555-123-4567", "555-1234 (555) 123-4567", "555-1234 1 555-1234", "ésk-" + "a1" * 12]
    df = spark.createDataFrame(list(enumerate(given)), "k int, x string")
    wanted = given
    for _, pattern, mark in redaction.PATTERNS:
        wanted = [re.sub(pattern, mark, x) for x in wanted]
    assert [r[0] for r in df.orderBy("k").select(redaction.redact(F.col("x"))).collect()] == wanted
    assert wanted[:3] == ["[REDACTED_PHONE] [REDACTED_PHONE]"] * 3 and wanted[3] == given[3]
