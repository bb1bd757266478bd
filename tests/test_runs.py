import json
import random

import pytest
from pyspark.sql import functions as F

from loomline import cli
from loomline.errors import BudgetExceeded, ConfigError, ModelError, RunFailed, TooFewSamples, TransientModelError
from loomline.plans import config as configs
from loomline.plans.factory import FactoryRun
from loomline.plans.generation import generate_samples
from loomline.plans.model import ModelClient
from loomline.sources import documents, readers, sinks
from loomline.streaming import events

TOOLS = [
    {
        "name": "get_ticket",
        "description": "Returns the ticket text",
        "input_schema": {"properties": {"ticket_id": {"type": "string"}}, "required": ["ticket_id"]},
    },
    {"name": "close_ticket", "description": "Closes", "input_schema": {"properties": {"ticket_id": {"type": "string"}}}},
    {"name": "odd", "input_schema": "none"},
]
SAMPLE = {
    "query": "q",
    "response": "r",
    "api_use_chains": {
        "c0": {
            "intermediate_steps": [
                [{"tool": "get_ticket", "tool_input": {"ticket_id": "get_ticket"}}, {"status": "open", "mail": "a@b.org"}]
            ]
        },
        "c1": {"intermediate_steps": [[{"tool": "missing", "tool_input": {}}, "x"]]},
    },
}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "catalog.json").write_text(json.dumps(TOOLS))
    (tmp_path / "samples").mkdir()
    for k in range(2):
        (tmp_path / "samples" / f"s{k}.json").write_text(json.dumps(SAMPLE))
    return tmp_path


def run_config(folder, **how):
    raw = {
        "name": "test", "catalogs": [{"name": "files", "path": f"{folder}/catalog.json"}], "generation": {
            "samples_dir": f"{folder}/samples", "output_hints": {"get_ticket": [["ticket_id", "string"]]}
        },
        "output": {"dir": f"{folder}/out"},
    }
    for key, value in how.items():
        raw[key] = raw.get(key, {}) | value
    return configs.from_dict(raw)


def test_a_run_from_catalog_to_card(spark, folder):
    run = FactoryRun(spark, run_config(folder))
    report = run.run()
    assert report["status"] == "ok" and report["stages"]["refine"]["num_kept"] == 2 and report["stages"]["refine"]["stopped_reason"] == "no_llm_refinement"
    assert report["stages"]["toolkg"]["num_edges"] == 1 and report["stages"]["refine"]["redaction_hits"]["email"] == 2
    kept = run.table("kept").first()
    assert "[REDACTED_EMAIL]" in kept["answer_draft"] and "a@b.org" not in kept["chain"][0]["result_preview"]
    assert report["mix"]["n_train"] + report["mix"]["n_valid"] == report["mix"]["n_records_total"] == 1  # equal questions are one
    lines = [json.loads(x["value"]) for x in spark.read.text([f"{folder}/out/sft_mix/train", f"{folder}/out/sft_mix/valid"]).collect()]
    assert [m["role"] for m in lines[0]["messages"]] == ["system", "user", "assistant"] and json.loads(lines[0]["provenance"])["source"] == "generated"
    assert "Metrics" in (folder / "out/DATASET_CARD.md").read_text() and json.loads((folder / "out/run_report.json").read_text())["status"] == "ok"
    assert [json.loads(x)["event"] for x in (folder / "out/events.jsonl").read_text().splitlines()][:3] == [
        "started", "started", "finished"
    ]

    again = FactoryRun(spark, run_config(folder)).run(resume=True)
    resumed = [json.loads(x)["stage"] for x in (folder / "out/events.jsonl").read_text().splitlines() if "resumed_from_checkpoint" in x]
    assert again["status"] == "ok" and resumed == ["kg", "toolkg", "generate", "refine"]
    stale = FactoryRun(spark, run_config(folder))
    stale.version = "other"
    assert stale.checkpoint("kg") is None and "stale_checkpoint" in (folder / "out/events.jsonl").read_text()


def test_a_failed_run_says_why_and_is_not_resumed_as_done(spark, folder):
    config = run_config(folder, generation={"min_samples": 5})
    with pytest.raises(RunFailed, match="at least 5"):
        FactoryRun(spark, config).run()
    report = json.loads((folder / "out/run_report.json").read_text())
    assert report["status"] == "failed" and report["failed_stage"] == "generate"
    assert FactoryRun(spark, config).checkpoint("generate") is None


def test_credentials_in_any_file_of_the_run_fail_it(spark, folder):
    (folder / "out").mkdir()
    (folder / "out" / "leak.txt").write_text("one\ntwo\n" + 'aws_key = "AKIA' + "Q" * 16 + '"\n')
    with pytest.raises(RunFailed, match=r"leak.txt:3"):
        FactoryRun(spark, run_config(folder)).run()
    (folder / "out" / "leak.txt").unlink()
    tools = [TOOLS[0] | {"description": "Returns AKIA" + "C" * 16}, *TOOLS[1:]]
    (folder / "catalog.json").write_text(json.dumps(tools))
    with pytest.raises(RunFailed, match="aws_access_key@.*kg_context.json|aws_access_key@.*catalog"):
        FactoryRun(spark, run_config(folder)).run()
    report = json.loads((folder / "out" / "run_report.json").read_text())
    assert report["status"] == "failed" and report["failed_stage"] == "package"


def test_lines_are_numbered_over_the_blocks_of_a_file(spark, tmp_path):
    from loomline.operators import credentials

    key = "AKIA" + "Z" * 16
    lines = [f"line {k} " + "x" * (k % 50) + (key if k % 97 == 5 else "") for k in range(4000)]
    (tmp_path / "a.md").write_text("\n".join(lines))
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "b.json").write_text(key)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        found = sorted((x["path"].rpartition("/")[2], x["line_no"], x["kind"]) for x in credentials.scan_files(spark, str(tmp_path)).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == [("a.md", k + 1, "aws_access_key") for k in range(4000) if k % 97 == 5] + [("b.json", 1, "aws_access_key")]


def test_credentials_fail_a_run(spark, folder):
    leaky = json.loads(json.dumps(SAMPLE).replace("a@b.org", "AKIA" + "B" * 16))
    (folder / "samples" / "s0.json").write_text(json.dumps(leaky))
    with pytest.raises(RunFailed, match="aws_access_key"):
        FactoryRun(spark, run_config(folder, quality={"pii_redact": False})).run()


def test_models_connectors_and_other_graphs(spark, folder):
    client = ModelClient(
        lambda prompt: "QUESTION: show me get_ticket\nANSWER: It reports " + '{"status":"open"' if "chain" in prompt else '{"entities": [{"name": "E", "type": "t", "description": "d"}], "relations": []}'
    )
    asked = run_config(folder, domain={"kg_source": "corpus", "corpus_dir": f"{folder}/corpus"})
    asked.catalogs[0].transport = "stdio"
    (folder / "corpus").mkdir()
    (folder / "corpus" / "a.md").write_text("some text")
    report = FactoryRun(spark, asked, f"{folder}/out2", model=client, connector=lambda catalog: TOOLS[:2]).run()
    assert report["stages"]["kg"]["node_count"] == 1 and report["stages"]["discover"]["num_tools"] == 2
    with pytest.raises(RunFailed, match="connector"):
        FactoryRun(spark, asked, f"{folder}/out3").run()
    (folder / "tables").mkdir()
    (folder / "tables" / "t.csv").write_text("id,p,s\n" + "".join(f"{k},{'ab'[k % 2]},{'xy'[k % 2]}\n" for k in range(40)))
    tables = run_config(folder, domain={"kg_source": "tables", "tables_dir": f"{folder}/tables", "table_keys": {"t": "id"}})
    run = FactoryRun(spark, tables, f"{folder}/out4")
    assert run.run()["status"] == "ok"
    assert {(x["src"], x["dst"]) for x in run.table("kg_edges").where("relation = 'predicts'").collect()} == {("t.s", "t.p")}  # two columns are linked once
    (folder / "spec.yaml").write_text("entities:\n  - name: A\nrelations:\n  - {head: A, relation: r, tail: B}\n")
    spec = FactoryRun(
        spark,
        run_config(folder, domain={"kg_source": "spec", "spec_file": f"{folder}/spec.yaml"}),
        f"{folder}/out5",
        registry={"get_ticket": lambda ticket_id: ticket_id},
    )
    assert spec.run()["stages"]["kg"]["node_count"] == 2


def test_chains_are_made_under_a_cap_and_failures_are_recorded(spark, folder):
    seeds = []

    def make(seed, count):
        seeds.append(seed)
        count()
        count()
        if seed == 43:
            raise ValueError("x" * 900)
        return None if seed == 44 else SAMPLE

    asked = {"num_chains": 10, "seed": 42, "max_llm_calls": 7, "min_samples": 2}
    found = generate_samples(spark, make, f"{folder}/made", 10, 42, 7, 2)
    assert seeds == [42, 43, 44, 45] and (found["num_samples"], found["llm_calls"], found["chains"]) == (2, 8, 4)  # the fourth crosses the cap and is kept
    assert [(x["chain"], x["seed"], x["error_type"], len(x["error"])) for x in found["failures"]] == [
        (1, 43, "ValueError", 500), (2, 44, "NoWorkflow", len("the chain made no workflow"))
    ]
    assert sorted(x.name for x in (folder / "made").glob("*.json")) == ["seed=42.json", "seed=45.json"]
    with pytest.raises(TooFewSamples) as few:
        generate_samples(spark, make, f"{folder}/few", 3, 43, min_samples=2)
    assert few.value.found["num_samples"] == 1 and len(few.value.found["failures"]) == 2

    config = run_config(folder, generation=asked)
    config.generation.samples_dir = ""
    report = FactoryRun(spark, config, f"{folder}/out6", make_chain=make).run()
    made = report["stages"]["generate"]
    assert report["status"] == "ok" and made["num_samples"] == 2 and made["llm_calls"] == 8 and len(made["failures"]) == 2


def test_config_lists_every_problem():
    with pytest.raises(ConfigError) as found:
        configs.from_dict(
            {
                "catalogs": [{"name": "a", "transport": "stdio"}, {"name": "a", "transport": "x", "retries": -1}],
                "domain": {"kg_source": "corpus"},
                "quality": {"min_coverage": 2},
                "output": {"train_split": 1},
            }
        )
    assert len(found.value.problems) == 7
    for raw in ({"domain": []}, {"quality": {"pii_redact": "yes"}}, {"generation": {"seed": "x"}}, {"catalogs": {}}, {"catalogs": ["x"]}):
        with pytest.raises(ConfigError):
            configs.from_dict(raw)
    config = configs.RunConfig(catalogs=[configs.Catalog("a", path="p")])
    assert configs.validate(config) == [] and len(configs.fingerprint(config)) == 16


def test_command_line(folder, capsys, spark):
    path = folder / "run.yaml"
    assert cli.main(["init", "--name", "x", "--output", str(path)]) == 0
    assert cli.main(["validate-config", str(path)]) == 0 and "config OK: x" in capsys.readouterr().out
    path.write_text("catalogs: []\n")
    assert cli.main(["validate-config", str(path)]) == 1 and "at least one" in capsys.readouterr().err
    assert cli.main(["report", "--run-dir", str(folder / "none")]) == 1
    path.write_text(
        json.dumps(
            {
                "catalogs": [{"path": f"{folder}/catalog.json"}],
                "generation": {"samples_dir": f"{folder}/samples"},
                "output": {"dir": f"{folder}/o"},
            }
        )
    )
    assert cli.main(["run", "--config", str(path)]) == 0 and cli.main(["report", "--run-dir", f"{folder}/o"]) == 0
    assert "refine" in capsys.readouterr().out


def client(*replies, **how):
    left, slept = list(replies), []

    def complete(prompt):
        x = left.pop(0)
        if isinstance(x, Exception):
            raise x
        return x

    return ModelClient(complete, sleep=slept.append, rng=random.Random(1), **how), slept


def test_model_client():
    model, slept = client(TimeoutError(), TransientModelError(), "text" * 4)
    assert model("prompt") == "text" * 4 and model.stats()["retries"] == 2 and 0.5 <= slept[0] < 1.5 and 1 <= slept[1] < 3
    model, _ = client(TimeoutError(), TimeoutError(), max_retries=1)
    with pytest.raises(TimeoutError):
        model("p")
    assert model.stats()["fatal_failures"] == 1
    model, _ = client(ValueError("no"))
    with pytest.raises(ModelError, match="no"):
        model("p")
    model, _ = client("x" * 4000, "never", budget_usd=0.001, price_per_1m_output=1.0)
    with pytest.raises(BudgetExceeded):
        model("p")
    with pytest.raises(BudgetExceeded):
        model("p")
    assert model.counts["calls"] == 1
    times = iter([0.0, 1.0, 3.0])
    model, slept = client("a", "b", min_interval_s=3.0, clock=lambda: next(times))
    model("p"), model("p")
    assert slept == [2.0]


def test_tables(spark, tmp_path):
    (tmp_path / "B.CSV").write_text('a,b,c,d\n1, x ,1.5,\n2,,2,\n,"y, z",3e2,\n')
    (tmp_path / "a.json").write_text('[{"id": 1, "name": "n"}, {"id": 2, "name": null}]')
    (tmp_path / "note.txt").write_text("x")
    found = readers.read_tables(spark, str(tmp_path))
    assert list(found) == ["B", "a"]
    assert found["B"].dtypes == [("a", "bigint"), ("b", "string"), ("c", "double"), ("d", "string")]
    assert [tuple(x) for x in found["B"].collect()] == [(1, "x", 1.5, None), (2, None, 2.0, None), (None, "y, z", 300.0, None)]
    assert dict(found["a"].dtypes) == {"id": "bigint", "name": "string"}
    (tmp_path / "bad.json").write_text('{"id": 1}')
    for at in (str(tmp_path), str(tmp_path / "none")):
        with pytest.raises(readers.ProbeError):
            readers.read_tables(spark, at)


def test_corpus_specs_and_catalogs(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name, text in (("a.md", "A"), ("sub/b.TXT", "B\nb"), ("c.py", "C")):
        (tmp_path / name).write_text(text)
    assert sorted(x["text"] for x in readers.read_corpus(spark, str(tmp_path)).collect()) == ["A", "B\nb"]
    for spec in ({"entities": {"a": 1}}, {"entities": [{}]}, {"relations": [{"head": "a"}]}):
        with pytest.raises(ValueError):
            readers.spec_frames(spark, spec)
    (tmp_path / "m.yaml").write_text("- 1\n")
    with pytest.raises(ValueError):
        readers.read_mapping(spark, str(tmp_path / "m.yaml"))
    (tmp_path / "t.json").write_text(json.dumps(TOOLS))
    one = readers.read_catalog(spark, str(tmp_path / "t.json"))
    assert [x["input_schema"] for x in one.orderBy("ord").collect()][2] == '{"type": "object", "properties": {}}'
    merged = readers.merge_catalogs([one.withColumn("server", F.lit("s1")), one.withColumn("server", F.lit("s2"))])
    assert [x["name"] for x in merged.orderBy("ord").collect()] == [
        "get_ticket", "close_ticket", "odd", "s2__get_ticket", "s2__close_ticket", "s2__odd"
    ]


@pytest.mark.parametrize("ending", ["graphml", "json"])
def test_tool_graphs_come_back(spark, tmp_path, ending):
    nodes = spark.createDataFrame([("a", 'says "<hi>" & more'), ("b", None)], "tool string, description string")
    links = spark.createDataFrame(
        [("a", "b", "composable", 0.5, "x->y")], "src string, dst string, relation string, score double, via string"
    )
    path = sinks.write_tool_graph(nodes, links, f"{tmp_path}/g.{ending}")
    found, edges = readers.read_tool_graph(spark, path)
    assert sorted(((x["tool"], x["description"]) for x in found.collect())) == [("a", 'says "<hi>" & more'), ("b", None)]
    assert [tuple(x) for x in edges.select(links.columns).collect()] == [tuple(x) for x in links.collect()]
    for bad in (
        lambda: sinks.write_tool_graph(nodes, links, f"{tmp_path}/g.txt"), lambda: readers.read_tool_graph(spark, f"{tmp_path}/g.txt")
    ):
        with pytest.raises(ValueError):
            bad()


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("é", None)], "a string, b int")
    sinks.write_jsonl(rows, f"{tmp_path}/lines")
    assert [x["value"] for x in spark.read.text(f"{tmp_path}/lines").collect()] == ['{"a":"é","b":null}']
    findings = {
        "tables": [
            {
                "table": "t",
                "num_rows": 3,
                "sampled_rows": 2,
                "columns": [
                    {
                        "name": "c",
                        "type": "numeric",
                        "cardinality": 2,
                        "missing_frac": 0.25,
                        "min": 1,
                        "max": 2,
                        "mean": 1.5,
                        "top_values": None,
                    }
                ],
                "targets": [],
            }
        ]
    }
    written = sinks.write_findings(spark, findings, f"{tmp_path}/f", lambda prompt: "told")
    assert [x.rpartition("/")[2] for x in written] == ["t.md", "t_narrative.md", "findings.json"]
    text = documents.read_text(spark, written[0])
    assert "3 rows (probed on a sample of 2)." in text and "- c: numeric, 2 distinct, 25.0% missing, range 1 to 2, mean 1.5" in text
    documents.write_text(spark, f"{tmp_path}/log", "a\n", append=True)
    documents.write_text(spark, f"{tmp_path}/log", "b\n", append=True)
    assert documents.read_text(spark, f"{tmp_path}/log") == "a\nb\n"


def test_streams(spark, tmp_path):
    rows = [(f"2024-01-01 00:0{k}:00", "click" if k % 2 else "view", "Mail a@b.org" if k < 2 else f"text {k}", 0.1 * k) for k in range(6)]
    spark.createDataFrame(rows, "ts string, kind string, text string, coverage double").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(
        f"{tmp_path}/in"
    )
    stream = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in").schema).parquet(f"{tmp_path}/in")

    def drained(df, name, mode="append"):
        query = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
        query.processAllAvailable()
        query.stop()
        return spark.table(name).collect()

    clean = drained(events.gated(events.redacted(stream, "text"), 0.2), "clean")
    assert len(clean) == 4 and not any("@" in x["text"] for x in drained(events.redacted(stream, "text"), "red"))
    assert len(drained(events.first_by_text(stream, "text", "ts", "1 hour"), "once")) == 5
    counted = drained(events.windowed_effects(stream, "ts", "kind", "2 minutes", "1 minute"), "windows")
    assert all(x["n"] == 1 for x in counted)
