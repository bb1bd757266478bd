"""A run from catalogs and samples to a checked, split data set, in stages with checkpoints."""

from __future__ import annotations

import datetime
import hashlib
import json
import time
import traceback
from collections.abc import Callable
from dataclasses import asdict
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.errors import RunFailed
from loomline.functions.redaction import PATTERNS, with_redaction
from loomline.operators import composability, credentials, graph, metrics, mix, probe, refine, traces
from loomline.operators.corpus import corpus_graph
from loomline.plans import generation
from loomline.plans.config import RunConfig, fingerprint
from loomline.session import remove_dir
from loomline.sources import documents, readers, sinks

STAGES = ("discover", "kg", "toolkg", "generate", "refine", "package", "eval")
#: Stages whose results a resumed run takes from their checkpoints.
RESUMED = ("kg", "toolkg", "generate", "refine")


def code_version() -> str:
    """Sixteen hexadecimal digits of this package's source; a checkpoint of other code is stale."""
    digest = hashlib.sha256()
    for path in sorted(Path(__file__).resolve().parents[1].rglob("*.py")):
        digest.update(path.read_bytes())
    return digest.hexdigest()[:16]


def now() -> str:
    return datetime.datetime.now(datetime.UTC).isoformat(timespec="seconds")


class FactoryRun:
    """One run below a folder that driver and executors share.

    ``connector(catalog) -> list of tools`` asks servers, ``generate(run) -> samples frame`` makes samples; without them
    catalogs come from files and samples from generation.samples_dir. ``make_chain(seed, count) -> sample`` makes one
    sample instead; its calls are capped and its failures recorded. ``model`` drafts and refines texts, ``registry``
    executes tools by name, ``keep`` is the semantic filter. Each stage's tables are Parquet with a checkpoint beside
    them that says how the stage ended, and by which code.
    """

    def __init__(
        self,
        spark: SparkSession,
        config: RunConfig,
        workdir: str | None = None,
        model: Callable[[str], str] | None = None,
        connector: Callable | None = None,
        generate: Callable | None = None,
        registry: dict[str, Callable] | None = None,
        keep: Callable[[dict], bool] | None = None,
        make_chain: generation.Maker | None = None,
    ):
        self.spark, self.config, self.model, self.connector, self.generate, self.registry, self.keep = spark, config, model, connector, generate, registry, keep
        self.make_chain = make_chain
        self.workdir = (workdir or config.output.dir).rstrip("/")
        self.summaries: dict[str, dict] = {}
        self.found: dict[str, Any] = {}
        self.version = code_version()

    # What stages leave behind.

    def path(self, *parts: str) -> str:
        return "/".join([self.workdir, *parts])

    def event(self, stage: str, event: str, detail: Any = None) -> None:
        row = {"ts": now(), "stage": stage, "event": event} | ({} if detail is None else {"detail": detail})
        documents.write_text(self.spark, self.path("events.jsonl"), json.dumps(row, default=str) + "\n", append=True)

    def save(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path("tables", name))
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path("tables", name))

    def checkpoint(self, stage: str) -> dict | None:
        """A stage's checkpoint, if the stage ended well and by this code."""
        path = self.path("checkpoints", f"{stage}.json")
        if not documents.exists(self.spark, path):
            return None
        found = documents.read_json(self.spark, path)
        if found.get("code_version") != self.version:
            self.event(stage, "stale_checkpoint", {"stored": found.get("code_version"), "current": self.version})
            return None
        return found if found.get("status") == "ok" else None

    def stage(self, name: str, resume: bool) -> None:
        if resume and name in RESUMED and (summary := self.checkpoint(name)):
            self.event(name, "resumed_from_checkpoint")
            self.summaries[name] = summary
            return
        self.event(name, "started")
        began = time.monotonic()
        try:
            summary = {"status": "ok", **getattr(self, f"run_{name}")()}
        except Exception as e:
            summary = {"status": "failed", "error": f"{type(e).__name__}: {str(e)[:2000]}", "traceback": traceback.format_exc(limit=8)}
            raise
        finally:
            summary |= {"duration_s": round(time.monotonic() - began, 1), "code_version": self.version}
            self.summaries[name] = summary
            documents.write_json(self.spark, self.path("checkpoints", f"{name}.json"), summary)
            self.event(name, "finished" if summary["status"] == "ok" else "failed", summary.get("error"))

    # Stages.

    def run_discover(self) -> dict:
        catalogs = []
        for x in self.config.catalogs:
            if x.transport == "file":
                catalogs.append(readers.read_catalog(self.spark, x.path).withColumn("server", F.lit(x.name)))
            elif self.connector is None:
                raise RunFailed(f"catalog {x.name}: no connector for {x.transport}")
            else:
                tools = [
                    (k, t["name"], t.get("description") or "", json.dumps(t.get("input_schema") or {}), x.name) for k, t in enumerate(
                        self.connector(x)
                    )
                ]
                catalogs.append(
                    self.spark.createDataFrame(tools, "ord long, name string, description string, input_schema string, server string")
                )
        tools = self.save("catalog", readers.merge_catalogs(catalogs))
        return {"num_tools": tools.count(), "servers": [x.name for x in self.config.catalogs]}

    def run_kg(self) -> dict:
        d = self.config.domain
        if d.kg_source == "tools":
            nodes, edges = graph.tool_graph(self.table("catalog"), d.max_entities)
        elif d.kg_source == "spec":
            nodes, edges = graph.spec_graph(*readers.spec_frames(self.spark, readers.read_mapping(self.spark, d.spec_file)), d.max_entities)
        elif d.kg_source == "corpus":
            nodes, edges = corpus_graph(readers.read_corpus(self.spark, d.corpus_dir), self.model, d.max_entities)
        else:
            nodes, edges = self._graph_of_tables()
        nodes, edges = self.save("kg_nodes", nodes), self.save("kg_edges", edges)
        context = graph.export_context(nodes, edges)
        documents.write_json(self.spark, self.path("kg_context.json"), context, sort_keys=True)
        return {"kg_source": d.kg_source, **context["meta"]}

    def _graph_of_tables(self) -> tuple[DataFrame, DataFrame]:
        d = self.config.domain
        tables = readers.read_tables(self.spark, d.tables_dir)
        if not tables:
            raise RunFailed(f"no .csv or .json tables in {d.tables_dir}")
        keyed = {}
        for name, df in tables.items():
            key = d.table_keys.get(name)
            keyed[name] = (df, key) if key else (df.withColumn("_row", F.monotonically_increasing_id()), "_row")
        findings = probe.probe_tables(keyed, d.table_targets, seed=self.config.generation.seed)
        sinks.write_findings(self.spark, findings, self.path("tables_corpus"), self.model)
        entities, relations = probe.findings_graph(self.spark, findings)
        structural = graph.merge_entities(entities), graph.merge_relations(relations)
        if self.model is None:
            return graph.cap_entities(*structural, d.max_entities)
        told = corpus_graph(readers.read_corpus(self.spark, self.path("tables_corpus")), self.model, d.max_entities)
        return graph.union_graphs(structural, told, d.max_entities)

    def run_toolkg(self) -> dict:
        rows = [
            (tool, k, prop, kind) for tool, props in self.config.generation.output_hints.items() for k, (prop, kind) in enumerate(props)
        ]
        hints = self.spark.createDataFrame(rows, "tool string, pos int, output_prop string, output_type string") if rows else None
        tools = self.save("tools", composability.normalize_tools(self.table("catalog"), hints))
        edges = self.save("tool_edges", composability.composability_edges(tools))
        sinks.write_tool_graph(tools, edges, self.path("toolkg.graphml"))
        return composability.graph_stats(tools, edges).first().asDict()

    def run_generate(self) -> dict:
        g, made = self.config.generation, {}
        if self.make_chain is not None:
            folder = self.path("samples")
            # files of an earlier attempt, of other seeds, would be read as this one's
            remove_dir(self.spark, folder)
            made = generation.generate_samples(self.spark, self.make_chain, folder, g.num_chains, g.seed, g.max_llm_calls, g.min_samples)
            samples = readers.read_samples(self.spark, folder) if made["num_samples"] else self.spark.createDataFrame([], f"sample_id string, {traces.SAMPLE_SCHEMA}")
        elif self.generate is not None:
            samples = self.generate(self)
        elif g.samples_dir:
            samples = readers.read_samples(self.spark, g.samples_dir)
        else:
            raise RunFailed("no generator and no samples_dir")
        samples = self.save("samples", samples)
        n = samples.count()
        if n < g.min_samples:
            raise RunFailed(f"{n} samples; at least {g.min_samples} are required")
        return {**made, "num_samples": n, "requested": g.num_chains}

    def _context(self) -> tuple[dict, DataFrame]:
        context = documents.read_json(self.spark, self.path("kg_context.json"))
        names = [(k, x["name"]) for k, x in enumerate(context["entities"])]
        return context, self.spark.createDataFrame(names, "pos int, name string")

    def run_refine(self) -> dict:
        q = self.config.quality
        context, entities = self._context()
        edges, samples = self.table("tool_edges"), self.table("samples")
        summaries = traces.tool_summaries(self.table("tools")).first()["text"]
        text = graph.context_text(context)
        rows = self.save("drafted", traces.qa_rows(samples, entities, edges=edges, model=self.model, context=text, tools=summaries))
        catalog = self.table("catalog").select(F.col("name").alias("tool"), "input_schema")
        config = refine.RefineConfig(
            q.max_iterations, q.min_coverage, q.require_chain_valid, q.require_entities, self.config.generation.seed
        )
        how = {"registry": self.registry} if self.registry else {}
        kept, ledger = refine.refine(
            rows, catalog, edges, entities, self.model, self.keep if q.semantic_filter else None, config, text, summaries, **how
        )
        hits: dict[str, int] = {}
        if q.pii_redact:
            counted = with_redaction(with_redaction(kept, "question", "_q", "_hq"), "answer_draft", "_a", "_ha")
            sums = counted.agg(*(F.coalesce(F.sum(F.coalesce(F.try_element_at("_hq", F.lit(x)), F.lit(0)) + F.coalesce(F.try_element_at("_ha", F.lit(x)), F.lit(0))), F.lit(0)).alias(x) for x, _, _ in PATTERNS)).first()
            hits = {x: n for x, n in sums.asDict().items() if n}
            kept = mix.redacted_rows(kept)
        kept = self.save("kept", kept)
        documents.write_json(self.spark, self.path("ledger.json"), ledger)
        return {
            "stopped_reason": ledger["stopped_reason"],
            "num_kept": kept.count(),
            "iterations": len(ledger["iterations"]),
            "redaction_hits": hits,
        }

    def _keyed(self) -> DataFrame:
        """The kept rows with the key and the order that mix and metrics need."""
        key = F.concat_ws("/", "sample_id", "chain_pos")
        return self.table("kept").withColumn("key", key).withColumn("ord", key)

    def _credentials(self) -> DataFrame:
        """Findings in all that the run has written: its text files by line, and its tables by row, as JSON."""
        found = credentials.scan_files(self.spark, self.workdir)
        for name in documents.names(self.spark, self.path("tables")):
            rows = self.table(name)
            texts = rows.select(F.lit(self.path("tables", name)).alias("path"), F.to_json(F.struct(*rows.columns)).alias("text"))
            found = found.unionByName(credentials.findings(texts).withColumn("line_no", F.lit(0).cast("long")))
        return found

    def run_package(self) -> dict:
        q, o = self.config.quality, self.config.output
        config = mix.MixConfig(
            mix.valid_frac_of(o.train_split),
            self.config.generation.seed,
            require_chain_valid=q.require_chain_valid,
            require_entities=q.require_entities,
        )
        rows, report = mix.assemble(self._keyed(), None, config)
        rows = self.save("mix", rows)
        for part in ("train", "valid"):
            sinks.write_jsonl(rows.where(F.col("split") == part).select("messages", "provenance"), self.path("sft_mix", part))
        self.found["mix"] = report
        found = [x.asDict() for x in self._credentials().orderBy("path", "line_no", "kind").limit(100).collect()]
        if found:
            raise RunFailed("credentials in the outputs: " + ", ".join(f"{x['kind']}@{x['path']}:{x['line_no']}" for x in found[:5]))
        return {"num_train": report["n_train"], "num_valid": report["n_valid"], "secret_scan_clean": True}

    def run_eval(self) -> dict:
        context, entities = self._context()
        found = metrics.evaluate(self._keyed(), entities, self.table("tool_edges"), graph.context_text(context))
        self.found["metrics"] = found
        o = self.config.output
        sinks.write_card(self.spark, self.found["mix"], found, self.path("DATASET_CARD.md"), o.dataset_name, o.version)
        return {"metrics": found}

    def run(self, resume: bool = False) -> dict:
        """All stages in their order. The report is written in any case; then a failure is raised again."""
        began, failed, error = time.monotonic(), None, None
        self.event("run", "started", {"resume": resume})
        for name in STAGES:
            try:
                self.stage(name, resume)
            except Exception as e:
                failed, error = name, e
                break
        stats = self.model.stats() if hasattr(self.model, "stats") else {"calls": 0}
        report = {
            "status": "failed" if failed else "ok", "failed_stage": failed, "run_name": self.config.name, "config": asdict(self.config), "config_fingerprint": fingerprint(
                self.config
            ),
            "duration_s": round(time.monotonic() - began, 1), "stages": self.summaries, "llm": stats, "eval": self.found.get("metrics"), "mix": self.found.get("mix"), "finished_at": now(),
        }
        documents.write_json(self.spark, self.path("run_report.json"), report)
        self.event("run", "finished", {"status": report["status"]})
        if error is not None:
            raise RunFailed(f"stage {failed} failed: {error}") from error
        return report
