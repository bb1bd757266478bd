"""The configuration of a run: sections, their defaults, and every problem at once."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field, fields, is_dataclass
from typing import Any, get_type_hints

from loomline.errors import ConfigError


@dataclass
class Catalog:
    """A list of tools: a JSON file, or a server that a connector of the caller's asks."""

    name: str = ""
    transport: str = "file"  # file, stdio or sse
    path: str = ""
    command: str = ""
    url: str = ""
    timeout_s: float = 120.0
    retries: int = 2


@dataclass
class Domain:
    name: str = "default"
    kg_source: str = "tools"  # tools, corpus, spec or tables
    corpus_dir: str = ""
    spec_file: str = ""
    tables_dir: str = ""
    table_targets: dict = field(default_factory=dict)
    table_keys: dict = field(default_factory=dict)
    max_entities: int = 200


@dataclass
class Generation:
    num_chains: int = 10
    apis_per_workflow: int = 5
    seed: int = 42
    min_samples: int = 1
    max_llm_calls: int = 0
    output_hints: dict = field(default_factory=dict)
    samples_dir: str = ""


@dataclass
class Model:
    max_retries: int = 4
    backoff_s: float = 1.0
    timeout_s: float = 120.0
    max_rpm: float = 0.0
    budget_usd: float = 0.0
    price_per_1m_input: float = 0.0
    price_per_1m_output: float = 0.0


@dataclass
class Quality:
    min_coverage: float = 0.5
    require_chain_valid: bool = True
    require_entities: bool = True
    max_iterations: int = 3
    semantic_filter: bool = False
    decision_threshold: float = 0.5
    pii_redact: bool = True


@dataclass
class Output:
    dir: str = "outputs"
    dataset_name: str = "synthetic-tool-use"
    version: str = "0.1.0"
    train_split: float = 0.9


@dataclass
class RunConfig:
    name: str = "run"
    catalogs: list[Catalog] = field(default_factory=list)
    domain: Domain = field(default_factory=Domain)
    generation: Generation = field(default_factory=Generation)
    llm: Model = field(default_factory=Model)
    quality: Quality = field(default_factory=Quality)
    output: Output = field(default_factory=Output)


def _value(kind: type, value: Any, at: str) -> Any:
    """A field's value in its type. Booleans must be real ones; whole numbers pass as floats."""
    if kind is bool:
        if not isinstance(value, bool):
            raise ConfigError([f"{at} must be true or false"])
        return value
    if kind in (int, float):
        try:
            return kind(value)
        except (TypeError, ValueError):
            raise ConfigError([f"{at} must be a number"]) from None
    if kind is dict:
        if not isinstance(value or {}, dict):
            raise ConfigError([f"{at} must be a mapping"])
        return value or {}
    return str(value)


def _section(kind: type, raw: Any, at: str) -> Any:
    if not isinstance(raw, dict):
        raise ConfigError([f"{at} must be a mapping"])
    hints = get_type_hints(kind)
    given = {}
    for f in fields(kind):
        if f.name not in raw:
            continue
        where = f"{at}.{f.name}".lstrip(".")
        if is_dataclass(hints[f.name]):
            given[f.name] = _section(hints[f.name], raw[f.name], where)
        elif f.name == "catalogs":
            if not isinstance(raw[f.name] or [], list):
                raise ConfigError([f"{where} must be a list"])
            given[f.name] = [
                _section(Catalog, {"name": f"catalog-{k}"} | x if isinstance(x, dict) else x, f"{where}[{k}]") for k, x in enumerate(
                    raw[f.name] or []
                )
            ]
        else:
            given[f.name] = _value(hints[f.name], raw[f.name], where)
    return kind(**given)


def from_dict(raw: dict) -> RunConfig:
    """A checked configuration; an error lists every problem."""
    config = _section(RunConfig, raw, "")
    if problems := validate(config):
        raise ConfigError(problems)
    return config


def validate(c: RunConfig) -> list[str]:
    """All that is wrong with a configuration."""
    found: list[str] = []
    need = lambda good, text: None if good else found.append(text)
    need(c.catalogs, "catalogs: at least one is required")
    known: set[str] = set()
    for k, x in enumerate(c.catalogs):
        at = f"catalogs[{k}] ({x.name})"
        need(x.name not in known, f"{at}: duplicate name")
        known.add(x.name)
        need(x.transport in ("file", "stdio", "sse"), f"{at}: transport must be file, stdio or sse")
        need(x.transport != "file" or x.path, f"{at}: file needs a path")
        need(x.transport != "stdio" or x.command, f"{at}: stdio needs a command")
        need(x.transport != "sse" or x.url, f"{at}: sse needs a url")
        need(x.timeout_s > 0, f"{at}: timeout_s must be > 0")
        need(x.retries >= 0, f"{at}: retries must be >= 0")
    d, g, m, q = c.domain, c.generation, c.llm, c.quality
    need(d.kg_source in ("tools", "corpus", "spec", "tables"), "domain.kg_source must be tools, corpus, spec or tables")
    for source, key in (("corpus", "corpus_dir"), ("spec", "spec_file"), ("tables", "tables_dir")):
        need(d.kg_source != source or getattr(d, key), f"domain.{key} is required for kg_source {source}")
    need(d.max_entities >= 1, "domain.max_entities must be >= 1")
    need(g.num_chains >= 1, "generation.num_chains must be >= 1")
    need(g.apis_per_workflow >= 1, "generation.apis_per_workflow must be >= 1")
    need(g.min_samples >= 0, "generation.min_samples must be >= 0")
    need(g.min_samples <= g.num_chains, "generation.min_samples must be <= generation.num_chains")
    need(g.max_llm_calls >= 0, "generation.max_llm_calls must be >= 0")
    need(m.max_retries >= 0, "llm.max_retries must be >= 0")
    need(m.timeout_s > 0, "llm.timeout_s must be > 0")
    need(m.budget_usd >= 0, "llm.budget_usd must be >= 0")
    need(0 <= q.min_coverage <= 1, "quality.min_coverage must be in [0, 1]")
    need(q.max_iterations >= 1, "quality.max_iterations must be >= 1")
    need(0 <= q.decision_threshold <= 1, "quality.decision_threshold must be in [0, 1]")
    need(0 <= c.output.train_split < 1, "output.train_split must be in [0, 1)")
    return found


def fingerprint(config: RunConfig) -> str:
    """Sixteen hexadecimal digits of a configuration's canonical JSON."""
    return hashlib.sha256(json.dumps(asdict(config), sort_keys=True).encode()).hexdigest()[:16]


def example(name: str) -> str:
    """A configuration to start from, as YAML."""
    return f"""name: {name}
catalogs:
  - name: tools
    path: catalog.json        # a JSON list of name, description and input_schema
domain:
  kg_source: tools            # tools, corpus, spec or tables
  max_entities: 200
generation:
  samples_dir: samples        # workflow samples, one JSON document in each file
  num_chains: 10
  seed: 42
quality:
  min_coverage: 0.5
  max_iterations: 3
  pii_redact: true
output:
  dir: outputs/{name}
  dataset_name: {name}
  train_split: 0.9
"""
