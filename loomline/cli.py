"""python -m loomline.cli init | validate-config | run | report; 0 if it went well, else 1."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

import yaml

from loomline.errors import ConfigError, LoomlineError
from loomline.plans import config as configs


def load(path: str) -> configs.RunConfig:
    text = Path(path).read_text(encoding="utf-8")
    raw = json.loads(text) if path.endswith(".json") else yaml.safe_load(text)
    if not isinstance(raw, dict):
        raise ConfigError(["the root must be a mapping"])
    return configs.from_dict(raw)


def init(args: argparse.Namespace) -> int:
    Path(args.output).write_text(configs.example(args.name), encoding="utf-8")
    print(f"wrote {args.output}")
    return 0


def validate_config(args: argparse.Namespace) -> int:
    config = load(args.config)
    print(
        f"config OK: {config.name}; catalogs: {', '.join(x.name for x in config.catalogs)}; kg_source: {config.domain.kg_source}; output: {config.output.dir}"
    )
    return 0


def run(args: argparse.Namespace) -> int:
    from loomline.plans.factory import FactoryRun
    from loomline.session import local_session

    config = load(args.config)
    report = FactoryRun(local_session(), config).run(args.resume)
    print(f"run {report['status']}: {config.output.dir}/run_report.json")
    return 0


def report(args: argparse.Namespace) -> int:
    found = json.loads((Path(args.run_dir) / "run_report.json").read_text(encoding="utf-8"))
    print(f"run: {found['run_name']}  status: {found['status']}  duration: {found['duration_s']} s")
    for stage, summary in found["stages"].items():
        print(f"  {stage:10} {summary['status']:6} {summary['duration_s']} s {summary.get('error', '')}")
    for key in ("llm", "eval", "mix"):
        print(f"{key}: {found[key]}")
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="loomline")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, does, arguments in (
        ("init", init, [("--name", {"default": "my-domain"}), ("--output", {"default": "run.yaml"})]),
        ("validate-config", validate_config, [("config", {})]),
        ("run", run, [("--config", {"required": True}), ("--resume", {"action": "store_true"})]),
        ("report", report, [("--run-dir", {"required": True})]),
    ):
        command = commands.add_parser(name)
        command.set_defaults(does=does)
        for flag, how in arguments:
            command.add_argument(flag, **how)
    args = parser.parse_args(argv)
    try:
        return args.does(args)
    except (LoomlineError, OSError, ValueError) as e:
        print(f"{args.command} failed: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
