"""Writers: JSON lines, graphs, tables of findings and the card of a data set."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators.probe import findings_markdown
from loomline.sources.documents import write_json, write_text


def write_jsonl(rows: DataFrame, folder: str) -> str:
    """One JSON object per row, null fields kept; a folder of part files, each task writing its own."""
    rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(folder)
    return folder


def write_tool_graph(nodes: DataFrame, edges: DataFrame, path: str) -> str:
    """A composability graph as GraphML or node-link JSON, by the ending. Catalogs are small, so the driver writes it."""
    spark = nodes.sparkSession
    tools = [x.asDict() for x in nodes.select("tool", "description").orderBy("tool").collect()]
    links = [x.asDict() for x in edges.select("src", "dst", "relation", "score", "via").orderBy("src", "dst").collect()]
    if path.endswith(".json"):
        value = {
            "directed": True,
            "multigraph": False,
            "graph": {},
            "nodes": [{"id": x["tool"], "description": x["description"]} for x in tools],
            "links": [{"source": x.pop("src"), "target": x.pop("dst"), **x} for x in links],
        }
        return write_json(spark, path, value)
    if not path.endswith(".graphml"):
        raise ValueError(f"neither .graphml nor .json: {path}")
    keys = [
        ("d0", "node", "description", "string"),
        ("d1", "edge", "relation", "string"),
        ("d2", "edge", "score", "double"),
        ("d3", "edge", "via", "string"),
    ]
    data = lambda key, value: f'<data key="{key}">{escape(str(value))}</data>' if value is not None else ""
    quoted = lambda x: escape(x, {'"': "&quot;"})
    lines = ['<?xml version="1.0" encoding="utf-8"?>', '<graphml xmlns="http://graphml.graphdrawing.org/xmlns">']
    lines += [f'<key id="{k}" for="{of}" attr.name="{name}" attr.type="{kind}"/>' for k, of, name, kind in keys]
    lines += ['<graph edgedefault="directed">']
    lines += [f'<node id="{quoted(x["tool"])}">{data("d0", x["description"])}</node>' for x in tools]
    lines += [
        f'<edge source="{quoted(x["src"])}" target="{quoted(x["dst"])}">{data("d1", x["relation"])}{data("d2", x["score"])}{data("d3", x["via"])}</edge>' for x in links
    ]
    return write_text(spark, path, "\n".join([*lines, "</graph>", "</graphml>"]) + "\n")


def write_findings(spark: SparkSession, findings: Mapping, folder: str, model: Callable[[str], str] | None = None) -> list[str]:
    """A document for each table, its retelling by a text model if there is one, and findings.json."""
    written = []
    for table in findings["tables"]:
        text = findings_markdown(table)
        written.append(write_text(spark, f"{folder}/{table['table']}.md", text))
        if model is not None:
            told = model(f"Retell these findings about a table as a short brief. Use only what they say.\n\n{text}")
            written.append(write_text(spark, f"{folder}/{table['table']}_narrative.md", told))
    return [*written, write_json(spark, f"{folder}/findings.json", findings)]


def write_card(spark: SparkSession, report: Mapping, metrics: Mapping, path: str, name: str = "data set", version: str = "") -> str:
    """The card of a data set: sizes, sources and metrics as Markdown."""
    shown = lambda x: "not measured" if x is None else f"{x:.3f}" if isinstance(x, float) else str(x)
    lines = [f"# {name} {version}".rstrip(), "", "## Rows", "", "| | |", "|-|-|"]
    lines += [f"| {key} | {shown(value)} |" for key, value in report.items() if not isinstance(value, (dict, list))]
    lines += ["", "## Sources", "", *(f"- {source}: {n}" for source, n in sorted((report.get("sources") or {}).items()))]
    lines += ["", "## Metrics", "", "| | |", "|-|-|"]
    lines += [f"| {key} | {shown(value)} |" for key, value in metrics.items() if not isinstance(value, (dict, list))]
    lines += ["", "## Limits", "", "These figures describe the data alone; they don't say whether training on it helps a model.", ""]
    return write_text(spark, path, "\n".join(lines))
