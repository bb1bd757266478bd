"""Small documents on whatever file system Spark knows: written and read by the driver."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, system = _path(spark, path)
    return system.exists(at)


def write_text(spark: SparkSession, path: str, text: str, append: bool = False) -> str:
    """Writes a document; ``append`` adds to it, by writing it anew where the file system can't."""
    before = read_text(spark, path) if append and exists(spark, path) else ""
    at, system = _path(spark, path)
    out = system.create(at, True)
    out.write(bytearray((before + text).encode()))
    out.close()
    return path


def read_text(spark: SparkSession, path: str) -> str:
    at, system = _path(spark, path)
    stream = system.open(at)
    data = spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    stream.close()
    return bytes(data).decode()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; an error if there is none."""
    at, system = _path(spark, folder)
    return sorted(x.getPath().getName() for x in system.listStatus(at))


def write_json(spark: SparkSession, path: str, value: Any, sort_keys: bool = False) -> str:
    return write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2, sort_keys=sort_keys, default=str))


def read_json(spark: SparkSession, path: str) -> Any:
    return json.loads(read_text(spark, path))
