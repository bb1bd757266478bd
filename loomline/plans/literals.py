"""Small relations that the queries share with their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: event type, tool
EVENT_TOOLS = (
    ("view", "get_page"), ("click", "open_link"), ("signup", "create_account"), ("purchase", "submit_order"), ("error", "close_session")
)
#: src, dst, score
EDGES = (
    ("get_page", "open_link", 0.9), ("open_link", "get_page", 0.8), ("get_page", "create_account", 0.5), (
        "open_link", "create_account", 0.4
    ),
    ("create_account", "submit_order", 1.0), ("open_link", "submit_order", 0.35), ("submit_order", "get_page", 0.6), (
        "close_session", "get_page", 0.45
    ),
)
#: tool, parameter, type
PARAMS = (
    ("get_page", "page_id", "string"), ("get_page", "user_id", "integer"), ("open_link", "page_id", "string"), (
        "open_link", "link_path", "path"
    ),
    ("create_account", "user_id", "integer"), ("create_account", "customer_name", "string"), ("submit_order", "customer_name", "string"),
    ("submit_order", "orderIds", "array"), ("close_session", "user_id", "integer"), ("close_session", "status", "string"),
)
#: tool, position, output, type
OUTPUTS = (
    ("get_page", 0, "page_id", "string"), ("get_page", 1, "filePath", "path"), ("open_link", 0, "links_path", "path"), (
        "open_link", 1, "status", "string"
    ),
    ("create_account", 0, "customerName", "string"), ("create_account", 1, "user_ids", "array"), ("submit_order", 0, "order_id", "integer"), (
        "close_session", 0, "session", "object"
    ),
)


def relation(spark: SparkSession, rows: tuple, schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def values(rows: tuple) -> str:
    """The rows of a VALUES list."""
    cell = lambda x: "'" + x.replace("'", "''") + "'" if isinstance(x, str) else "NULL" if x is None else str(x)
    return ", ".join("(" + ", ".join(map(cell, row)) + ")" for row in rows)
