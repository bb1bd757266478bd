"""Queries that profile and probe tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators import probe
from loomline.session import cut, table

#: The columns of the profiled tables, all of them, and those that are not numbers.
PROFILED = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ],
}
CATEGORIES = ("o_orderstatus", "o_orderdate", "o_orderpriority", "c_name", "c_mktsegment", "p_name", "p_brand", "p_type", "l_returnflag", "l_linestatus", "l_shipdate")


def _profile(name: str, columns: list[str]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = probe.profile(table(spark, sf_dir, name), columns)
        shown = F.array_join(F.transform("top_values", lambda x: F.concat_ws(":", x["value"], x["count"].cast("string"))), ",")
        return found.select(
            "pos",
            "name",
            "type",
            "cardinality",
            "missing_frac",
            "min",
            "max",
            F.round("mean", 2).alias("mean"),
            F.coalesce(shown, F.lit("")).alias("top_values"),
        )

    query.__name__ = f"column_profile_{name}"
    return query


def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent values of all columns that are not numbers."""
    found = probe.profile(table(spark, sf_dir, "orders"))
    return found.select("name", F.posexplode("top_values").alias("place", "x")).select("name", "place", "x.value", "x.count")


def auto_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probe.auto_targets(probe.profile(table(spark, sf_dir, "part")), most=30).select("pos", "name", "cardinality")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a segment of price, which predicts nothing, and a class that follows from the status for most."""
    segment = F.floor(F.col("o_totalprice") / 50000).cast("string")
    grade = F.when(F.col("o_orderkey") % 7 == 0, "other").otherwise(F.concat(F.lit("grade-"), "o_orderstatus"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", segment.alias("segment"), grade.alias("grade")
    )


def majority_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probe.majority_baseline(_orders(spark, sf_dir), "o_orderpriority")


def memorising_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds = probe.split_rows(_orders(spark, sf_dir), "o_orderkey")
    estimator = probe.MajorityByKey("o_orderstatus").fit(probe.training(folds), "grade")
    predicted = estimator.predict(probe.testing(folds))
    return predicted.agg(
        F.count("*").alias("n_test"), F.round(F.avg((F.col("grade") == F.col("predicted")).cast("double")), 4).alias("score")
    )


def permutation_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = probe.probe_target(
        _orders(spark, sf_dir), "o_orderkey", "grade", ["o_orderstatus", "segment"], probe.MajorityByKey("o_orderstatus")
    )
    return spark.createDataFrame(
        [
            (x["feature"], float(x["importance"]), float(found["holdout_score"]), float(found["baseline_score"])) for x in found[
                "importances"
            ]
        ],
        "feature string, importance double, holdout_score double, baseline_score double",
    )


def tstr_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic rows are those of odd keys with their status moved on by one."""
    orders = _orders(spark, sf_dir)
    moved = F.translate("o_orderstatus", "FOP", "FPO")
    found = probe.parity(
        orders,
        orders.where("o_orderkey % 2 = 1").withColumn("grade", F.concat(F.lit("grade-"), moved)),
        "o_orderkey",
        "grade",
        "o_orderstatus",
    )
    return spark.createDataFrame(
        [(float(found["real_score"]), float(found["synth_trained_score"]), float(found["parity"]))],
        "real_score double, synth_trained_score double, parity double",
    )


def encoded_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments and balances of all customers as numbers, by an encoder that saw those of even keys but machinery."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    seen = customers.where("c_custkey % 2 = 0 and c_mktsegment <> 'MACHINERY'")
    found = probe.Encoder(["c_mktsegment", "c_acctbal"]).fit(seen).transform(customers)
    return found.select("c_custkey", F.get("_features", F.lit(0)).alias("segment"), F.get("_features", F.lit(1)).alias("balance"))


def tree_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holdout score of a decision tree on orders."""
    folds = cut(probe.split_rows(_orders(spark, sf_dir), "o_orderkey"))
    tree = probe.TreeEstimator(["o_orderstatus", "segment"]).fit(probe.training(folds), "grade")
    return probe.score(tree.predict(probe.testing(folds)), "grade")


QUERIES = {f"column_profile_{name}": _profile(name, columns) for name, columns in PROFILED.items()} | {
    f.__name__: f for f in (top_values, auto_targets, majority_baseline, memorising_probe, permutation_importance, tstr_parity, encoded_features, tree_probe)
}


def _profile_sql(name: str, columns: list[str]) -> str:
    parts = []
    for k, c in enumerate(columns):
        text = c in CATEGORIES
        value = f"nullif(trim(CAST({c} AS VARCHAR)), '')" if text else c
        top = f"(SELECT string_agg(v || ':' || n, ',' ORDER BY n DESC, v) FROM (SELECT {value} AS v, count(*) AS n FROM {name} WHERE {value} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 5))" if text else "''"
        low, high, mean = ("CAST(NULL AS DOUBLE)",) * 3 if text else (
            f"CAST(min({c}) AS DOUBLE)", f"CAST(max({c}) AS DOUBLE)", f"round(avg({c}), 2)"
        )
        parts.append(
            f"SELECT {k} AS pos, '{c}' AS name, '{'categorical' if text else 'numeric'}' AS type, count(DISTINCT {value}) AS cardinality, round(1 - count({value}) / CAST(count(*) AS DOUBLE), 4) AS missing_frac, {low} AS min, {high} AS max, {mean} AS mean, {top} AS top_values FROM {name}"
        )
    return " UNION ALL ".join(parts)


_ORDERS_SQL = """o AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(CAST(floor(o_totalprice / 50000) AS BIGINT) AS VARCHAR) AS segment,
  CASE WHEN o_orderkey % 7 = 0 THEN 'other' ELSE 'grade-' || o_orderstatus END AS grade FROM orders),
ranked AS (SELECT *, row_number() OVER (ORDER BY md5(o_orderkey || ':42'), o_orderkey) AS r, count(*) OVER () AS n FROM o),
folds AS (SELECT *, CASE WHEN r <= greatest(1, floor(0.8::DOUBLE * n)) THEN 'train' ELSE 'test' END AS fold FROM ranked)"""
_FIT_SQL = """c AS (SELECT o_orderstatus AS v, grade AS t, count(*) AS k FROM {0} GROUP BY 1, 2), best AS (SELECT v, arg_min(t, (-k, t)) AS p FROM c GROUP BY v),
whole AS (SELECT arg_min(t, (-k, t)) AS p FROM (SELECT t, sum(k) AS k FROM c GROUP BY t))"""
_TRAIN = "(SELECT * FROM folds WHERE fold = 'train')"

ORACLE_SQL = {f"column_profile_{name}": _profile_sql(name, columns) for name, columns in PROFILED.items()} | {
    "top_values": " UNION ALL ".join(
        f"(SELECT '{c}' AS name, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 AS INTEGER) AS place, CAST({c} AS VARCHAR) AS value, count(*) AS count FROM orders WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY place LIMIT 5)"
        for c in PROFILED["orders"]
        if c in CATEGORIES
    ),
    "auto_targets": "SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT {k} AS pos, '{c}' AS name, count(DISTINCT {c}) AS cardinality FROM part" for k, c in enumerate(PROFILED["part"]) if c in CATEGORIES)
    + ") WHERE cardinality BETWEEN 2 AND 30",
    "majority_baseline": "SELECT round(max(n) / CAST(sum(n) AS DOUBLE), 4) AS baseline FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderpriority)",
    "memorising_probe": f"WITH {_ORDERS_SQL}, {_FIT_SQL.format(_TRAIN)} SELECT count(*) AS n_test, round(avg(CAST(grade = coalesce(best.p, whole.p) AS INTEGER)), 4) AS score FROM folds CROSS JOIN whole LEFT JOIN best ON o_orderstatus = best.v WHERE fold = 'test'",
    "permutation_importance": f"""WITH {_ORDERS_SQL}, {_FIT_SQL.format(_TRAIN)}, t AS (SELECT * FROM folds WHERE fold = 'test'),
      a AS (SELECT *, row_number() OVER (ORDER BY md5(o_orderkey || ':43'), o_orderkey) AS x, row_number() OVER (ORDER BY md5(o_orderkey || ':44'), o_orderkey) AS y FROM t),
      m AS (SELECT a.o_orderkey, a.grade, a.o_orderstatus, b.o_orderstatus AS moved FROM a JOIN a b ON a.x = b.y),
      s AS (SELECT round(avg(CAST(grade = coalesce(u.p, whole.p) AS INTEGER)), 4) AS base, round(avg(CAST(grade = coalesce(w.p, whole.p) AS INTEGER)), 4) AS dropped FROM m CROSS JOIN whole LEFT JOIN best u ON o_orderstatus = u.v LEFT JOIN best w ON moved = w.v),
      g AS (SELECT round(max(n) / CAST(sum(n) AS DOUBLE), 4) AS baseline FROM (SELECT count(*) AS n FROM t GROUP BY grade))
      SELECT 'o_orderstatus' AS feature, round(base - dropped, 4) AS importance, base AS holdout_score, baseline AS baseline_score FROM s, g UNION ALL SELECT 'segment', 0.0, base, baseline FROM s, g""",
    "encoded_features": """WITH seen AS (SELECT * FROM customer WHERE c_custkey % 2 = 0 AND c_mktsegment <> 'MACHINERY'),
      codes AS (SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS DOUBLE) AS code FROM seen GROUP BY 1)
      SELECT c_custkey, coalesce(code, -1.0::DOUBLE) AS segment, c_acctbal AS balance FROM customer LEFT JOIN codes USING (c_mktsegment)""",
    "tstr_parity": f"""WITH {_ORDERS_SQL}, {_FIT_SQL.format(_TRAIN)}, synth AS (SELECT o_orderstatus, 'grade-' || translate(o_orderstatus, 'FOP', 'FPO') AS grade FROM o WHERE o_orderkey % 2 = 1),
      c2 AS (SELECT o_orderstatus AS v, grade AS t, count(*) AS k FROM synth GROUP BY 1, 2), best2 AS (SELECT v, arg_min(t, (-k, t)) AS p FROM c2 GROUP BY v),
      s AS (SELECT round(avg(CAST(grade = best.p AS INTEGER)), 4) AS real_score, round(avg(CAST(grade = best2.p AS INTEGER)), 4) AS synth_trained_score FROM folds LEFT JOIN best ON o_orderstatus = best.v LEFT JOIN best2 ON o_orderstatus = best2.v WHERE fold = 'test')
      SELECT *, round(synth_trained_score / real_score, 4) AS parity FROM s""",
}
