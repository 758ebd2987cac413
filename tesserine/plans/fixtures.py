"""Study frames over the given tables. Each is one SQL text that Spark and DuckDB both evaluate, so a query and its
DuckDB statement share their input."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tesserine.operators.ordered import dealt

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "labels")

_LABEL = "CASE WHEN c_acctbal >= 4500 THEN 1 ELSE 0 END"
_SEGMENT = "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 WHEN 'MACHINERY' THEN 4 ELSE -1 END"
_HASH = "CAST((o_orderkey * 7919 + inner_fold * 104729) % 1009 AS DOUBLE) / 1009"
_WEIGHT = "(CAST((o_orderkey * {m} + inner_fold * 7) % 101 AS DOUBLE) + 1 + CASE WHEN seg = {k} THEN 40e0 ELSE 0e0 END)"
_WEIGHTS = [_WEIGHT.format(m=31 * (k + 3), k=k) for k in range(5)]
_INNER = "(VALUES (0), (1), (2)) AS i(inner_fold)"

FIXTURES: dict[str, str | dict[str, str]] = {
    "patients": "SELECT CAST(c_custkey AS STRING) AS patient_id, c_custkey, c_acctbal, c_mktsegment, CAST(c_nationkey AS INT) AS c_nationkey FROM customer",
    "slides": "SELECT o_orderkey AS slide_id, CAST(o_custkey AS STRING) AS patient_id, concat('/data/', CAST(o_orderkey AS STRING), '.svs') AS image_path, o_orderpriority, o_totalprice FROM orders",
    # tiles are numbered by their columns, as line numbers repeat
    "tiles": """SELECT slide_id, CAST(row_number() OVER (PARTITION BY slide_id ORDER BY tile, x, y, logit) AS INT) AS tile_idx, x, y, logit, label FROM
        (SELECT l_orderkey AS slide_id, l_linenumber AS tile, l_partkey % 64 AS x, l_suppkey % 64 AS y, (CAST(l_quantity AS DOUBLE) - 25) / 10 + CAST(l_discount AS DOUBLE) * 10 - 0.5e0 AS logit,
                CAST(CASE WHEN l_orderkey % 10 = 0 THEN -1 WHEN l_orderkey * 7 % 10 < 4 THEN 1 ELSE 0 END AS INT) AS label FROM lineitem)""",
    "preds": f"""SELECT 'er' AS field, CAST(o_custkey % 5 AS INT) AS outer_fold, inner_fold, o_orderkey AS slide_id, CAST(o_custkey AS STRING) AS patient_id,
        {_HASH} * 6e-1 + CASE WHEN c_acctbal >= 4500 THEN 3e-1 ELSE 1e-1 END AS prob, CAST({_LABEL} AS INT) AS label
        FROM orders JOIN customer ON o_custkey = c_custkey CROSS JOIN {_INNER}""",
    "multi": f"""SELECT field, outer_fold, inner_fold, slide_id, patient_id, label, ARR(w0 / t, w1 / t, w2 / t, w3 / t, w4 / t) AS probs FROM
        (SELECT *, w0 + w1 + w2 + w3 + w4 AS t FROM
            (SELECT 'segment' AS field, CAST(o_custkey % 5 AS INT) AS outer_fold, inner_fold, o_orderkey AS slide_id, CAST(o_custkey AS STRING) AS patient_id, CAST(seg AS INT) AS label,
                    {", ".join(f"{w} AS w{k}" for k, w in enumerate(_WEIGHTS))}
             FROM orders JOIN (SELECT c_custkey, {_SEGMENT} AS seg FROM customer) ON o_custkey = c_custkey CROSS JOIN {_INNER}))""",
    "reg": f"""SELECT 'balance' AS field, CAST(o_custkey % 5 AS INT) AS outer_fold, inner_fold, o_orderkey AS slide_id, CAST(o_custkey AS STRING) AS patient_id,
        CAST(c_acctbal AS DOUBLE) * 5e-1 + {_HASH} * 2000 AS pred, CAST(c_acctbal AS DOUBLE) AS label
        FROM orders JOIN customer ON o_custkey = c_custkey CROSS JOIN {_INNER}""",
    "surv": """SELECT 'os' AS field, CAST(c_custkey % 5 AS INT) AS outer_fold, CAST(c_custkey AS STRING) AS patient_id, floor((CAST(c_acctbal AS DOUBLE) + 1000) / 10) AS time,
        CAST(CASE WHEN c_nationkey % 3 = 0 THEN 1 ELSE 0 END AS INT) AS event,
        CAST(c_custkey * 7919 % 1009 AS DOUBLE) / 1009 - floor((CAST(c_acctbal AS DOUBLE) + 1000) / 10) / 2000 AS risk FROM customer""",
    "follow": """SELECT l_orderkey AS slide_id, CAST(o_custkey AS STRING) AS patient_id, CAST(DAYS(l_shipdate, o_orderdate) AS DOUBLE) AS time,
        CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INT) AS event FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "bins": """SELECT o_orderkey AS slide_id, CAST(o_custkey AS STRING) AS patient_id, CAST(o_custkey % 5 AS INT) AS outer_fold, inner_fold,
        ARR(CAST(o_orderkey % 7 AS DOUBLE) / 2 - 3, CAST(o_orderkey % 11 AS DOUBLE) / 3 - 3, CAST(o_orderkey % 13 AS DOUBLE) / 4 - 2, CAST(inner_fold AS DOUBLE) - 1) AS logits,
        ARR(100e0 + inner_fold * 10, 300e0, 600e0) AS time_edges, CAST(o_orderkey % 900 AS DOUBLE) + 1 AS time, CAST(o_orderkey % 2 AS INT) AS event
        FROM orders CROSS JOIN (VALUES (0), (1)) AS i(inner_fold)""",
    "matrix": {
        "spark": "SELECT CAST(vec_id AS STRING) AS patient_id, CAST(pos AS STRING) AS gene_id, pos, abs(CAST(v AS DOUBLE)) * 10 AS value FROM embeddings LATERAL VIEW posexplode(embedding) e AS pos, v",
        "duckdb": "SELECT CAST(vec_id AS VARCHAR) AS patient_id, CAST(pos AS VARCHAR) AS gene_id, pos, abs(CAST(v AS DOUBLE)) * 10 AS value FROM (SELECT vec_id, unnest(range(len(embedding))) AS pos, unnest(embedding) AS v FROM embeddings)",
    },
    "genes": """SELECT gene_id, patient_id, value AS label, value * 5e-1 + CAST((CAST(patient_id AS INT) * 31 + pos * 17) % 101 AS DOUBLE) / 40 AS pred,
        CAST((CAST(patient_id AS INT) * 53 + pos * 29) % 103 AS DOUBLE) / 40 AS base FROM matrix""",
    "attention": """SELECT CAST(slide_id % 5 AS INT) AS outer_fold, inner_fold, slide_id, tile_idx, x, y, logit + CAST((tile_idx * 37 + inner_fold * 17 + slide_id) % 23 AS DOUBLE) / 10 AS logit
        FROM tiles CROSS JOIN (VALUES (0), (1)) AS i(inner_fold)""",
    "trials": """SELECT event_type AS arm, 'er' AS field, CAST(user_id % 30 AS INT) AS seed, CAST(event_id % 3 AS INT) AS rep, avg(CAST(value AS DOUBLE)) AS metric, 'auroc' AS metric_key,
        CAST(count(*) + 2 AS INT) AS n_declared, CAST(count(*) AS INT) AS n_test, md5(CAST(user_id % 30 AS STRING)) AS split_hash, min(event_id) AS train_seed
        FROM events GROUP BY event_type, user_id % 30, event_id % 3""",
    "arms": """SELECT arm, 'er' AS field, CAST(c_custkey % 5 AS INT) AS outer_fold, CAST(c_custkey AS STRING) AS patient_id, CAST(CASE WHEN c_acctbal >= 4500 THEN 1 ELSE 0 END AS INT) AS label,
        CAST((c_custkey * (7919 + 2 * n)) % 1009 AS DOUBLE) / 1009 * 6e-1 + CASE WHEN c_acctbal >= 4500 THEN n * 1e-1 ELSE 0e0 END AS prob
        FROM customer CROSS JOIN (VALUES ('base', 1), ('deep', 2), ('wide', 3)) AS a(arm, n) WHERE NOT (arm = 'deep' AND c_custkey % 17 = 0)""",
    "strata": "SELECT 'er' AS field, CAST(c_custkey AS STRING) AS patient_id, CAST(CASE WHEN c_acctbal >= 4500 THEN 1 ELSE 0 END AS INT) AS stratum FROM customer",
    "geometry": "SELECT o_orderkey AS slide_id, CAST(CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE 500 + o_orderkey % 2000 END AS INT) AS width, CAST(400 + o_orderkey % 1500 AS INT) AS height, CASE WHEN o_orderkey % 3 = 0 THEN concat('m/', CAST(o_orderkey AS STRING), '.png') END AS mask_path FROM orders",
    "sheet": """SELECT CAST(c_custkey AS STRING) AS patient_id, CASE WHEN c_custkey % 11 = 0 THEN ' nan ' WHEN c_custkey % 13 = 0 THEN 'n.d.' ELSE CAST(c_acctbal AS STRING) END AS ki67,
        CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END AS segment FROM customer""",
}
#: Tables whose rows a fixture's window takes by a key: they are dealt by it into as many partitions as their rows need.
_DEALT = {"tiles": ("lineitem", "l_orderkey"), "attention": ("lineitem", "l_orderkey")}
_USES = {"genes": ("matrix",), "attention": ("tiles",)}


def _render(text: str, dialect: str) -> str:
    days = r"datediff(\1, \2)" if dialect == "spark" else r"date_diff('day', CAST(\2 AS DATE), CAST(\1 AS DATE))"
    return re.sub(r"DAYS\(([^,]+), ([^)]+)\)", days, text.replace("ARR(", "array(" if dialect == "spark" else "list_value("))


def text_of(name: str, dialect: str) -> str:
    f = FIXTURES[name]
    return _render(f[dialect] if isinstance(f, dict) else f, dialect)


def ctes(names: str, dialect: str = "duckdb") -> str:
    """The WITH list of fixtures, with those that they use."""
    need: list[str] = []
    for n in names.split():
        for x in (*_USES.get(n, ()), n):
            if x not in need:
                need.append(x)
    return ", ".join(f"{n} AS ({text_of(n, dialect)})" for n in need)


class Frames:
    """The fixtures and given tables of one folder, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def by_slide(self, name: str) -> DataFrame:
        """A fixture of three rows an order, dealt by slide into as many partitions as its rows need."""
        return dealt(getattr(self, name), 3 * self.orders.count(), ["slide_id"])

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        if name not in FIXTURES:
            raise AttributeError(name)
        text = ctes(name, "spark")
        used = {t: self.table(t) for t in TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", text)}
        if name in _DEALT:
            t, key = _DEALT[name]
            used[t] = dealt(used[t], used[t].count(), [key])
        marked = re.sub(r"\b(FROM|JOIN) (\w+)\b", lambda m: f"{m[1]} {{{m[2]}}}" if m[2] in used else m[0], text)
        return self.spark.sql(f"WITH {marked} SELECT * FROM {name}", **used)
