"""Registration of queries, and derived inputs that both engines build from the driver's tables.

``Tables`` reads a table or runs SQL that names tables in braces. Derived inputs are SQL that both
dialects take, so a query and its SQL start from the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


#: Line items by order and line, which the table repeats.
LINES = """
SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey, min(l_quantity) AS l_quantity, min(l_extendedprice) AS l_extendedprice,
       min(l_discount) AS l_discount, min(l_tax) AS l_tax, min(l_returnflag) AS l_returnflag, min(l_linestatus) AS l_linestatus, min(l_shipdate) AS l_shipdate
FROM {lineitem} GROUP BY l_orderkey, l_linenumber
"""


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        ship(spark)
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        if name == "lines":
            return self.sql(LINES)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        text = text.replace("{lines}", f"({LINES}) lines")
        return self.spark.sql(text, **{n: self(n) for n in set(re.findall(r"\{(\w+)\}", text))})


def plain(text: str) -> str:
    """SQL with table names instead of braces."""
    return re.sub(r"\{(\w+)\}", r"\1", text.replace("{lines}", f"({LINES}) lines"))


def query(name: str, sql: str | None = None):
    """Decorator: registers a function of ``Tables``, and the equivalent SQL if there is one."""

    def add(function: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = lambda spark, sf_dir: function(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = plain(sql)
        return function

    return add


#: Boxes: an order is a document, its lines are boxes of one page.
BOXES = """
SELECT CAST(l_orderkey AS VARCHAR(20)) AS doc, CAST(l_orderkey % 7 + 1 AS INT) AS page, CAST(l_linenumber AS INT) AS pos,
       CASE WHEN l_returnflag = 'A' THEN 'text' WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'paragraph_title'
            WHEN l_partkey % 3 = 0 THEN 'image' WHEN l_partkey % 3 = 1 THEN 'figure_title' ELSE 'footer' END AS label,
       concat('t', CAST(l_partkey % 5 AS VARCHAR(5))) AS text,
       CAST(l_partkey % 600 AS DOUBLE) AS x0, CAST(l_suppkey * 37 % 900 AS DOUBLE) AS y0,
       CAST(l_partkey % 600 + l_quantity * 9 AS DOUBLE) AS x1, CAST(l_suppkey * 37 % 900 + 15 + l_quantity * 19 AS DOUBLE) AS y1
FROM {lines}
"""

#: Segments: a user is an audio file, an event a segment of 0 to some seconds.
SEGMENTS = """
SELECT CAST(user_id AS VARCHAR(20)) AS audio, CAST(event_id AS DOUBLE) AS start_s, CAST(event_id + 1 + event_id % 50 AS DOUBLE) AS end_s,
       event_type AS speaker, concat('w', CAST(event_id % 11 AS VARCHAR(5))) AS text, CAST(event_id AS BIGINT) AS event_id
FROM {events}
"""

#: Requests with latencies, from line items. Start times are distinct.
REQUESTS = """
SELECT l_orderkey * 10 + l_linenumber AS req, l_shipdate AS ts, CAST(l_orderkey % 50 AS INT) AS model,
       CAST(l_orderkey + l_linenumber / 8.0 AS DOUBLE) AS start_time, CAST(l_discount AS DOUBLE) AS ttft,
       CAST(l_discount + l_tax * l_quantity AS DOUBLE) AS latency, CAST(l_partkey % 300 + 1 AS INT) AS prompt_len, CAST(l_quantity AS INT) AS output_tokens
FROM {lines}
"""

LOGITS_SQL = "SELECT vec_id AS req, CAST(i - 1 AS INT) AS token_id, round(CAST(embedding[i] AS DOUBLE) * 20, 1) AS logit FROM embeddings, (SELECT unnest(range(1, 65)) AS i) r"


def boxes(t: Tables) -> DataFrame:
    return t.sql(BOXES).select("doc", "page", "pos", "label", "text", F.array("x0", "y0", "x1", "y1").alias("coordinate"))


def segments(t: Tables) -> DataFrame:
    return t.sql(SEGMENTS).withColumnsRenamed({"start_s": "start", "end_s": "end"})


def logits(t: Tables) -> DataFrame:
    rows = t("embeddings").select(F.col("vec_id").alias("req"), F.posexplode("embedding").alias("token_id", "x"))
    return rows.select("req", "token_id", F.round(F.col("x").cast("double") * 20, 1).alias("logit"))


#: SQL of ``tokens``.
TOKENS_SQL = "SELECT doc_id, list_transform(string_split(text, ' '), lambda x: CAST(length(x) % 4 AS INT)) AS tokens FROM documents"


def tokens(t: Tables) -> DataFrame:
    """Token arrays of a document: word lengths mod 4 of all its words."""
    words = F.split("text", " ", -1)
    return t("documents").select("doc_id", F.transform(words, lambda w: (F.length(w) % 4).cast("int")).alias("tokens"))
