"""The registered queries of this subpackage, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import ann, exact_dedup, mixing, packing, panes, pii, resampling, secrets, simhash, suffix_dedup, token_counts, toxicity, warc
from sparkloom.llm.common import carry, table

#: Where the vocabulary lies; never copied here.
TOKENIZER_ENV = "LOOM_TOKENIZER"


def tokenizer_path() -> str:
    if configured := os.environ.get(TOKENIZER_ENV):
        return configured
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined, of spans that are sorted already."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_columns(spans: str, base: dict[str, str]) -> list[Column]:
    """The counts of the base kinds, the digest of the base spans, and all spans."""
    s = F.col(spans)
    kinds = F.transform(s, lambda x: x["kind"])
    counts = [(F.size(s) - F.size(F.array_remove(kinds, kind))).cast("long").alias(name) for kind, name in base.items()]
    only = F.filter(s, lambda x: x["kind"].isin(*base))
    return [*counts, F.sha2(span_text(only), 256).alias("base_sha256"), span_text(s).alias("spans")]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.extract(table(spark, sf_dir, "documents"))
    return carry(out, out.select("doc_id", *span_columns("spans", {k: f"n_{k}" for k in pii.KINDS})))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.withColumn("n_spans", F.size("spans").cast("long")).drop("spans")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return carry(out, out.select("doc_id", "size", "source_size", "target", "taken", "copies"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *span_columns("spans", {"assign": "n_assign", "access": "n_access", "hex": "n_hex"}))


def op6_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.duplicates(table(spark, sf_dir, "documents"))
    return carry(out, out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, records = warc.archive(table(spark, sf_dir, "pages"))
    return carry(records, records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


OP8_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> least THEN least END AS refers_to
FROM f
"""


def op9_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The CRC-32 of a list of bytes, by the table that follows from its polynomial.
CRC_TABLE = """
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
"""

OP11_SQL = (
    CRC_TABLE
    + r"""), words AS (
  SELECT true AS ours, rowid AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT row_number() OVER () AS rowid, text FROM documents)
  UNION ALL
  SELECT false, NULL, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
), hexed AS (
  SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM words)
), coded AS (
  SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
  FROM hexed, crc
), found AS (
  SELECT ours, id, bucket FROM words JOIN coded USING (w)
), counts AS (
  SELECT bucket, count(*) FILTER (ours) AS s, count(*) FILTER (NOT ours) AS t FROM found GROUP BY bucket
), sums AS (
  SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain FROM counts, sums
), weighed AS (
  SELECT id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM found JOIN gains USING (bucket) WHERE ours GROUP BY id
), scored AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM (SELECT row_number() OVER () AS rowid, doc_id FROM documents) d LEFT JOIN weighed ON d.rowid = weighed.id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_features >= 20) OVER () AS n FROM scored
)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM ranked
"""
)


def op12_window_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panes.panes(table(spark, sf_dir, "clicks"))


OP12_SQL = (
    CRC_TABLE
    + """), one AS (
  SELECT click_id, min({'a': epoch_us(coalesce(arrived_at, ts)), 'ts': epoch_us(ts), 'kind': coalesce(kind, 'none'), 'v': value}) AS r
  FROM clicks WHERE ts IS NOT NULL GROUP BY click_id
), coded AS (
  SELECT click_id, r.ts AS ts, r.kind AS kind, CASE WHEN isfinite(r.v) THEN floor(100 * r.v + 0.5) ELSE 0 END::BIGINT AS cents,
         r.a // 86400000000 AS d,
         xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(click_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h
  FROM one, crc
), timed AS (
  SELECT click_id, kind, cents, least(9, d % 10 + greatest(0, h % 30 - 23))::BIGINT AS batch, ts - (d - d % 10) * 86400000000 AS event FROM coded
), batches AS (
  SELECT b AS batch, (SELECT max(event) FROM timed WHERE timed.batch < b) AS w FROM range(10) r(b)
), placed AS (
  SELECT t.*, floor(event / 3600000000)::BIGINT AS hour, w FROM timed t JOIN batches USING (batch)
), split AS (
  SELECT *, coalesce(w >= (hour + 49) * 3600000000, false) AS late FROM placed
), pane AS (
  SELECT kind, hour, batch, count(*) AS n, sum(cents) AS c FROM split WHERE NOT late GROUP BY ALL
), running AS (
  SELECT *, sum(n) OVER w AS total_n, sum(c) OVER w AS total_c, min(batch) OVER (PARTITION BY kind, hour) AS born FROM pane
  WINDOW w AS (PARTITION BY kind, hour ORDER BY batch)
), emitted AS (
  SELECT kind, hour, born, (SELECT min(batch) FROM batches b WHERE b.batch >= born AND b.w >= (hour + 13) * 3600000000) AS at FROM (SELECT DISTINCT kind, hour, born FROM running)
), out AS (
  SELECT batch, hour, click_id, 1 AS n_rows, cents, 'late' AS record, kind FROM split WHERE late
  UNION ALL
  SELECT coalesce(e.at, 9), e.hour, -1, arg_max(r.total_n, r.batch), arg_max(r.total_c, r.batch), CASE WHEN e.at IS NULL THEN 'final' ELSE 'emit' END, e.kind
  FROM emitted e JOIN running r ON r.kind = e.kind AND r.hour = e.hour AND r.batch <= coalesce(e.at, 9) GROUP BY e.at, e.hour, e.kind
  UNION ALL
  SELECT r.batch, r.hour, -1, r.total_n - CASE k WHEN 'retract' THEN r.n ELSE 0 END, r.total_c - CASE k WHEN 'retract' THEN r.c ELSE 0 END, k, r.kind
  FROM running r JOIN emitted e ON r.kind = e.kind AND r.hour = e.hour AND r.batch > e.at, (VALUES ('retract'), ('replace')) v(k)
)
SELECT batch::BIGINT AS batch, hour, click_id, n_rows::BIGINT AS n_rows, cents::BIGINT AS cents, record, kind FROM out
"""
)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2:3].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op7_exact_dedup": OP7_SQL, "op8_warc": OP8_SQL, "op11_importance_resampling": OP11_SQL, "op12_window_panes": OP12_SQL}
