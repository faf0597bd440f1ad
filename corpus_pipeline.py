"""The corpus pipeline: documents without toxicity, exact copies or near copies, mixed to target weights and packed.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next one's docs. All but the last return the columns of
documents. ``run`` applies them to the documents table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm import exact_dedup, mixing, packing, simhash, toxicity
from sparkloom.llm.common import Scratch, carry, table
from sparkloom.llm.registry import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity field does not reject. The field is a narrow pass, so the text is filtered in place.

    Null and empty texts have no toxic word and stay; long texts are scored whole. Rows that repeat an id or a text are judged each, by their
    text alone, so equal texts stay or go together. Labels of ids that no row has, or that are null, are left out; without labels, or
    without documents, nothing is rejected. Columns beyond those of documents are dropped here, whatever their names.
    """
    field = toxicity.train(*toxicity.labelled_sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.keep(docs.select(*COLUMNS), field)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal without ASCII white space: the one of most code points, then of the smallest id (null
    first), then the first of the input.

    Null, empty and blank texts are one group. Rows are told apart by their place in the input, so repeated and null ids are no key.
    Long texts are digested whole. No rows give no rows.
    """
    return exact_dedup.deduplicate(docs.select(*COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the smallest id (null last), of one id the smallest text digest.

    Texts without words (null, empty, blank) have one fingerprint and are linked; texts of fewer words than a shingle are one shingle. Rows
    are told apart by their place in the input. Long texts are hashed whole. No rows give no rows.
    """
    return simhash.one_of_each(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, at most three times.

    Null and empty texts have no words and are never taken; a null source is a source, the last. Of rows equal in id, source and text one
    stands for the copies of all. Ties in length are broken by a seeded hash of id and text. Long texts count whole. No rows give no rows.
    """
    return mixing.materialised_mix(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are their end id alone; long texts are cut into whole sequences and a rest. Repeated rows and null ids are packed
    each and dealt to groups by a number of their own. No rows give no rows.
    """
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("sequence_packing", pack_sequences),
]

#: Toxicity and packing have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table. Each stage's rows are a table in the shared folder."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = scratch.table(docs, name)
    return carry(scratch.own(docs), docs)
