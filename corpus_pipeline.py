"""The corpus pipeline: documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept; its result is written as Parquet and read again. All but the last return
the columns of ``documents``.

1. ``language_id`` drops documents without a language (no letters, or a score
   under ``LEAST_SCORE``).
2. ``simhash_near_dedup`` keeps one document of each near-duplicate component.
3. ``decontamination`` drops documents that hold a benchmark item.
4. ``mixing`` draws documents, some more than once, to the sources' target weights.
5. ``token_output`` writes token files and returns what is read back: doc_id,
   start, n_tokens and ids_crc32 of each drawn document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.llm import decontam, langid, mixing, queries, simhash, tokens
from clicklens.llm.common import ship, small_side, stored, table
from clicklens.session import scratch_path

#: Documents whose best language has a smaller share of the outputs are rejected: this share,
#: or where many languages share the outputs, this many times an even share.
LEAST_SCORE, LEAST_TIMES_EVEN = 0.28, 1.12

ORACLE_SQL = None


def least_score(languages: int) -> float:
    return min(LEAST_SCORE, LEAST_TIMES_EVEN / max(1, languages))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = langid.fit(langid.training_rows(docs))
    found = langid.predict(docs, model, names=("_language", "_share"))
    return found.filter((F.col("_language") != langid.UNKNOWN) & (F.col("_share") >= least_score(len(model.languages)))).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.one_of_each(docs, queries.SHINGLE_WORDS, queries.MAX_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    # Searched by a hash of the text, so that null and repeated ids cannot take clean documents along.
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    found = decontam.contaminated(texts, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("_th")).distinct()
    return docs.withColumn("_th", F.xxhash64("text")).join(small_side(stored(found, "contaminated")), "_th", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    # Kept as one column, so that names of the documents cannot clash with the mix's.
    rows = docs.select(F.struct("*").alias("row"))
    return mixing.mix(rows, source="row.source", text="row.text", doc_id="row.doc_id").select("row.*")


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    ids = stored(tokens.token_ids(docs, queries.word_tokenizer(), queries.END_ID), "token-ids")
    path = scratch_path(spark, "token-files")
    tokens.write_token_files(ids, path)
    return tokens.read_token_digests(spark, path)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("token_output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is a table under the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
