"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import collocations, decontam, langid, main_text, mixing, runs, secret_scan, suffixes, toxicity, warc, weighted
from .common import SPACE, ship, stored, table
from .simhash import hex_print, near_duplicates
from .tokens import read_token_digests, token_ids, write_token_files

SHINGLE_WORDS, MAX_BITS = 4, 4
END_ID = 1


def word_tokenizer() -> str:
    """The contract's vocabulary file, read on the driver and sent to the tasks."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as token ids in range-ANS files, and what is read back from them."""
    ids = stored(token_ids(table(spark, sf_dir, "documents"), word_tokenizer(), END_ID), "token-ids")
    path = scratch_path(spark, "token-files")
    write_token_files(ids, path)
    return read_token_digests(spark, path)


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages of every document that another text repeats."""
    return suffixes.repeats(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that the mix takes, beside its source's target."""
    found = mixing.allot(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("picks")).alias("taken"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that documents hold; documents without a row are clean."""
    docs, benchmark = (table(spark, sf_dir, n) for n in ("documents", "benchmark"))
    return decontam.contaminated(docs.select("doc_id", "text"), benchmark)


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = main_text.extract(pages, main_text.fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"), SHINGLE_WORDS, MAX_BITS)
    return found.select("doc_id", hex_print(F.col("fp")).alias("fingerprint"), "component_id")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.predict(docs, langid.fit(langid.training_rows(docs)))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back from them."""
    path = scratch_path(spark, "warc")
    warc.write_archive(warc.records(table(spark, sf_dir, "pages")), path)
    found = warc.read_records(spark, path)
    return found.select("page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: the fixed patterns' and those the character models add."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.fit(docs))
    counts = [secret_scan.kind_count("base", k).alias(f"n_{k}") for k in secret_scan.KINDS]
    return found.select("doc_id", *counts, F.sha2(secret_scan.listed("base"), 256).alias("base_sha256"), secret_scan.listed("spans").alias("spans"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted-sample fingerprints of every document and of its edited text."""
    return weighted.fingerprints(table(spark, sf_dir, "documents"))


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's texts: where crc32 of the id ends in 0, the words from one place on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    rows = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n = F.size("words")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    picked = F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(picked, " ")).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, and its text without their repeats."""
    found = runs.find_runs(_with_planted_runs(table(spark, sf_dir, "documents")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    # The greatest by length, then the smallest by start and period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    start, length, period = -F.col("best.s"), F.col("best.length"), -F.col("best.p")
    milli = F.expr("1000 * best.length div -best.p")
    return found.select("doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"), milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    found = toxicity.score_texts(docs.select("doc_id", "text"), model)
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leading phrases of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


_QUERIES = [op1_token_files, op2_repeats, op3_mixing, op4_decontamination, op5_main_text, op6_simhash, op7_language, op8_warc, op9_secrets, op10_fingerprints, op11_runs, op12_toxicity, op13_collocations]


def _shipped(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    run.__doc__ = query.__doc__
    return run


QUERIES = {q.__name__: _shipped(q) for q in _QUERIES}
ORACLE_SQL: dict[str, str] = {"op3_mixing": mixing.ORACLE_SQL, "op13_collocations": collocations.ORACLE_SQL}
