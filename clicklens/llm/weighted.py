"""Document fingerprints by consistent weighted sampling.

A text is a weighted set: its words in lower case (runs without white space),
weighted by how often they occur. Sample k draws, for each word, two gamma
variates r, c of shape 2 and a uniform b by hashes of word and k; with
t = floor(ln(weight) / r + b) the word's rank is ln c - r (t - b + 1), and the
sample is the word and t of lowest rank. Two texts' samples agree with the
probability that is their generalised Jaccard similarity, the sum of smaller
weights over the sum of larger ones. A fingerprint is 16 hashed bits of each
of ``SAMPLES`` samples, in hex; likeness is the share of equal samples.

Everything is DataFrame expressions. Texts are shuffled once, by id; the words
of a text never leave the task that holds it.

Defined cases: a null text is empty; texts without words share one constant
fingerprint; null ids count as the smallest; rows with equal id are all kept,
and where such an id is the next document its least text is taken; a lone
document is its own next; an empty table gives no rows. Input columns other
than id and text are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, stored

SAMPLES = 64
#: Rows of the table of gamma variates; a word's r and c come from rows that separate bits of its hash name.
ENTRIES = 4096
NULL_ID = -(1 << 63)
#: What stands for a sample of a text without words.
NO_SAMPLE = "ffff"


def _gamma(h: str) -> str:
    """SQL: a gamma variate of shape 2 from the two halves of a 64-bit hash."""
    first, second = f"(shiftrightunsigned({h}, 32) + 0.5D)", f"(({h} & 4294967295) + 0.5D)"
    return f"({2 * 32 * math.log(2)!r}D - ln({first} * {second}))"


def _variates(spark: SparkSession, samples: int) -> DataFrame:
    """(bucket, r, ln_c): ``ENTRIES`` rows of one gamma variate per sample; a fixed size, whatever the corpus."""
    each = f"transform(sequence(0, {samples - 1}), k -> {{}})"
    r, c = (_gamma(f"xxhash64(id, k, '{name}')") for name in "rc")
    rows = spark.range(0, ENTRIES, 1, 1)
    return rows.select(F.col("id").cast("int").alias("bucket"), F.expr(each.format(r)).alias("r"), F.expr(each.format(f"ln({c})")).alias("ln_c"))


def _lowest(k: int) -> F.Column:
    """Lowest (rank, hashed sample) as one long: rank in the high bits, 16 bits that stand for (word, t) below."""
    h = f"xxhash64(term, {k})"
    b = f"(cast({h} & 1048575 as double) / 1048576D)"
    t = f"floor(ln_w / r[{k}] + {b})"
    rank = f"ln_c[{k}] - r[{k}] * ({t} - {b} + 1D)"
    # Words differ in the hash; the t of one word differ by an odd factor.
    return F.min(F.expr(f"cast(({rank} + 512D) * 34359738368D as bigint) * 65536 + ((shiftrightunsigned({h}, 20) + {t} * 40503) & 65535)")).alias(f"s{k}")


def signatures(texts: DataFrame, first: str, second: str, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys``, ``first_print`` and ``second_print``: fingerprints of two text columns.

    Rows of equal keys must have equal texts. Where ``texts`` is partitioned by
    a key, nothing is shuffled. A word that both texts hold as often is ranked
    once for both.
    """
    forms = F.array(F.struct(F.lower(first).alias("t"), F.lit(0).alias("of")), F.struct(F.lower(second).alias("t"), F.lit(1).alias("of")))
    rows = texts.select(*keys, F.explode(forms).alias("f"))
    rows = rows.select(*keys, "f.of", F.explode(F.split("f.t", SPACE)).alias("word")).filter("word <> ''")
    rows = rows.select(*keys, "of", F.xxhash64("word").alias("term"))
    counted = rows.groupBy(*keys, "term").agg(F.sum(1 - F.col("of")).alias("n1"), F.sum("of").alias("n2"))
    cases = F.expr(
        "if(n1 = n2, array(named_struct('of', 3, 'n', n1)), filter(array(named_struct('of', 1, 'n', n1),"
        " named_struct('of', 2, 'n', n2)), c -> c.n > 0))"
    )
    weighed = counted.select(*keys, "term", F.explode(cases).alias("c"))
    weighed = weighed.select(*keys, "term", "c.of", F.log(F.col("c.n").cast("double")).alias("ln_w"))
    table = _variates(texts.sparkSession, samples)
    for name, bits in (("r", 0), ("ln_c", 40)):
        bucket = F.shiftrightunsigned("term", bits).bitwiseAND(ENTRIES - 1).cast("int")
        weighed = weighed.join(F.broadcast(table.select("bucket", name)), bucket == F.col("bucket")).drop("bucket")
    lows = weighed.groupBy(*keys, "of").agg(*(_lowest(k) for k in range(samples)))
    lows = lows.select(*keys, "of", F.array(*(f"s{k}" for k in range(samples))).alias("s"))
    lows = lows.groupBy(*keys).agg(F.collect_list(F.struct("of", "s")).alias("parts"))  # three at most

    def print_of(bit: int) -> F.Column:
        mine = f"filter(parts, p -> p.of & {bit} <> 0)"
        low = f"transform(sequence(0, {samples - 1}), k -> array_min(transform({mine}, p -> p.s[k])))"
        return F.expr(f"if(size({mine}) = 0, '{NO_SAMPLE * samples}', array_join(transform({low}, x -> lower(lpad(hex(x & 65535), 4, '0'))), ''))")

    return lows.select(*keys, print_of(1).alias("first_print"), print_of(2).alias("second_print"))


def likeness(a: str, b: str, samples: int = SAMPLES) -> F.Column:
    """Share of equal samples of two fingerprints."""
    same = F.expr(f"size(filter(sequence(0, {samples - 1}), i -> substring({a}, 4 * i + 1, 4) = substring({b}, 4 * i + 1, 4)))")
    return same / F.lit(float(samples))


def next_ids(ids: DataFrame) -> DataFrame:
    """(id, next_id) of distinct ids: the next smaller one; after the smallest, the largest.

    Ids are dealt in ranges; within a range a window finds the neighbour, and
    only the largest id of each range goes through one task.
    """
    dealt = stored(ids.repartitionByRange("id").withColumn("range", F.spark_partition_id()), "print-ids")
    tops = dealt.groupBy("range").agg(F.max("id").alias("top"))
    order = Window.orderBy("range")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = tops.select("range", F.lag("top").over(order).alias("below"), F.last("top").over(everything).alias("largest"))
    own = F.lag("id").over(Window.partitionBy("range").orderBy("id"))
    rows = dealt.withColumn("own", own).join(F.broadcast(tops), "range")  # a row per range: as many as shuffle partitions
    return rows.select("id", F.coalesce("own", "below", "largest").alias("next_id"))


def with_edits(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(id, next_id, text, edited): each text, and it with its last third replaced from the next document."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    longest = rows.groupBy("id").agg(F.max(F.length("text")).alias("n"))
    sizes = stored(longest, "print-sizes")
    pairs = next_ids(sizes.select("id")).join(sizes, "id").withColumn("need", F.floor(F.col("n") / 3).cast("int"))
    heads = pairs.select(F.col("id").alias("for_id"), F.col("next_id").alias("id"), "need").join(rows, "id")
    heads = heads.select("for_id", F.col("id").alias("next_id"), F.expr("substring(text, 1, need)").alias("head"))
    heads = heads.groupBy(F.col("for_id").alias("id")).agg(F.min(F.struct("head", "next_id")).alias("h"))
    out = rows.join(heads, "id").withColumn("k", F.floor(F.length("text") / 3).cast("int"))
    edited = F.expr("concat(substring(text, 1, length(text) - k), substring(h.head, 1, k))")
    return out.select("id", F.col("h.next_id").alias("next_id"), "text", edited.alias("edited"))


def fingerprints(docs: DataFrame, samples: int = SAMPLES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and their likenesses."""
    rows = with_edits(docs, text, doc_id).withColumn("row", F.xxhash64("text"))
    # Repeated rows share their keys: counted together, their words would weigh double.
    prints = signatures(rows.dropDuplicates(["id", "row"]), "text", "edited", ["id", "row"], samples)
    facts = rows.select("id", "row", "next_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    nothing = F.lit(NO_SAMPLE * samples)
    found = facts.join(prints, ["id", "row"], "left").select(
        "id", "next_id", "n_chars", "edited_sha256", F.coalesce("first_print", nothing).alias("fingerprint"), F.coalesce("second_print", nothing).alias("edited_fingerprint")
    )
    found = stored(found, "prints")
    first = found.groupBy(F.col("id").alias("next_id")).agg(F.min("fingerprint").alias("next_print"))
    found = found.join(first, "next_id")
    return found.select(
        F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint", samples).alias("near_edited"), likeness("fingerprint", "next_print", samples).alias("near_next"),
    )
