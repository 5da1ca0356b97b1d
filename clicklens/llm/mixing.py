"""Mixing sources to target weights over a multivariate-hypergeometric splitting tree.

Every document has a place in its source's pseudo-random order (a hash of its
id) and so falls into one of the source's equal hash blocks. A source's target
is met by whole passes over its documents plus the start of one more; counted
in blocks that is the source's quota. A tree splits the quotas among output
shards: each node draws, from a multivariate hypergeometric distribution, how
many blocks of each source go left, down to single shards. Shards then take
disjoint runs of the source's permuted blocks, and shuffle their documents by
another hash. Everything is DataFrame expressions; the tree has one row per
node, whose array holds one number per source.

Targets share the total size by weight (1, 2, 3, repeating, over sources in
code point order, null last); a target stops at ``cap`` times its source's
size and the excess is reshared by weight until none is above.

Defined cases: a null text has size 0; documents without words are never
drawn; null is a source of its own; rows with equal doc_id stand side by side
in the order and are all kept; columns of the input that bear the name of a
result column are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, small_side, stored

WEIGHTS = (1, 2, 3)
CAP = 3
#: Words of a block and of an output shard, about.
BLOCK_WORDS = 1 << 14
SHARD_WORDS = 1 << 22
#: Blocks whose prefix sums one task makes.
RUN = 1024
SEED = "mix"
#: Multipliers of the block permutation; one that does not divide the quota is coprime to it.
PRIMES = (998244353, 1000000007, 1000000009, 754974721, 469762049)


def word_count(text: F.Column) -> F.Column:
    """Number of words (runs without white space); null: 0."""
    t = F.coalesce(text, F.lit(""))
    n = F.size(F.split(t, SPACE)) - t.rlike(rf"\A{SPACE}").cast("int") - t.rlike(rf"{SPACE}\z").cast("int")
    return F.when(t == "", 0).otherwise(n).cast("long")


def _place(doc_id: F.Column) -> F.Column:
    """52 bits of a hash of the id: the place in the source's order."""
    key = F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap=CAP) -> DataFrame:
    """(key, source, source_size, weight, target) from (key, source, size) rows; one row per source.

    The level is the words per unit of weight at which targets, cut at
    ``cap`` times the size, add up to the total.
    """
    s = sizes.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights) + 1).cast("int"))
    s = s.withColumn("weight", weight).withColumn("most", F.lit(cap) * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("total", F.sum("source_size").over(everything))
    s = s.withColumn("capped", F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("most"))
    s = s.withColumn("heavier", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("level", (F.col("total") - F.col("capped")) / F.col("heavier"))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))
    s = s.withColumn("level", F.first(fits, ignorenulls=True).over(everything))
    target = F.least(F.col("most").cast("double"), F.coalesce(F.col("level"), F.lit(math.inf)) * F.col("weight"))
    return s.select("key", "source", "source_size", "weight", target.alias("target"))


def _cuts(sized: DataFrame, targets: DataFrame, block_words: int) -> DataFrame:
    """Per source: passes, blocks, quota, and the last document (place, id, size) of the part pass."""
    t = targets.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    t = t.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    t = t.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long"))
    t = stored(t, "mix-sources")
    placed = sized.join(t.select("key", "blocks", "rest"), "key").withColumn("block", block_of("place", "blocks"))
    by_block = placed.groupBy("key", "block").agg(F.sum("size").alias("words"))
    by_block = stored(by_block.withColumn("run", F.floor(F.col("block") / RUN)), "mix-blocks")
    # Prefix sums in two levels: over runs of blocks, then within a run.
    runs = by_block.groupBy("key", "run").agg(F.sum("words").alias("run_words"))
    runs = runs.withColumn("before_run", F.sum("run_words").over(Window.partitionBy("key").orderBy("run")) - F.col("run_words"))
    runs = runs.join(t.select("key", "rest"), "key").filter("before_run < rest and rest <= before_run + run_words")
    inside = by_block.join(runs.select("key", "run", "before_run", "rest"), ["key", "run"])
    before = F.col("before_run") + F.sum("words").over(Window.partitionBy("key", "run").orderBy("block")) - F.col("words")
    edge = inside.withColumn("before", before).filter("before < rest and rest <= before + words")
    # Within the block where the part pass ends: a document belongs if its middle comes before the end.
    docs = placed.join(edge.select("key", "block", "before"), ["key", "block"])
    order = Window.partitionBy("key").orderBy("place", "id", "size")
    start = F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    docs = docs.withColumn("start", start).withColumn("fits", 2 * F.col("start") + F.col("size") <= 2 * F.col("rest"))
    last = F.max(F.when(F.col("fits"), F.struct("block", "place", "id", "size"))).alias("last")
    ends = docs.groupBy("key").agg(F.first("block").alias("edge_block"), last)
    out = t.join(ends, "key", "left")
    # Where no document of the edge block belongs, those of the blocks before it do.
    out = out.withColumn("edge_block", F.coalesce("edge_block", F.lit(-1).cast("long")))
    none = F.struct(F.col("edge_block").alias("block"), *(F.lit(-1).cast("long").alias(c) for c in ("place", "id", "size")))
    out = out.withColumn("last", F.coalesce("last", none))
    return out.withColumn("quota", F.col("passes") * F.col("blocks") + F.col("edge_block") + 1)


def block_of(place: str, blocks: str) -> F.Column:
    return F.least(F.floor(F.col(place) / F.lit(float(1 << 52)) * F.col(blocks)), F.col(blocks) - 1).cast("long")


# ------------------------------------------------------------------- the tree

#: One draw from a hypergeometric distribution, as SQL: of r blocks k are of
#: this source and w are wanted. Probabilities follow by recurrence from nine
#: standard deviations below the mean to nine above; u is uniform in [0, 1).
_RATIO = "cast(p.k - j as double) * (p.w - j) / (cast(j + 1 as double) * (p.r - p.k - p.w + j + 1))"
_DRAW = f"""
transform(array(named_struct('k', q[i], 'r', acc.rest, 'w', acc.want,
    'm', if(acc.rest > 0, cast(acc.want as double) * q[i] / acc.rest, 0D),
    'u', cast(shiftrightunsigned(xxhash64('{SEED}', lo, width, i), 11) as double) / 9007199254740992D)), p ->
  transform(array(named_struct('d', if(p.r > 1, 9 * sqrt(greatest(0D, p.m * (1 - cast(p.k as double) / p.r) * (p.r - p.w) / (p.r - 1))) + 3, 3D))), e ->
    transform(array(named_struct(
        'a', greatest(0L, p.w - (p.r - p.k), cast(floor(p.m - e.d) as bigint)),
        'b', least(p.k, p.w, cast(ceil(p.m + e.d) as bigint)))), t ->
      if(t.a >= t.b, t.b,
        transform(array(aggregate(sequence(t.a, t.b), named_struct('f', 1D, 's', 0D),
            (z, j) -> named_struct('f', z.f * {_RATIO}, 's', z.s + z.f), z -> z.s)), whole ->
          aggregate(sequence(t.a, t.b), named_struct('f', 1D, 's', 0D, 'x', t.a),
            (z, j) -> named_struct('f', z.f * {_RATIO}, 's', z.s + z.f, 'x', if(z.s <= p.u * whole, j, z.x)), z -> z.x))[0]))[0])[0])[0]
"""
_LEFT = f"""
aggregate(sequence(0, size(q) - 1), named_struct('rest', total, 'want', wanted, 'out', cast(array() as array<bigint>)),
  (acc, i) -> transform(array({_DRAW}), x ->
    named_struct('rest', acc.rest - q[i], 'want', acc.want - x, 'out', array_append(acc.out, x)))[0],
  acc -> acc.out)
"""


def split_quotas(quotas: DataFrame, shards: int) -> DataFrame:
    """(key, shard, n) from (key, quota): each source's blocks split over ``shards``, exactly."""
    root = quotas.select(F.struct("key", "quota").alias("e")).agg(F.sort_array(F.collect_list("e")).alias("e"))
    nodes = root.select(F.col("e.key").alias("keys"), F.col("e.quota").alias("q"), F.lit(0).alias("lo"), F.lit(shards).alias("width"))
    for _ in range(math.ceil(math.log2(max(1, shards)))):
        n = nodes.withColumn("half", F.floor(F.col("width") / 2).cast("int"))
        n = n.withColumn("total", F.expr("aggregate(q, 0L, (s, x) -> s + x)"))
        n = n.withColumn("wanted", F.round(F.col("total") * F.col("half") / F.col("width")).cast("long"))
        n = n.withColumn("left", F.when(F.col("half") > 0, F.expr(_LEFT)))
        children = F.expr(
            "if(half = 0, array(named_struct('q', q, 'lo', lo, 'width', width)), array("
            " named_struct('q', left, 'lo', lo, 'width', half),"
            " named_struct('q', zip_with(q, left, (a, b) -> a - b), 'lo', lo + half, 'width', width - half)))"
        )
        nodes = n.select("keys", F.explode(children).alias("c")).select("keys", "c.q", "c.lo", "c.width").repartition("lo")
    pairs = F.arrays_zip(F.col("keys").alias("key"), F.col("q").alias("n"))
    return nodes.select(F.col("lo").alias("shard"), F.explode(pairs).alias("e")).select("e.key", "shard", "e.n")


def _units(cuts: DataFrame, shards: int) -> DataFrame:
    """(key, block, picks): each drawn block with its passes and the shards that take it."""
    split = stored(split_quotas(cuts.select("key", "quota"), shards), "mix-tree")
    start = F.sum("n").over(Window.partitionBy("key").orderBy("shard")) - F.col("n")
    runs = split.withColumn("start", start).filter("n > 0").join(cuts.select("key", "quota", "blocks"), "key")
    prime = F.expr("filter(array({}), p -> quota % p != 0)[0]".format(", ".join(f"{p}L" for p in PRIMES)))
    at = runs.select("key", "shard", "quota", "blocks", prime.alias("prime"), F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("at"))
    unit = (F.col("at") % F.col("quota") * (F.col("prime") % F.col("quota")) + F.pmod(F.xxhash64("key"), F.col("quota"))) % F.col("quota")
    at = at.withColumn("unit", unit)
    at = at.select("key", (F.col("unit") % F.col("blocks")).alias("block"), F.floor(F.col("unit") / F.col("blocks")).cast("int").alias("pass"), "shard")
    return at.groupBy("key", "block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("picks"))


def allot(docs: DataFrame, **options) -> DataFrame:
    """The documents with size, source_size, target and picks, an array of (pass, shard): one for each time drawn.

    Options: the names ``source``, ``text`` and ``doc_id`` of the columns, and ``block_words``, ``shard_words``.
    """
    return _allotted(docs, **options)[0]


def _allotted(
    docs: DataFrame, source: str = "source", text: str = "text", doc_id: str = "doc_id",
    block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
) -> tuple[DataFrame, int]:
    """``allot``'s result and the number of output shards."""
    key = F.coalesce(F.concat(F.lit("s"), F.col(f"row.{source}").cast("string")), F.lit("null"))
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.select(
        "row", key.alias("key"), F.col(f"row.{source}").cast("string").alias("source"), word_count(F.col(f"row.{text}")).alias("size"),
        _place(F.col(f"row.{doc_id}")).alias("place"), F.coalesce(F.col(f"row.{doc_id}").cast("long"), F.lit(-(1 << 63))).alias("id"),
    )
    sized = stored(rows.drop("row"), "mix-sizes")
    cuts = stored(_cuts(sized, source_targets(sized), block_words), "mix-cuts")
    words = cuts.agg(F.sum("target")).first()[0] or 0
    # An empty table has no sources and no tree.
    shards = max(1, math.ceil(words / shard_words))
    units = stored(_units(cuts.filter("quota > 0"), shards), "mix-units") if words else None
    met = rows.join(cuts.select("key", "source_size", "target", "passes", "blocks", "last"), "key")
    met = met.withColumn("block", block_of("place", "blocks"))
    if units is None:
        met = met.withColumn("picks", F.expr("cast(array() as array<struct<pass:int,shard:int>>)"))
    else:
        met = met.join(small_side(units), ["key", "block"], "left")
    in_part = F.struct("block", "place", "id", "size") <= F.col("last")
    met = met.withColumn("draws", F.when(F.col("size") > 0, F.col("passes") + in_part.cast("long")).otherwise(0))
    picks = F.coalesce(F.expr("filter(picks, p -> p.pass < draws)"), F.expr("cast(array() as array<struct<pass:int,shard:int>>)"))
    met = met.withColumn("picks", picks)
    new = ["size", "source_size", "target", "picks"]
    return met.select(*(F.col(f"row.`{c}`") for c in docs.columns if c not in new), *new), shards


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix: every drawn document, as often as drawn, with its pass and shard, shuffled within shards."""
    out, shards = _allotted(docs, **options)
    out = out.withColumn("pick", F.explode("picks"))
    keep = [c for c in docs.columns if c not in ("size", "source_size", "target", "picks", "pass", "shard")]
    doc_id = options.get("doc_id", "doc_id")
    # A task holds about a shard, however many shards there are.
    parts = max(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    out = out.select(*keep, "pick.pass", "pick.shard").repartition(parts, "shard")
    return out.sortWithinPartitions("shard", F.xxhash64(F.lit(SEED), F.col(doc_id), "pass"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT AS place
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::DOUBLE AS weight
  FROM d GROUP BY source),
c AS (
  SELECT *, (sum(source_size) OVER ())::BIGINT AS total,
    (sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING) - 3 * source_size)::BIGINT AS capped,
    sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavier
  FROM s),
l AS (
  SELECT *, (total - capped) / heavier AS level FROM c),
t AS (
  SELECT source, source_size, weight,
    least((3 * source_size)::DOUBLE, coalesce((SELECT max(level) FROM l WHERE level * weight <= 3 * source_size), 'inf'::DOUBLE) * weight) AS target
  FROM l),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM t),
o AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS start
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (CASE WHEN size > 0 THEN size * (passes + CASE WHEN 2 * start + size <= 2 * rest THEN 1 ELSE 0 END) ELSE 0 END)::BIGINT AS taken
FROM o
"""
