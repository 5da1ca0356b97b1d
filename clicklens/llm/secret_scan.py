"""Secret scans: fixed patterns, and character Markov models that add what the patterns miss.

Two first-order character models, of random strings and of ordinary
identifiers, are counted from labelled samples. A token's log-likelihood ratio
under the two, per transition, says whether it looks random; tokens past
``THRESHOLD`` that no pattern covers become spans of kind ``markov``.

Samples are drawn from the corpus: random strings are digests of document ids
written in several alphabets (label random); identifiers are its words, alone
and joined in snake and camel case, free of pattern matches (label ordinary).
Both are bounded by ``SAMPLE_ROWS`` documents and ``SAMPLE_WORDS`` words of each; the scan covers all.

Everything is DataFrame expressions. Positions count code points: a pattern's
pieces between its matches and the matches themselves give them by their
lengths.

Defined cases: a null text is empty and has no spans; every row, repeated or
not, gives one row; an empty table gives no rows; input columns other than
those named like a result column are kept by ``scan``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_rows, let, sums_before

#: Fixed patterns of the contract, in listing order, and the least length of the part that counts.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex")
ASSIGN_LEAST = 12

#: Tokens the models judge.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
#: Mean log-likelihood ratio per transition past which a token looks random.
THRESHOLD = 0.6
#: Distinct characters that such a token has at least; rulers and runs have fewer.
DISTINCT = 8
SAMPLE_ROWS = 20_000
#: Words of a sampled document, from its start, that stand for it; the scan itself reads whole texts.
SAMPLE_WORDS = 200
#: Alphabet: every other character is the last symbol.
SYMBOLS = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ_-+/="
N = len(SYMBOLS) + 1


def _matches(text: str, pattern: str) -> str:
    """SQL: the spans (start, stop, value) of all leftmost matches of a pattern, in code points."""
    q = pattern.replace("\\", "\\\\").replace("'", "\\'")
    found, between = f"regexp_extract_all({text}, '{q}', 0)", f"split({text}, '{q}', -1)"
    pairs = f"filter(zip_with({found}, {between}, (v, g) -> if(v is null, null, named_struct('value', v, 'gap', length(g)))), m -> m is not null)"
    before = sums_before("transform(_m, m -> m.gap + length(m.value))")
    place = "named_struct('start', b + m.gap, 'stop', b + m.gap + length(m.value), 'value', m.value)"
    return let("_m", pairs, f"zip_with(_m, {before}, (m, b) -> {place})")


def _spans(text: str, pattern: str, kind: str, order: int, keep: str = "true") -> F.Column:
    none = "cast(array() as array<struct<start:int,rank:int,stop:int,kind:string,value:string>>)"
    q = pattern.replace("\\", "\\\\").replace("'", "\\'")
    spans = f"transform(filter({_matches(text, pattern)}, s -> {keep}), s -> named_struct('start', s.start, 'rank', {order}, 'stop', s.stop, 'kind', '{kind}', 'value', s.value))"
    # Most texts match nothing; they are done after one search.
    return F.expr(f"if({text} rlike '{q}', {spans}, {none})")


def base_spans(text: str) -> F.Column:
    """The fixed patterns' spans, by start, then kind as listed: array of (start, rank, stop, kind, value)."""
    group = ASSIGN.replace("\\", "\\\\").replace("'", "\\'")
    long_ = f"length(regexp_extract(s.value, '{group}', 1)) >= {ASSIGN_LEAST}"
    return F.array_sort(
        F.concat(_spans(text, ASSIGN, "assign", 0, long_), _spans(text, ACCESS, "access", 1), _spans(text, HEX, "hex", 2))
    )


def _symbol(char: str) -> str:
    return f"(if(instr('{SYMBOLS}', {char}) > 0, instr('{SYMBOLS}', {char}) - 1, {N - 1}))"


def transitions(tokens: DataFrame) -> DataFrame:
    """(label, pair, n): counted character transitions of (label, token) rows; ``pair`` numbers them."""
    chars = "substring(token, i, 1)", "substring(token, i + 1, 1)"
    pair = f"{_symbol(chars[0])} * {N} + {_symbol(chars[1])}"
    pairs = F.expr(f"if(length(token) > 1, transform(sequence(1, length(token) - 1), i -> {pair}), cast(array() as array<int>))")
    return tokens.select("label", F.explode(pairs).alias("pair")).groupBy("label", "pair").agg(F.count(F.lit(1)).alias("n"))


def labelled_tokens(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rows: int = SAMPLE_ROWS) -> DataFrame:
    """(label, token) samples from about ``rows`` documents chosen by a hash of the id; label 1 is random."""
    total = max(1, docs.count())
    place = F.pmod(F.xxhash64(F.col(doc_id).cast("string")), F.lit(1 << 30))
    part = docs.filter(place < int(min(1.0, rows / total) * (1 << 30)) + 1)
    part = part.select(F.col(doc_id).cast("string").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    digest = F.sha2(F.concat(F.lit("sample:"), F.coalesce("id", F.lit(""))), 256)
    plain = F.base64(F.unhex(digest))
    strings = F.array(digest, plain, F.upper(F.conv(F.substring(digest, 1, 15), 16, 36)), F.lower(F.conv(F.substring(digest, 17, 15), 16, 36)), F.translate(F.base64(F.unhex(F.sha2(digest, 256))), "+/=", "-_"))
    random = part.select(F.lit(1).alias("label"), F.explode(strings).alias("token"))
    words = F.expr(rf"filter(slice(regexp_extract_all(t, '[\\p{{L}}]{{2,}}', 0), 1, {SAMPLE_WORDS}), w -> w rlike '^[A-Za-z]+$')")
    ways = (  # identifiers as code writes them, from three words in a row
        "concat_ws('_', lower(w[i - 1]), lower(w[i]), lower(w[i + 1]))", "concat(lower(w[i - 1]), initcap(w[i]), initcap(w[i + 1]))",
        "concat(w[i - 1], lower(w[i]))", "upper(concat_ws('_', w[i - 1], w[i], w[i + 1]))", "upper(concat(w[i - 1], w[i]))",
        "lower(concat_ws('-', w[i - 1], w[i], w[i + 1]))", "concat('/', concat_ws('/', w[i - 1], w[i], w[i + 1]))",
    )
    chosen = f"element_at(array({', '.join(ways)}), i % {len(ways)} + 1)"
    joined = F.expr(f"transform(sequence(1, greatest(size(w) - 2, 1)), i -> {chosen})")
    safe = part.filter(~F.col("t").rlike(ASSIGN) & ~F.col("t").rlike(ACCESS) & ~F.col("t").rlike(HEX))
    ordinary = safe.withColumn("w", words).filter("size(w) > 2").select(F.lit(0).alias("label"), F.explode(joined).alias("token"))
    return random.union(ordinary)


def fit(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> list[float]:
    """Log-likelihood ratio of every transition (``N * N`` numbers), random over ordinary, add-one smoothed.

    The driver gets at most two counts per transition, whatever the corpus holds.
    """
    counts = {(r["label"], r["pair"]): r["n"] for r in transitions(labelled_tokens(docs, text, doc_id)).collect()}
    rows = {(k, a): sum(counts.get((k, a * N + b), 0) for b in range(N)) for k in (0, 1) for a in range(N)}

    def log_p(k: int, a: int, b: int) -> float:
        return math.log((counts.get((k, a * N + b), 0) + 1) / (rows[k, a] + N))

    return [log_p(1, a, b) - log_p(0, a, b) for a in range(N) for b in range(N)]


def _ratio(token: str, table: list[float]) -> str:
    """SQL: a token's mean log-likelihood ratio per transition."""
    values = ",".join(f"{x:.5f}" for x in table)
    chars = f"substring({token}, i, 1)", f"substring({token}, i + 1, 1)"
    at = f"{_symbol(chars[0])} * {N} + {_symbol(chars[1])}"
    return f"aggregate(sequence(1, length({token}) - 1), 0D, (z, i) -> z + cast(split('{values}', ',') as array<double>)[{at}]) / (length({token}) - 1)"


def scan(docs: DataFrame, table: list[float], text: str = "text") -> DataFrame:
    """``docs`` with base and all spans, each an array of (start, rank, stop, kind, value) by start, then kind."""
    rows = docs.select(*(c for c in docs.columns if c not in ("base", "spans")), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.withColumn("base", base_spans("_text"))
    random = f"size(array_distinct(split(s.value, ''))) >= {DISTINCT} and {_ratio('s.value', table)} > {THRESHOLD}"
    tokens = _spans("_text", TOKEN, "markov", 3, random)
    rows = rows.withColumn("_more", tokens).drop("_text")
    # Base spans in rows with their bounds: a token looks into the few rows that it can meet.
    bounds = "named_struct('start', r[0].start, 'stop', array_max(transform(r, b -> b.stop)), 'row', r)"
    meets = "exists(_b, r -> r.start < m.stop and m.start < r.stop and exists(r.row, b -> b.start < m.stop and m.start < b.stop))"
    free = let("_b", f"transform({in_rows('base')}, r -> {bounds})", f"filter(_more, m -> not {meets})")
    free = f"if(size(_more) = 0 or size(base) = 0, _more, {free})"
    return rows.withColumn("spans", F.array_sort(F.concat("base", F.expr(free)))).drop("_more")


def listed(spans: str) -> F.Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.concat_ws(",", F.expr(f"transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.stop))"))


def kind_count(spans: str, kind: str) -> F.Column:
    return F.size(F.expr(f"filter({spans}, s -> s.kind = '{kind}')")).cast("long")
