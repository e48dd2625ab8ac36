"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (
    bpe,
    licenses,
    line_dedup,
    merkle,
    mixing,
    periodic,
    pseudonyms,
    quality,
    secrets,
    simhash,
    substrings,
    tiling,
    token_counts,
)
from tidewater.llm.common import benchmark, documents, scratch

#: Rank file of the token queries, and the key of the registered pseudonym query;
#: a production run passes its own secret.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DEMO_KEY = b"demonstration key, not a secret"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.robust_quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = F.transform("places", lambda p: p["start"])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    return licenses.scan_licenses(documents(spark, sf_dir)).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(documents(spark, sf_dir), benchmark(spark, sf_dir)).select(
        "doc_id", "item_id", "n_item_words", "n_tiles", "n_covered", "longest_tile", "coverage"
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return out.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


OP4_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
owners AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (
  SELECT k.*, o.owner IS NULL OR o.owner = k.doc_id AS stays FROM keyed k LEFT JOIN owners o USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(documents(spark, sf_dir), f"{scratch(spark, 'secrets')}/ledger")
    base = [r.kind for r in secrets.BASE_RULES]
    spelled = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(spelled(F.filter("spans", lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
        spelled(F.col("spans")).alias("spans"),
    )


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudonyms.pseudonymize(documents(spark, sf_dir), DEMO_KEY)
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda x: x["kind"]))), ",")
    return found.select("doc_id", F.size("found").cast("long").alias("n_found"), kinds.alias("kinds"), "text")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.lengths(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)
    return token_counts.suffix_sums(token_counts.histogram(counts))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = F.col("size") * F.col("copies")
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", taken.alias("taken"), "source", "copies")


#: The same in plain SQL: word counts, the level of words per weight as the
#: greatest of those that follow when the k sources of least bound per weight are
#: full, and the whole numbers passed in order of size.
OP11_SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
sums AS (SELECT source, CAST(sum(size) AS DOUBLE) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight,
         sum(source_size) OVER () AS everything FROM sums),
filled AS (
  SELECT *, coalesce(sum(2 * source_size) OVER prior, 0) AS full_words, sum(weight) OVER () - coalesce(sum(weight) OVER prior, 0) AS free
  FROM weighed
  WINDOW prior AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
aimed AS (
  SELECT source, source_size, least(2 * source_size, weight * (SELECT max((1.5 * everything - full_words) / free) FROM filled)) AS target,
         ('0x' || substr(sha256('0:' || coalesce('=' || source, '-')), 1, 12))::BIGINT % 1000000000 AS start
  FROM filled),
rated AS (SELECT *, coalesce(floor(target / nullif(source_size, 0) * 1000000000), 0)::HUGEINT AS rate FROM aimed),
placed AS (
  SELECT s.doc_id, s.size, s.source, r.source_size, r.target, r.rate, r.start,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id NULLS FIRST)::HUGEINT AS place
  FROM sized s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source),
counted AS (
  SELECT *, ((place * rate + start) // 1000000000 - ((place - 1) * rate + start) // 1000000000)::BIGINT AS copies FROM placed)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target, (size * copies)::BIGINT AS taken, source, copies
FROM counted
"""


def with_planted_period(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the contract's alteration: where the CRC-32 of
    the decimal doc_id is a multiple of 10, the words from a on repeat the first p
    of them. A null doc_id has no digits, and its text stays."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), g.alias("g"))
    n = F.size("w")
    chosen = chosen.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    chosen = chosen.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    again = F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil((n - F.col("a")) / F.col("p")).cast("int"))
    altered = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(F.flatten(again), F.lit(1), n - F.col("a")))
    return chosen.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(altered, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse_runs(with_planted_period(documents(spark, sf_dir)))
    none = F.lit(None).cast(periodic.RUN)
    # the first of those with the greatest length / period, compared by products
    greater = lambda x, y: y["length"] * x["period"] > x["length"] * y["period"]
    best = F.aggregate("runs", none, lambda x, y: F.when(x.isNull() | greater(x, y), y).otherwise(x))
    spelled = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(spelled, lambda s: F.concat(s, F.lit("\n"))), "")
    rows = found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), listed.alias("listed"), "text")
    return rows.select(
        "doc_id", "n_runs", F.col("b.start").alias("start"), F.col("b.length").alias("length"), F.col("b.period").alias("period"),
        F.expr("1000 * b.length DIV b.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"), "n_words",
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    tampered = merkle.leaf([F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in merkle.FIELDS])
    rows = merkle.manifest(docs, claimed=F.when(chosen & F.col("n_chars").isNotNull(), tampered))
    text = lambda c: F.lower(F.hex(c))
    return rows.select(
        "doc_id", *[text(c).alias(c) for c in ("leaf", "subroot", "root")], F.sha2(text("siblings"), 256).alias("proof_sha256"),
        text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


#: Trees by recursion over levels; the CRC-32 that chooses the tampered rows is
#: spelled out by its polynomial, as the SQL engine has no function for it.
OP13_SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([i::UBIGINT] || range(8)::UBIGINT[],
                          lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) ORDER BY i) AS entries
  FROM range(256) AS r(i)),
chosen AS (
  SELECT *, xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT),
                            lambda c, b: xor(c // 256, entries[(1 + xor(c, b) % 256)::BIGINT])), 4294967295::UBIGINT) % 7 = 0 AS tampered
  FROM documents, crc_table),
spelled AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS grp, coalesce(tampered, false) AND n_chars IS NOT NULL AS tampered,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') ||
           coalesce(strlen(lang) || ':' || lang, '-') AS before,
         coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS chars,
         coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS more_chars,
         coalesce(strlen(text) || ':' || text, '-') AS after
  FROM chosen),
hashed AS (
  SELECT doc_id, grp, sha256(before || chars || after) AS leaf,
         CASE WHEN tampered THEN sha256(before || more_chars || after) ELSE sha256(before || chars || after) END AS claimed
  FROM spelled),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n
  FROM hashed),
nodes AS (
  SELECT grp, 0 AS level, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT grp, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1
  GROUP BY grp, level, pos // 2, n),
groups AS (
  SELECT grp, digest, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, pos, n, digest FROM groups
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1
  GROUP BY level, pos // 2, n),
steps AS (
  SELECT l.grp, l.pos, own.level, CASE WHEN own.pos % 2 = 1 THEN 'l' ELSE 'r' END AS side, other.digest
  FROM leaves l JOIN nodes own ON own.grp = l.grp AND own.n > 1 AND own.pos = l.pos >> own.level
  LEFT JOIN nodes other ON other.grp = own.grp AND other.level = own.level AND other.pos = xor(own.pos, 1)
  UNION ALL
  SELECT l.grp, l.pos, 100 + own.level, CASE WHEN own.pos % 2 = 1 THEN 'l' ELSE 'r' END, other.digest
  FROM leaves l JOIN groups g ON g.grp = l.grp JOIN tops own ON own.n > 1 AND own.pos = g.pos >> own.level
  LEFT JOIN tops other ON other.level = own.level AND other.pos = xor(own.pos, 1)),
proofs AS (
  SELECT grp, pos, sha256(coalesce(string_agg(digest, '' ORDER BY level), '')) AS proof_sha256,
         list(coalesce(side || digest, '-') ORDER BY level) AS path
  FROM steps GROUP BY grp, pos),
answers AS (
  SELECT l.doc_id, l.leaf, g.digest AS subroot, (SELECT digest FROM tops WHERE n = 1) AS root,
         coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
         list_reduce([l.claimed] || coalesce(p.path, []),
                     lambda acc, x: CASE x[1] WHEN 'l' THEN sha256(x[2:] || acc) WHEN 'r' THEN sha256(acc || x[2:]) ELSE sha256(acc) END) AS folded_root
  FROM leaves l JOIN groups g ON g.grp = l.grp LEFT JOIN proofs p ON p.grp = l.grp AND p.pos = l.pos)
SELECT *, folded_root = root AS verified FROM answers
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_license_scan": op2_license_scan,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_line_dedup": op4_line_dedup,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_pseudonyms": op7_pseudonyms,
    "op8_token_counts": op8_token_counts,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_mixing": op11_mixing,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_merkle_manifest": op13_merkle_manifest,
    "pipeline": corpus_pipeline.run,
}
SQL: dict[str, str] = {"op4_line_dedup": OP4_SQL, "op11_mixing": OP11_SQL, "op13_merkle_manifest": OP13_SQL}
