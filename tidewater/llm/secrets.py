"""Secret scan with an incremental ledger of blobs.

Every version of a text is known by its content (SHA-256): a blob. The ledger, a
Parquet table, has for each scanned blob the rules (with version) that were
applied and what they found. A run leaves out blobs that every wanted rule has
seen, takes one text of each other blob, applies the rules that blob has not met,
appends to the ledger, and joins the ledger's findings back to all documents.
A new rule version meets all blobs, a new document only its own content.

Copies are merged map-side before their text is shuffled, and the findings join
on a blob that many documents share is one that Spark can split. An interrupted
run appends nothing, or rows that a later run reads; findings of a pair that two
runs scanned are counted once.

Defined results: a null text is empty; repeated rows and ids each get a row; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``pattern`` is matched leftmost without overlaps; matches whose ``group``
    has fewer than ``least`` characters, or fewer than ``bits`` of entropy for each
    character, are dropped. A text without any of ``marks`` is not searched."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    bits: float = 0.0
    marks: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The contract's three patterns, their order and least lengths. A
# run of hex digits or of a key's characters is maximal either way, so the least
# length stands in the pattern, where it keeps short runs from matching at all.
BASE_RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{32,}"),
)
# Published forms of keys and tokens. Each begins at a place that no
# character of its own alphabet precedes and takes whole runs of it (possessive), so
# that a search reads a text once, whatever it holds. What has no fixed prefix must
# have the entropy of random characters, which words and file names do not have.
FORMS = (
    Rule("private_key", 1, r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", marks=("PRIVATE KEY-----",)),
    Rule("jwt", 2, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", marks=("eyJ",)),
    Rule("temporary_access", 1, r"(?<![A-Z0-9])ASIA[A-Z0-9]{16}(?![A-Z0-9])", marks=("ASIA",)),
    Rule("github", 1, r"(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{82})(?![A-Za-z0-9_])", bits=3.0,
         marks=("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_")),
    Rule("gitlab", 1, r"(?<![A-Za-z0-9_-])glpat-[A-Za-z0-9_-]{20}(?![A-Za-z0-9_-])", bits=3.0, marks=("glpat-",)),
    Rule("slack", 1, r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{20,}+", bits=3.0, marks=("xox",)),
    Rule("slack_hook", 1, r"hooks\.slack\.com/services/T[A-Z0-9]{6,}+/B[A-Z0-9]{6,}+/[A-Za-z0-9]{20,}+", marks=("hooks.slack.com",)),
    Rule("stripe", 1, r"(?<![A-Za-z0-9_])[rs]k_(?:live|test)_[A-Za-z0-9]{16,}+", bits=3.0, marks=("k_live_", "k_test_")),
    Rule("google", 1, r"(?<![A-Za-z0-9_-])AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])", bits=3.0, marks=("AIza",)),
    Rule("sendgrid", 1, r"(?<![A-Za-z0-9_.-])SG\.[A-Za-z0-9_-]{22}\.[A-Za-z0-9_-]{43}(?![A-Za-z0-9_-])", marks=("SG.",)),
    Rule("npm", 1, r"(?<![A-Za-z0-9_])npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])", bits=3.0, marks=("npm_",)),
    Rule("pypi", 1, r"(?<![A-Za-z0-9_-])pypi-AgE[A-Za-z0-9_-]{50,}+", marks=("pypi-AgE",)),
    Rule("storage_key", 1, r"AccountKey=[A-Za-z0-9+/]{86}==", marks=("AccountKey=",)),
    Rule("url_password", 1, r"(?<=://)[A-Za-z0-9._~%+-]{1,64}:([^\s:/@]{3,64})@[A-Za-z0-9.-]", 1, 3, marks=("://",)),
    Rule("random_string", 1, r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_-]*[0-9])[A-Za-z0-9+/_-]{40,128}(?![A-Za-z0-9+/_-])={0,2}", bits=4.5),
)
RULES = (*BASE_RULES, *FORMS)
LEDGER = "blob string, rules array<string>, findings array<struct<rule:string,start:long,end:long>>"


def entropy(text: str) -> float:
    """Bits for each character, from the characters' own frequencies."""
    n = len(text)
    return -sum(k / n * math.log2(k / n) for k in Counter(text).values())


def find(text: str, rule: Rule, pattern: re.Pattern) -> list[tuple[str, int, int]]:
    """(rule, start, end) in code points, end exclusive."""
    if rule.marks and not any(mark in text for mark in rule.marks):
        return []
    return [
        (rule.name, m.start(), m.end())
        for m in pattern.finditer(text)
        if m.end(rule.group) - m.start(rule.group) >= rule.least and (not rule.bits or entropy(m[rule.group]) >= rule.bits)
    ]


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger so far; an append of no rows makes sure that there is one."""
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def _blob() -> F.Column:
    return F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob")


def unseen(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """blob, text, missing: one row per blob that some wanted rule has not met."""
    wanted = F.array(*[F.lit(r.name) for r in rules])
    met = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules"))
    met = met.withColumn("missing", F.array_except(wanted, "rules")).select("blob", "missing")
    versions = docs.select(_blob(), F.coalesce("text", F.lit("")).alias("text"))
    blobs = versions.join(met.where(F.size("missing") == 0), "blob", "left_anti").groupBy("blob").agg(F.first("text").alias("text"))
    return blobs.join(met, "blob", "left").select("blob", "text", F.coalesce("missing", wanted).alias("missing"))


def scan_new(docs: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger does not cover, and append it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # ASCII: the two characters outside it that fold to "k" and "s" are no letters here
        known = {r.name: (r, re.compile(r.pattern, re.ASCII)) for r in rules}
        kind = pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            out = []
            for text, missing in zip(b.column("text"), b.column("missing").to_pylist(), strict=True):
                t = text.as_py()
                hits = [x for name in missing for x in find(t, *known[name])]
                out.append([{"rule": r, "start": a, "end": z} for r, a, z in hits])
            yield pa.RecordBatch.from_arrays([b.column("blob"), b.column("missing"), pa.array(out, kind)], ["blob", "rules", "findings"])

    ledger = _ledger(docs.sparkSession, ledger_path)
    unseen(docs, ledger, rules).mapInArrow(run, LEDGER).write.mode("append").parquet(ledger_path)


def findings(docs: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, blob, spans (start, rank, end, kind) of every document, from the
    ledger; sorted by start and then by the rules' order."""
    order = {r.name: (k, r.kind) for k, r in enumerate(rules)}
    ledger = _ledger(docs.sparkSession, ledger_path).where(F.size("findings") > 0)
    hit = ledger.select("blob", F.explode("findings").alias("f")).where(F.col("f.rule").isin(*order)).distinct()
    rank = F.coalesce(*[F.when(F.col("f.rule") == n, F.lit(k)) for n, (k, _) in order.items()])
    kind = F.coalesce(*[F.when(F.col("f.rule") == n, F.lit(kind)) for n, (_, kind) in order.items()])
    span = F.struct(F.col("f.start").alias("start"), rank.alias("rank"), F.col("f.end").alias("end"), kind.alias("kind"))
    spans = hit.groupBy("blob").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    return docs.select("doc_id", _blob()).join(spans, "blob", "left").select(
        "doc_id", "blob", F.coalesce("spans", F.array().cast("array<struct<start:long,rank:int,end:long,kind:string>>")).alias("spans")
    )


def scan_secrets(docs: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    scan_new(docs, ledger_path, rules)
    return findings(docs, ledger_path, rules)


def compact(spark: SparkSession, ledger_path: str, new_path: str) -> None:
    """Write the ledger to ``new_path`` with one row per blob, in as many files as
    its size asks for, in place of a few for every run. The old one stays as it is:
    point later runs at the new one and remove the old when none reads it."""
    met = spark.read.schema(LEDGER).parquet(ledger_path).groupBy("blob").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("rules")))).alias("rules"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("findings")))).alias("findings"),
    )
    met.hint("rebalance").write.parquet(new_path)
