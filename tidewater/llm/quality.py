"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Each document becomes a vector of five transformed statistics. Per language and
source, a minimum-covariance-determinant (MCD) estimate of location and scatter
is found by concentration steps over all documents of the group, and documents
far from it by Mahalanobis distance are rejected. DataFrame functions only.

Concentration starts twice, from medians and median absolute deviations and from
the mean and covariance of all documents, and goes on until no group's determinant
falls any more; of all steps of both, the estimate of least determinant is each
group's. A concentration step is one aggregation: documents are bucketed by their
distance under the current estimate, and each bucket carries count, sums and
cross products, so a group of any size shrinks map-side to at most a few hundred
rows; the buckets up to the quantile ``H_SHARE`` give the next estimate. The
statistics are whole thousandths, so every sum is exact and the result does not
depend on task order or on tasks that run again.

Defined results: a null or empty text has no words and fails the base rule;
null lang or source is a group of its own; groups under ``min_group`` documents
pool with the other small groups of their language, then with the rest of the
corpus, and where even that pool is too small only the base rule decides;
repeated rows each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import WHITE, WHITE_CLASS, row_key, scratch, written

SYMBOLS = "#*$%&|<>"
D = 5
H_SHARE = 0.75
MIN_GROUP = 50
#: Bound on the concentration steps from one start.
STEPS = 8


def chi_square_above(x: float) -> float:
    """The share of the chi-square distribution with five degrees of freedom
    above ``x``."""
    return math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * (1 + x / 3)


def chi_square_quantile(above: float) -> float:
    """Where this share of the distribution lies above."""
    low, high = 0.0, 1000.0
    while high - low > 1e-9:
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_above(middle) > above else (low, middle)
    return high


CHI_H, CHI_REWEIGHT = chi_square_quantile(1 - H_SHARE), chi_square_quantile(0.025)
#: Squared robust distance above which a document is rejected: of documents that
#: follow their group's distribution, one in a hundred thousand million lies beyond,
#: so that a large corpus loses none of them by its size.
CUTOFF = chi_square_quantile(1e-11)
#: Least standard deviation of each statistic, in thousandths. Most documents
#: have no symbols and no repeated lines; the floor keeps the scatter regular.
FLOOR = (40, 35, 100, 120, 35)
#: Distance buckets per unit of ln(1 + d2).
BUCKETS = 40


def base_statistics(docs: DataFrame) -> DataFrame:
    """Counts of the base rule and what the vector needs, one row per document.

    The words are put in one line with single spaces, overlapping three-word
    windows are cut from it and digested to 64 bits, and a window that occurs
    again within its text is found by sorting the text's (digest, place) pairs.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", "lang", "source", row_key(F.col("doc_id"), F.col("text")).alias("row_key"), text.alias("t"))
    d = d.withColumn("n", F.regexp_replace(F.btrim("t", F.lit(WHITE)), WHITE_CLASS + "+", " "))
    triple = "(?=([^ ]++ [^ ]++ [^ ]++))[^ ]++ "
    d = d.withColumn("h", F.transform(F.regexp_extract_all("n", F.lit(triple), F.lit(1)), lambda x: F.xxhash64(x)))
    d = d.withColumn("sorted", F.when(
        F.size(F.array_distinct("h")) < F.size("h"),
        F.sort_array(F.arrays_zip("h", F.sequence(F.lit(0), F.size("h") - 1).alias("i"))),
    ))
    s = F.col("sorted")
    twice = F.filter(
        s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))
    )
    few = F.when(F.col("n") == "", 0).otherwise(1 + F.length("n") - F.length(F.replace("n", F.lit(" "), F.lit(""))))
    d = d.withColumns({
        "starts": F.transform(twice, lambda x: x["i"]),
        "n_words": F.when(F.size("h") > 0, F.size("h") + 2).otherwise(few).cast("long"),
        "lines": F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != ""),
        "signs": F.regexp_replace("t", f"[^{SYMBOLS}\\p{{Lu}}]+", ""),
    })
    # empty, not null, for texts without a repeat: the size of null depends on the session's ANSI setting
    covered = F.coalesce(
        F.concat("starts", F.transform("starts", lambda x: x + 1), F.transform("starts", lambda x: x + 2)), F.array().cast("array<int>")
    )
    n_symbols = F.length(F.regexp_replace("signs", f"[^{SYMBOLS}]+", ""))
    return d.select(
        "doc_id", "lang", "source", "row_key", "n_words",
        (F.length("n") - F.greatest(F.col("n_words") - 1, F.lit(0))).cast("long").alias("word_chars"),
        n_symbols.cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(covered)).cast("long").alias("n_repeat_words"),
        (F.length("signs") - n_symbols).cast("long").alias("n_upper"),
    )


def vectors(stats: DataFrame) -> DataFrame:
    """Adds base_failed and the statistics x0..x4 in whole thousandths: log mean
    word length, and square roots of the shares of symbols, repeated lines,
    repeated words and capitals."""
    chars, words = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1))
    share = lambda a, b: F.sqrt(F.col(a) / b)
    values = (
        F.ln(chars / words), share("n_symbols", chars), share("n_dup_lines", F.greatest("n_lines", F.lit(1))),
        share("n_repeat_words", words), share("n_upper", chars),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumns(
        {f"x{k}": F.round(v * 1000).cast("long") for k, v in enumerate(values)}
    )


def _cells(v: DataFrame, min_group: int) -> DataFrame:
    """(lang, source) -> cell: the group itself, its language's pool of small
    groups, the pool of what is left, or null if that is too small as well."""
    n = v.where(~F.col("base_failed")).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    name = lambda *c: F.to_json(F.struct(*c), {"ignoreNullFields": "false"})
    n = n.withColumn("own", F.col("n") >= min_group)
    rest = n.where(~F.col("own")).groupBy(F.col("lang").alias("l")).agg(F.sum("n").alias("n_lang"))
    rest = rest.withColumn("by_lang", F.col("n_lang") >= min_group)
    enough = rest.where(~F.col("by_lang")).agg((F.sum("n_lang") >= min_group).alias("enough"))
    last = bool(enough.first()["enough"])
    return n.join(rest, n["lang"].eqNullSafe(rest["l"]), "left").select(
        n["lang"].alias("cl"), n["source"].alias("cs"),
        F.when(F.col("own"), name(n["lang"], n["source"]))
        .when(F.col("by_lang"), name(n["lang"]))
        .otherwise(F.lit("{}" if last else None)).alias("cell"),
    )


def _chol(k: int, j: int) -> str:
    return f"l{k}{j}"


def _with_distance(frame: DataFrame) -> DataFrame:
    """Adds ``d2``, the squared Mahalanobis distance of x0..x4, by forward
    substitution with the columns m0..m4 and the Cholesky factor l00..l44. Each
    y is named once and used by the later ones in the same projection."""
    y = []
    for k in range(D):
        inner = "".join(f" - {_chol(k, j)} * y{j}" for j in range(k))
        y.append(f"(x{k} - m{k}{inner}) / {_chol(k, k)} AS y{k}")
    total = " + ".join(f"y{k} * y{k}" for k in range(D))
    return frame.selectExpr("*", *y, f"{total} AS d2").drop(*[f"y{k}" for k in range(D)])


def _factored(moments: DataFrame) -> DataFrame:
    """cell, n, s0..s4, p00..p44 (sums and cross products) -> location and
    Cholesky factor of the scatter, its diagonal raised by the squared floor."""
    columns = [f"s{k} / n AS m{k}" for k in range(D)]
    for k in range(D):
        for j in range(k + 1):
            cov = f"p{k}{j} / n - m{k} * m{j}"
            cov = f"greatest({cov}, 0.0D) + {FLOOR[k] ** 2}" if j == k else cov
            rest = cov + "".join(f" - {_chol(k, i)} * {_chol(j, i)}" for i in range(j))
            # rounding can leave a pivot a little under the floor it cannot truly go below
            value = f"sqrt(greatest({rest}, 1.0D))" if j == k else f"({rest}) / {_chol(j, j)}"
            columns.append(f"{value} AS {_chol(k, j)}")
    return moments.selectExpr("cell", *columns, "edge", " + ".join(f"2 * ln({_chol(k, k)})" for k in range(D)) + " AS logdet")


def _start(v: DataFrame, path: str) -> DataFrame:
    """Median and median absolute deviation of each statistic and cell. The
    statistics take a few thousand whole values, so the exact percentile's
    value counts stay small however many documents there are."""
    # written, so that Spark knows its size and need not deal the documents out by cell
    med = written(v.groupBy("cell").agg(*[F.percentile(f"x{k}", 0.5).alias(f"m{k}") for k in range(D)]), f"{path}/medians")
    dev = v.join(med, "cell").groupBy("cell").agg(
        *[F.first(f"m{k}").alias(f"m{k}") for k in range(D)],
        *[F.percentile(F.abs(F.col(f"x{k}") - F.col(f"m{k}")), 0.5).alias(f"d{k}") for k in range(D)],
    )
    factor = {
        _chol(k, j): F.greatest(F.col(f"d{k}") * 1.4826, F.lit(float(FLOOR[k]))) if k == j else F.lit(0.0)
        for k in range(D) for j in range(k + 1)
    }
    return dev.select("cell", *[f"m{k}" for k in range(D)], *[c.alias(n) for n, c in factor.items()], F.lit(CHI_H).alias("edge"))


SUMS = {f"s{k}": f"x{k}" for k in range(D)} | {f"p{k}{j}": f"x{k} * x{j}" for k in range(D) for j in range(k + 1)}


def _classical(v: DataFrame) -> DataFrame:
    """Mean and covariance of all documents of each cell."""
    sums = v.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *[F.expr(f"sum({x}) AS {c}") for c, x in SUMS.items()])
    doubles = [F.expr(f"CAST({c} AS DOUBLE) AS {c}") for c in ("n", *SUMS)]
    return _factored(sums.select("cell", *doubles, F.lit(CHI_H).alias("edge"))).drop("logdet")


def _concentrate(v: DataFrame, params: DataFrame, reweight: bool, path: str) -> DataFrame:
    """The next estimate: from the nearest ``H_SHARE`` of each cell, or in the
    last step from every document within the 0.975 chi-square quantile."""
    scale = CHI_H / F.col("edge") if reweight else F.lit(1.0)
    b = (
        _with_distance(v.join(params.drop("logdet"), "cell")).withColumn("bucket", F.floor(F.ln(1 + F.col("d2") * scale) * BUCKETS))
        .groupBy("cell", "bucket").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.expr(f"sum({x}) AS {c}") for c, x in SUMS.items()],
        )
    )
    # written, so that rows are dealt out by cell and bucket, and only the few sums by cell
    b = written(b, f"{path}-buckets")
    whole = W.partitionBy("cell")
    before = F.coalesce(F.sum("n").over(whole.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    upper = F.exp((F.col("bucket") + 1) / BUCKETS) - 1
    b = b.withColumn("near", before < F.ceil(F.sum("n").over(whole) * H_SHARE))
    inside = (F.col("bucket") <= F.floor(F.ln(F.lit(1 + CHI_REWEIGHT)) * BUCKETS)) | F.col("near") if reweight else F.col("near")
    moments = b.where(inside).groupBy("cell").agg(
        *[F.expr(f"CAST(sum(CAST({c} AS DECIMAL(38, 0))) AS DOUBLE) AS {c}") for c in ("n", *SUMS)],
        F.max(upper).alias("edge"),
    )
    return _factored(moments)


def _least(estimates: list[DataFrame]) -> DataFrame:
    """Each cell's estimate of least determinant."""
    every = reduce(DataFrame.unionByName, estimates)
    best = every.groupBy("cell").agg(F.min_by(F.struct(*every.columns), F.struct("logdet", *[f"m{k}" for k in range(D)])).alias("e"))
    return best.select("e.*")


def _converged(v: DataFrame, start: DataFrame, path: str) -> list[DataFrame]:
    """The estimates of the concentration steps from ``start``, until no cell's
    determinant falls by a millionth."""
    found = [written(_concentrate(v, start, False, f"{path}0"), f"{path}0")]
    for step in range(1, STEPS):
        found.append(written(_concentrate(v, found[-1], False, f"{path}{step}"), f"{path}{step}"))
        lower = found[-1].select("cell", F.col("logdet").alias("now")).join(_least(found[:-1]), "cell")
        if lower.where(F.col("now") < F.col("logdet") - 1e-6).isEmpty():
            break
    return found


def estimate(v: DataFrame, path: str) -> DataFrame:
    """Location and Cholesky factor of the scatter of each cell of ``v`` (cell,
    x0..x4): the least determinant over both starts, then one reweighting."""
    starts = {"median": _start(v, path), "mean": _classical(v)}
    steps = [e for name, start in starts.items() for e in _converged(v, written(start, f"{path}/{name}"), f"{path}/{name}-")]
    least = written(_least(steps), f"{path}/least")
    return _concentrate(v, least, True, f"{path}/reweighted").drop("logdet")


def robust_quality(docs: DataFrame, min_group: int = MIN_GROUP, cutoff: float = CUTOFF) -> DataFrame:
    """One row per document: the base counts, ``base_failed``, the robust squared
    ``distance`` (null where no estimate applies) and ``kept``. ``docs`` has
    doc_id, text, lang and source."""
    spark = docs.sparkSession
    path = scratch(spark, "quality")
    v = written(vectors(base_statistics(docs)), f"{path}/vectors")
    cells = written(_cells(v, min_group), f"{path}/cells")
    keyed = v.join(cells, v["lang"].eqNullSafe(cells["cl"]) & v["source"].eqNullSafe(cells["cs"]), "left").drop("cl", "cs")
    used = keyed.where(~F.col("base_failed") & F.col("cell").isNotNull())
    params = written(estimate(used, path), f"{path}/final")
    return _with_distance(keyed.join(params, "cell", "left")).select(
        "doc_id", "row_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.round("d2", 6).alias("distance"),
    ).withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True)))
