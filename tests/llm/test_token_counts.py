"""Length histogram and suffix sums against the library and plain sums."""

from __future__ import annotations

import public_tokenizers
import pytest
import tiktoken

from tidewater.llm import bpe, queries, token_counts

SF = "/root/testdata/sf0.001"


def answers(lengths):
    out = set()
    for x in set(lengths):
        fit = [y for y in lengths if y <= x]
        longer = len(lengths) - len(fit)
        cut = sum(min(y, x) for y in lengths)
        out.add((x, lengths.count(x), longer, sum(lengths) - sum(fit), len(fit), sum(fit), cut, len(fit) / len(lengths)))
    return out


LENGTHS = [[], [0], [0, 0, 3, 3, 3, 9], [5000, 4095, 4096, 4097, 8191, 8192, 1, 1, 100_000, 5000]]


@pytest.mark.parametrize("lengths", LENGTHS)
def test_suffix_sums(spark, lengths):
    hist = token_counts.histogram(spark.createDataFrame([(x,) for x in lengths], "n_tokens long").repartition(3))
    sums = token_counts.suffix_sums(hist)
    assert {tuple(r) for r in sums.collect()} == answers(lengths)
    limits = [0, 2, 4096, 10**6]
    for r in token_counts.at_limits(sums, limits).collect():
        x = r["context_limit"]
        fit = [y for y in lengths if y <= x]
        assert tuple(r) == (x, len(fit), sum(fit), len(lengths) - len(fit), sum(min(y, x) for y in lengths))
    for r in token_counts.quantiles(sums, [0.01, 0.5, 1.0]).collect():
        assert r["n_tokens"] == min(x for x in lengths if sum(y <= x for y in lengths) >= r["share"] * len(lengths))


def test_query_matches_the_library(spark):
    with open(queries.RANKS, "rb") as f:
        ranks = bpe.vocabulary(f.read()).ranks
    lib = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()
    assert {tuple(r) for r in queries.op8_token_counts(spark, SF).collect()} == answers([len(lib.encode_ordinary(r["text"])) for r in rows])


def test_null_empty_and_long_texts(spark):
    docs = spark.createDataFrame([(None, 1), ("", 2), ("a" * 100_000, 3), ("", 2)], "text string, n_tokens int")
    got = [r["n_tokens"] for r in token_counts.lengths(docs, queries.RANKS, public_tokenizers.PATTERN).collect()]
    assert sorted(got)[:3] == [0, 0, 0] and len(got) == 4 and max(got) > 1000
