"""Quality rules against a brute-force count and known outliers."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest

from tidewater.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string, h long, n string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(hit), len(words) < 50 or 100 * len(hit) > 50 * len(words),
    )


TEXTS = [
    None, "", " \n\t\x0b\x0c\r ", "one", "one two", "a b c", "a b c a b c", "a a a a a", "x\ny\nx\n \n \nx",
    " word two  \u0085 \x1c é", "€ 😀 #*$%&|<>" * 9, "la la la " * 40, "p q r s " * 3 + " ".join(map(str, range(90))),
    " ".join(f"w{i % 997}" for i in range(40_000)), "tail line\n" + "Word " * 60 + "\ntail line",
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_base_counts_match_brute_force(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        check_base_counts(spark)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def check_base_counts(spark):
    got = quality.base_statistics(frame(spark, [(i, t, "en", "s") for i, t in enumerate(TEXTS[:-2] + TEXTS[-1:])]))
    got = {r["doc_id"]: r for r in quality.vectors(got).collect()}
    for i, t in enumerate(TEXTS[:-2] + TEXTS[-1:]):
        r = got[i]
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == base(t), t


def test_very_long_text(spark):
    r = quality.base_statistics(frame(spark, [(1, TEXTS[-2], None, None)])).first()
    assert (r["n_words"], r["n_repeat_words"]) == (40_000, 40_000)


def plain(i, n=80):
    return " ".join("abcdefghijklmnopq"[: 3 + (i * 7 + j * j) % 6] + str((i * 31 + j) % 1009) for j in range(n)) + "."


def test_outliers_are_rejected_and_plain_documents_kept(spark):
    rows = [(i, plain(i), ("en", "de", None)[i % 3], None if i % 7 == 0 else f"s{i % 2}") for i in range(400)]
    rows += [(1000 + i, plain(i).replace(" ", " | "), "en", "s0") for i in range(5)]
    rows += [(2000, plain(3), "xx", "tiny"), (2000, plain(3), "xx", "tiny"), (None, plain(5), "en", "s1"), (2001, None, None, None)]
    got = quality.robust_quality(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert all(r["kept"] for r in got if r["doc_id"] is None or r["doc_id"] < 1000 or r["doc_id"] == 2000)
    assert not any(r["kept"] for r in got if r["doc_id"] and 1000 <= r["doc_id"] < 2000)
    assert [r["kept"] for r in got if r["doc_id"] == 2001] == [False]
    again = quality.robust_quality(frame(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


@pytest.mark.parametrize("rows", [[], [(1, "just this", "en", "s")]])
def test_empty_and_tiny_tables(spark, rows):
    got = quality.robust_quality(frame(spark, rows)).collect()
    assert [(r["doc_id"], r["kept"]) for r in got] == [(r[0], False) for r in rows]


def test_no_python_on_the_main_path(spark):
    plan = quality.base_statistics(frame(spark, []))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def squared(x, location, scatter):
    y = np.linalg.solve(np.linalg.cholesky(scatter), (x - location).T)
    return (y * y).sum(axis=0)


def plain_mcd(x, share=0.75, steps=30):
    """Exact concentration from both starts, least determinant, one reweighting."""
    floor = np.diag(np.array(quality.FLOOR, dtype=float) ** 2)
    cov = lambda rows: np.diag(np.maximum(np.diag(c := np.cov(rows.T, bias=True)), 0)) + c - np.diag(np.diag(c)) + floor
    h, best = int(np.ceil(len(x) * share)), None
    median = np.median(x, axis=0)
    spread = np.maximum(1.4826 * np.median(np.abs(x - median), axis=0), quality.FLOOR)
    for location, scatter in ((median, np.diag(spread**2)), (x.mean(axis=0), cov(x))):
        for _ in range(steps):
            near = np.argsort(squared(x, location, scatter), kind="stable")[:h]
            location, scatter = x[near].mean(axis=0), cov(x[near])
            edge = squared(x[near], *((x[near].mean(axis=0), cov(x[near])))).max()
            det = np.linalg.slogdet(scatter)[1]
            if best is None or det < best[0] - 1e-9:
                best = (det, location, scatter, edge)
    _, location, scatter, _ = best
    d = squared(x, location, scatter)
    d *= quality.CHI_H / np.sort(d)[h - 1]
    inside = d <= quality.CHI_REWEIGHT
    return squared(x, x[inside].mean(axis=0), cov(x[inside]))


@pytest.mark.parametrize("seed", range(3))
def test_verdicts_match_a_plain_mcd(spark, seed):
    """Vectors of one cell: a cloud, a tight far group, and scattered outliers. The
    operator's distances come from buckets of distance, so they differ a little."""
    rng = np.random.default_rng(seed)
    mixing = rng.normal(size=(5, 5)) * 60
    good = rng.normal(size=(600, 5)) @ mixing
    far = rng.normal(size=(90, 5)) * 10 + rng.normal(size=5) * 3000
    wild = rng.normal(size=(40, 5)) * 4000
    x = np.round(np.concatenate([good, far, wild])).astype(int)
    rows = [("cell", k, *map(int, v)) for k, v in enumerate(x)]
    v = spark.createDataFrame(rows, "cell string, id int, x0 long, x1 long, x2 long, x3 long, x4 long").repartition(4)
    path = quality.scratch(spark, "mcd")
    params = quality.written(quality.estimate(v, path), f"{path}/params")
    got = {r["id"]: r["d2"] for r in quality._with_distance(v.join(params, "cell")).collect()}
    want = plain_mcd(x.astype(float))
    a, b = np.array([got[k] for k in range(len(x))]), want
    assert ((a > quality.CUTOFF) == (b > quality.CUTOFF)).mean() > 0.995
    assert (a[:600] <= quality.CUTOFF).all() and (a[600:690] > quality.CUTOFF).all()
    assert np.median(np.abs(a[:600] / b[:600] - 1)) < 0.1


def test_chi_square_quantiles():
    assert round(quality.CHI_H, 3) == 6.626 and round(quality.CHI_REWEIGHT, 3) == 12.833 and 59 < quality.CUTOFF < 62
    assert quality.chi_square_above(0) == 1


def test_verdicts_on_the_tables(spark):
    """``kept`` of the registered query against base rule and plain MCD per group."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    stats = quality.vectors(quality.base_statistics(docs)).collect()
    got = {r["doc_id"]: (r["kept"], r["distance"]) for r in quality.robust_quality(docs).collect()}
    cells = defaultdict(list)
    for r in stats:
        if r["base_failed"]:
            assert not got[r["doc_id"]][0]
        else:
            cells[r["lang"], r["source"]].append(r)
    pooled = defaultdict(list)
    for (lang, _), rows in cells.items():
        pooled[(lang, "own", id(rows)) if len(rows) >= quality.MIN_GROUP else (lang,)] += rows
    differ, total = 0, 0
    for rows in pooled.values():
        if len(rows) < quality.MIN_GROUP:
            continue
        want = plain_mcd(np.array([[r[f"x{k}"] for k in range(5)] for r in rows], dtype=float))
        for r, d in zip(rows, want, strict=True):
            total += 1
            differ += (d <= quality.CUTOFF) != got[r["doc_id"]][0]
    assert total > 500 and differ <= total * 0.005


def test_no_folder_is_written_twice(spark, monkeypatch):
    paths, written = [], quality.written
    monkeypatch.setattr(quality, "written", lambda frame, path: paths.append(path) or written(frame, path))
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert quality.robust_quality(docs).collect() == []
    assert len(paths) > 5 and len(paths) == len(set(paths))
