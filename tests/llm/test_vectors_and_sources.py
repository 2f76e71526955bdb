"""Exact top-k, source divergence and whitening against plain versions, on tables and on odd rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.compare import connect, difference
from slowdigest.llm import knn_join, source_divergence, whitening
from slowdigest.llm.oracles import ORACLES
from slowdigest.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>"
SQL = sorted(ORACLES)


@pytest.mark.parametrize("name", SQL)
def test_query_against_sql(spark, name):
    expected = connect(SF).execute(ORACLES[name]).df()
    assert difference(QUERIES[name](spark, SF).toPandas(), expected) is None


def test_every_query_without_sql_has_a_test_of_its_own():
    """Names of the brute-force tests; one must be added with each query that SQL cannot express."""
    tested = {
        "op1_quality_rules": "test_quality_rules",
        "op3_ngram_join": "test_ngram_join",
        "op4_histogram_shards": "test_shards",
        "op5_best_fit_packing": "test_packing",
        "op6_fingerprints": "test_fingerprints",
        "op8_lm_scoring": "test_lm_scoring",
        "op9_bpe": "test_encode_and_decode",
        "op10_suffix_dedup": "test_suffix_dedup",
        "op13_embedding_whitening": "test_whitening",
    }
    from tests.llm import test_operators

    assert set(QUERIES) == set(tested) | set(ORACLES)
    for test in tested.values():
        assert test in globals() or hasattr(test_operators, test)


# ---------------------------------------------------------------- exact top-k


def floors(v, scale=64):
    return [math.floor(scale * float(c)) for c in v]


def good(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def plain_top_k(rows, wanted, k):
    """Sorted (query id, rank, id, score) by comparing everything."""
    own = [(n, i, floors(v)) for n, (i, v) in enumerate(rows) if good(v)]
    out = []
    for n, i, q in own:
        if not wanted(i):
            continue
        scores = [(sum(a * b for a, b in zip(q, x)), j, m) for m, j, x in own if m != n]
        scores.sort(key=lambda s: (-s[0], s[1] is None, s[1] if s[1] is not None else 0))
        out += [(i, r + 1, j, s) for r, (s, j, _) in enumerate(scores[:k])]
    return sorted(out, key=repr)


def single(rows):
    """Components as the float column holds them."""
    return [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]


@pytest.fixture(scope="module")
def clustered():
    """Tight clusters of different sizes and lengths, evenly spread rows and a vector that a third repeat."""
    r = np.random.RandomState(3)
    made = [r.normal(size=8) for _ in range(150)]
    for c, n in ((0, 90), (1, 60), (2, 150)):
        centre = r.normal(size=8) * (6 + 4 * c)
        made += [centre + r.normal(size=8) * 0.02 for _ in range(n)]
    made += [made[5]] * 200
    order = r.permutation(len(made))
    return single([(int(n) + 1, [float(c) for c in made[j]]) for n, j in enumerate(order)])


@pytest.mark.parametrize(("per_set", "per_chunk", "pivots"), [(8192, 16384, 1024), (16, 40, 24), (5, 1000, 3)])
def test_top_k_in_cells_and_pool(spark, clustered, per_set, per_chunk, pivots):
    df = spark.createDataFrame(clustered, VECTORS).repartition(3)
    found = knn_join.top_k(
        df, F.col("vec_id") % 5 == 0, k=7, queries_per_set=per_set, rows_per_chunk=per_chunk, pivots=pivots
    ).collect()
    expected = plain_top_k(clustered, lambda i: i % 5 == 0, 7)
    assert sorted((tuple(r) for r in found), key=repr) == expected


def test_summaries_exclude_rows_that_cannot_be_found(spark, clustered):
    """Tight cells get sets of their own, which do not need most of the table."""
    rows = spark.createDataFrame(clustered, VECTORS).select(
        F.col("vec_id").alias("row"), (F.col("vec_id") % 5 == 0).alias("query"), knn_join.floored(F.col("embedding"), 64).alias("x")
    )
    space = knn_join._space(rows, 24)
    plan = knn_join.plan_sets(space, knn_join._summaries(rows, space), 7, 16, 40)
    alone = [c for c in plan.first if c != knn_join._POOL]
    assert alone and min(plan.needed[c] for c in alone) < len(clustered) // 3, plan.needed


ODD_VECTORS = [
    (20, [1.0, 2.0, 3.0]),
    (20, [1.0, 2.0, 3.0]),
    (40, [1.0, 2.0]),
    (60, []),
    (80, None),
    (100, [1.0, None, 2.0]),
    (120, [1.0, float("nan"), 2.0]),
    (140, [1.0, float("inf"), 2.0]),
    (None, [5.0, -1.0, 0.5]),
    (None, [5.0, -1.0, 0.5]),
    (7, [1.0, 2.0, 3.0]),
    (3, [1.0, 2.0, 3.0]),
    (160, [-0.001, 0.001, 0.0]),
]


def test_top_k_of_odd_rows(spark):
    df = spark.createDataFrame(ODD_VECTORS, VECTORS).repartition(4)
    for k in (1, 3, 50):
        found = sorted((tuple(r) for r in knn_join.top_k(df, F.col("vec_id") % 20 == 0, k=k).collect()), key=repr)
        assert found == plain_top_k(ODD_VECTORS, lambda i: i is not None and i % 20 == 0, k)
    assert knn_join.top_k(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert knn_join.top_k(df.filter("vec_id = 80"), F.col("vec_id") % 20 == 0).collect() == []
    assert knn_join.top_k(df, F.lit(False)).collect() == []
    alone = df.filter("vec_id = 40")
    assert knn_join.top_k(alone, F.col("vec_id") % 20 == 0).collect() == []


def test_top_k_of_large_components(spark):
    """Scores beyond the whole numbers of doubles, and beyond longs."""
    rows = [(20, [1e7, 3.0]), (1, [1e7, 2.0]), (2, [1e7, 4.0]), (3, [-1e7, 1.0])]
    found = knn_join.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 20)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_top_k(rows, lambda i: i == 20, 20)
    rows = [(20, [1e300]), (1, [1e300]), (2, [-1e300])]
    found = knn_join.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 20)
    assert [(r["vec_id"], r["score"]) for r in found.orderBy("rank").collect()] == [(1, 2**63 - 1), (2, -(2**63))]


def test_top_k_ignores_other_columns_and_refuses_text_ids(spark):
    df = spark.createDataFrame(ODD_VECTORS, "`my.id` long, `an.embedding` array<float>")
    for name in ("row", "id", "query", "x", "score", "rank", "query_id", "a.b"):
        df = df.withColumn(name, F.lit("other"))
    found = knn_join.top_k(df, F.col("`my.id`") % 20 == 0, k=3, row_id="my.id", vector="an.embedding")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_top_k(
        ODD_VECTORS, lambda i: i is not None and i % 20 == 0, 3
    )
    with pytest.raises(ValueError, match="whole numbers"):
        knn_join.top_k(df, F.lit(True), row_id="score", vector="an.embedding")


# ---------------------------------------------------------------- source divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_divergence(rows, least, top):
    rows = [tuple(c or "" for c in r) for r in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, documents, groups = defaultdict(Counter), Counter(), set()
    for lang, source, text in rows:
        terms = TERM.findall(text.translate(lower))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        documents.update((lang, t) for t in set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), n in documents.items() if x == lang and n >= least]
        sources = sorted(s for x, s in groups if x == lang)
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def share(count, t, total):
            return 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept))

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: share(count, t, total) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pair = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            term = [(f(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, n + 1) for n, (v, item) in enumerate(found[:most])]
    return sorted(out)


@pytest.fixture(scope="module")
def sourced():
    r = random.Random(5)
    words = ["a", "Zb", "hafen", "überfahrt", "eightchr", "nine_char", "ninechars", "sixteen" + "x" * 9, "漢字" * 4,
             "seventeen" + "y" * 8, "long" * 30, "other" * 24, "é", "ÄRGER", "x1y", "don't"]
    rows = []
    for lang in ("en", "de", None, "solo"):
        for source in ("s1", "s2", None, "ünï", "hot") if lang != "solo" else ("only",):
            for _ in range(20 if source == "hot" else 5):
                rows.append((lang, source, " ".join(r.choices(words, k=r.randint(0, 30)))))
    rows += [("empty", "e1", None), ("empty", "e2", ""), ("empty", "e2", "1 2 \x00 3"), ("en", "none", "!!"), ("", "", "a")]
    return rows + rows[:7] + [("de", "s1", "z" * 70_000 + " hafen\n" * 4000)]


@pytest.mark.parametrize(("least", "top", "bucket", "block", "held"), [(3, 10, 200_000, 8 << 20, 1 << 21), (1, 4, 9, 300, 40)])
def test_divergence(spark, sourced, monkeypatch, least, top, bucket, block, held):
    monkeypatch.setattr(source_divergence, "BLOCK", block)
    monkeypatch.setattr(source_divergence, "HELD", held)
    df = spark.createDataFrame(sourced, "lang string, source string, text string").repartition(4)
    found = source_divergence.divergence(df, least_documents=least, top=top, bucket_rows=bucket)
    assert found.schema["value"].dataType == T.LongType() and found.schema["rank"].dataType == T.IntegerType()
    assert sorted(tuple(r) for r in found.collect()) == plain_divergence(sourced, least, top)


def test_divergence_with_clashing_columns_and_of_nothing(spark, sourced):
    df = spark.createDataFrame(sourced, "`the.lang` string, `the.source` string, `the.text` string")
    for name in ("lang", "source", "text", "term", "n", "p", "total", "a.b"):
        df = df.withColumn(name, F.lit("other"))
    found = source_divergence.divergence(df, lang="the.lang", source="the.source", text="the.text", least_documents=3)
    assert sorted(tuple(r) for r in found.collect()) == plain_divergence(sourced, 3, 10)
    assert source_divergence.divergence(df.limit(0)).collect() == []


def test_terms_are_radix_sorted():
    r = np.random.RandomState(1)
    words = [r.randint(0, 3, 500).astype(np.uint64) << np.uint64(40 * (n % 2)) for n in range(2)]
    order = source_divergence.radix_order(words)
    assert (order == np.lexsort((words[1], words[0]))).all()


# ---------------------------------------------------------------- whitening


def plain_moments(rows, scale=64, offset=1_000_000):
    """Whole numbers and their exact covariance as fractions."""
    kept = [(i, floors(v, scale)) for i, v in rows if good(v)]
    width = max(len(v) for _, v in kept)
    xs = [[c + offset for c in v + [0] * (width - len(v))] for _, v in kept]
    n = len(xs)
    s = [sum(c) for c in zip(*xs)]
    cov = [[sum(Fraction(n * x[i] - s[i], n) * Fraction(n * x[j] - s[j], n) for x in xs) / n for j in range(width)] for i in range(width)]
    return [i for i, _ in kept], np.array(xs), n, s, cov


def check_whitened(spark, df, rows, components=32):
    model = whitening.fit(df, components=components)
    ids, xs, n, s, cov = plain_moments(rows)
    v = np.array([[float(c) for c in row] for row in cov])
    values = np.linalg.eigvalsh(v)[::-1]
    k = min(components, int((values > max(np.trace(v), 0) * len(v) * 1e-14).sum()))
    assert model.n == n and len(model.values) == k
    np.testing.assert_allclose(model.values, values[:k], rtol=1e-9)
    np.testing.assert_allclose(v @ model.vectors, model.vectors * model.values, atol=1e-9 * max(values[0], 1))
    np.testing.assert_allclose(model.vectors.T @ model.vectors, np.eye(k), atol=1e-12)
    np.testing.assert_allclose(model.explained, values[:k] / np.trace(v) if k else [], rtol=1e-9)
    assert whitening.identity_error(df, model) < 1e-9
    found = whitening.whiten(df, model).collect()
    deviation = [sum((n * int(c) - t) ** 2 for c, t in zip(x, s)) for x in xs]
    mean = [float(Fraction(t, n)) for t in s]
    whole = [[float(Fraction(int(c)) - Fraction(t, n)) for c, t in zip(x, s)] for x in xs]
    expected = np.array(whole) @ model.vectors / np.sqrt(model.values) if k else np.zeros((n, 0))
    assert len(mean) == len(v) and len(found) == n
    got = sorted(((r["vec_id"], int(r["deviation"]), r["whitened"]) for r in found), key=repr)
    want = sorted(((i, d, list(w)) for i, d, w in zip(ids, deviation, expected)), key=repr)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    np.testing.assert_allclose(
        sorted(np.round(g[2], 6).tolist() for g in got), sorted(np.round(w[2], 6).tolist() for w in want), atol=1e-6
    )
    return model


def test_whitening(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    model = check_whitened(spark, spark.createDataFrame(rows, VECTORS).repartition(3), rows[:] , components=32)
    found = QUERIES["op13_embedding_whitening"](spark, SF).collect()
    assert len(found) == len(rows) * len(model.values)
    assert {r["component"] for r in found} == set(range(1, 33))
    assert all(r["identity_error"] < 1e-9 and r["n"] == len(rows) for r in found)
    w = np.zeros((len(rows), 32))
    place = {i: n for n, (i, _) in enumerate(rows)}
    for r in found:
        w[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
    np.testing.assert_allclose(np.cov(w.T, bias=True), np.eye(32), atol=1e-9)


def test_whitening_of_odd_rows(spark):
    df = spark.createDataFrame(ODD_VECTORS, VECTORS).repartition(3)
    check_whitened(spark, df, ODD_VECTORS)
    same = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [0.5, 0.25])]
    check_whitened(spark, spark.createDataFrame(same, VECTORS), same)
    one = [(1, [0.5, 0.25])]
    check_whitened(spark, spark.createDataFrame(one, VECTORS), one)
    for nothing in (df.limit(0), df.filter("vec_id = 80")):
        assert whitening.fit(nothing) is None
        assert whitening.whiten(nothing, None).collect() == []
    bare = spark.createDataFrame([(1, []), (2, [])], VECTORS)
    assert [r["whitened"] for r in whitening.whiten(bare, whitening.fit(bare)).collect()] == [[], []]


def test_whitening_of_large_components(spark):
    """Squares beyond longs stay exact, beside small ones."""
    r = random.Random(2)
    rows = [(n, [r.uniform(-1, 1) * 10.0 ** r.choice((0, 3, 9)), r.uniform(-1, 1), 1e12]) for n in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    model = whitening.fit(df)
    ids, xs, n, s, cov = plain_moments(rows)
    v = np.array([[float(c) for c in row] for row in cov])
    np.testing.assert_allclose(model.values[0], np.linalg.eigvalsh(v)[-1], rtol=1e-12)
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(df, model).collect()}
    for i, x in zip(ids, xs):
        exact = sum((n * int(c) - t) ** 2 for c, t in zip(x, s))
        assert got[i] is None if exact >= 10**38 else int(got[i]) == exact


def test_whitening_keeps_other_columns(spark):
    df = spark.createDataFrame(ODD_VECTORS, "`my.id` long, `an.embedding` array<float>")
    df = df.withColumns({"x": F.lit("kept"), "x_": F.lit(1), "whitened": F.lit("old"), "a.b": F.lit(2)})
    model = whitening.fit(df, "an.embedding")
    found = whitening.whiten(df, model, "an.embedding")
    assert found.columns == ["my.id", "an.embedding", "x", "x_", "a.b", "whitened", "deviation"]
    assert {(r["x"], r["x_"], r["a.b"]) for r in found.collect()} == {("kept", 1, 2)}
