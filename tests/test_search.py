"""Top-k by every route equals brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parchline.functions.vector import hash_embedding
from parchline.operators import search

GROUPS = [None, "a", "b"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    items = [(f"i{n:04d}", rng.normal(size=6).round(1).tolist(), GROUPS[n % 3]) for n in range(300)]
    items += [(f"j{n:04d}", items[0][1], "a") for n in range(40)]  # many ties
    queries = [(q, rng.normal(size=6).tolist(), [["a"], ["a", "b"], []][q % 3]) for q in range(7)]
    corpus = spark.createDataFrame(items, "item_id string, vector array<float>, acl_group string").repartition(5)
    asked = spark.createDataFrame(queries, "query_id bigint, vector array<double>, groups array<string>")
    return items, queries, corpus, asked


def brute(items, queries, k, filtered):
    out = {}
    for q, v, groups in queries:
        scored = []
        for i, w, g in items:
            if filtered and g not in groups:
                continue
            w = np.float32(w).astype(float)
            scored.append((-round(float(np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w))), 6), i))
        out[q] = [i for _, i in sorted(scored)[:k]]
    return {q: ids for q, ids in out.items() if ids}


def ranked(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append(r["item_id"])
    return out


@pytest.mark.parametrize("filtered", [False, True])
@pytest.mark.parametrize("limits", [{}, {"max_shipped": 2, "shard_rows": 40}])
def test_dense(data, filtered, limits):
    items, queries, corpus, asked = data
    if not filtered:
        corpus, asked = corpus.drop("acl_group"), asked.drop("groups")
    assert ranked(search.dense_topk(corpus, asked, 9, **limits)) == brute(items, queries, 9, filtered)


def test_bm25_routes_agree_with_brute_force(spark):
    rng = np.random.default_rng(2)
    words = "alpha beta gamma delta the of".split()
    docs = [(f"d{n:03d}", " ".join(rng.choice(words, size=rng.integers(0, 15))), GROUPS[n % 3]) for n in range(120)]
    asked = [(0, "alpha the the"), (1, "Delta, beta!"), (2, "unknown"), (3, "of")]
    corpus = spark.createDataFrame(docs, "item_id string, text string, acl_group string").repartition(4)
    queries = spark.createDataFrame(asked, "query_id bigint, text string")
    split = {i: t.split() for i, t, _ in docs}
    mean = sum(map(len, split.values())) / len(docs)
    expected = {}
    for q, text in asked:
        scores = []
        for i, own in split.items():
            score = 0.0
            for term in set(text.lower().replace(",", "").replace("!", "").split()):
                df = sum(term in w for w in split.values())
                tf = own.count(term)
                idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(own) / mean)) if tf else 0
            if score > 0:
                scores.append((-round(score, 6), i))
        if scores:
            expected[q] = [i for _, i in sorted(scores)[:5]]
    plain = corpus.drop("acl_group")
    assert ranked(search.bm25_topk(plain, queries, 5)) == expected
    assert ranked(search.bm25_topk(plain, queries, 5, max_shipped=2, shard_rows=50)) == expected
    mine = queries.withColumn("groups", F.array(F.lit("a")))
    shipped = ranked(search.bm25_topk(corpus, mine, 5))
    assert shipped == ranked(search.bm25_topk(corpus, mine, 5, max_shipped=2))
    group = {i: g for i, _, g in docs}
    assert all(group[i] == "a" for ids in shipped.values() for i in ids)


def test_empty_corpus(spark):
    corpus = spark.createDataFrame([], "item_id string, text string")
    queries = spark.createDataFrame([(1, "x")], "query_id bigint, text string")
    assert search.bm25_topk(corpus, queries, 3).count() == 0


def test_model_mismatch_is_refused(spark):
    gold = spark.createDataFrame([("m1",), ("m1",)], "embedding_model string")
    search.require_model(gold, "m1")
    with pytest.raises(ValueError):
        search.require_model(gold, "m2")
    with pytest.raises(ValueError):
        search.require_model(gold.union(spark.createDataFrame([("m2",)], "embedding_model string")), "m1")


def test_vectors_have_unit_length(spark):
    frame = spark.createDataFrame([("some words here",), ("",), ("...",)], "t string")
    vectors = [np.array(r[0]) for r in frame.select(hash_embedding(F.col("t"))).collect()]
    assert [round(float(np.linalg.norm(v)), 5) for v in vectors] == [1.0, 0.0, 0.0]


def test_hits_of_many_tasks_rank_as_a_whole(spark):
    rng = np.random.default_rng(3)
    rows = [(int(q), f"i{n:04d}", float(s)) for n, (q, s) in enumerate(zip(rng.integers(0, 3, 600), rng.integers(0, 9, 600)))]
    scores = spark.createDataFrame(rows, search.HITS).repartition(13)
    whole = {tuple(r) for r in search.rank_hits(scores, 7).collect()}
    assert {tuple(r) for r in search.rank_task_hits(scores, 7, deals=5).collect()} == whole and len(whole) == 21
