"""Vectors of texts against the same hashing done by the engine."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from parchline.functions.text import tokens
from parchline.functions.vector import DIM, bucket_counts, hash_embedding, token_codes


def test_vectors_equal_the_engines_hashing_and_leave_it_out(spark):
    texts = [None, "", " .", "a", "A a b", "İstanbul K 7 é x9", "word " * 500] + [f"t{i} t{i * 7 % 13} same" for i in range(50)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").coalesce(1)
    found = frame.select("id", hash_embedding(F.col("text")).alias("v"), token_codes(tokens(F.col("text"))).alias("c"))
    rows = sorted(found.collect(), key=lambda r: r["id"])
    counts = bucket_counts(pd.Series([r["c"] for r in rows]), DIM)
    norm = np.sqrt((counts**2).sum(axis=1, keepdims=True))
    wanted = np.divide(counts, norm, out=np.zeros_like(counts), where=norm > 0).astype(np.float32)
    assert np.array_equal(np.array([r["v"] for r in rows], np.float32), wanted)
    # One md5 in the engine for every word of every text was most of the searches' time.
    plan = frame.select(hash_embedding(F.col("text")))._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan


def test_a_batch_without_words_gives_zeros(spark):
    frame = spark.createDataFrame([("",), ("...",), (None,)], "text string").coalesce(1)
    assert [sum(map(abs, r[0])) for r in frame.select(hash_embedding(F.col("text"))).collect()] == [0.0] * 3
