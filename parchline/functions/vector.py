"""Feature-hashed text vectors and vector arithmetic.

Tokens are cut in the JVM. For a text's vector they travel to Python as Arrow lists, where each distinct one
of a batch is hashed once; elsewhere they become bucket numbers in the JVM and only those integers travel.
Whole Arrow batches are summed with numpy. No shuffle: a vector depends on its own row only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from .identity import hash_number
from .text import tokens

DIM = 64


def token_codes(words: Column, dim: int = DIM) -> Column:
    """Each token as a number below ``2 * dim``: its bucket, plus ``dim`` where its sign is negative."""
    return F.transform(words, lambda w: F.pmod(hash_number(w), F.lit(2 * dim)).cast("int"))


def bucket_counts(codes: pd.Series, dim: int) -> np.ndarray:
    """One row of signed counts per input list."""
    sizes = np.array([0 if c is None else len(c) for c in codes], dtype=np.int64)
    if not sizes.sum():
        return np.zeros((len(codes), dim))
    flat = np.concatenate([c for c in codes if c is not None and len(c)]).astype(np.int64)
    cell = np.repeat(np.arange(len(codes)), sizes) * dim + flat % dim
    sign = np.where(flat < dim, 1.0, -1.0)
    return np.bincount(cell, weights=sign, minlength=len(codes) * dim).reshape(-1, dim)


def word_counts(lists: pa.Array, dim: int) -> np.ndarray:
    """``bucket_counts`` of the ``token_codes`` of word lists (null: empty), each distinct word hashed once."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    if not sizes.sum():
        return np.zeros((len(lists), dim))
    words = lists.flatten().dictionary_encode()
    known = words.dictionary.cast(pa.binary()).to_pylist()
    codes = np.array([int.from_bytes(hashlib.md5(w).digest()[:4], "big") % (2 * dim) for w in known], np.int64)
    flat = codes[words.indices.to_numpy(zero_copy_only=False)]
    cell = np.repeat(np.arange(len(lists)), sizes) * dim + flat % dim
    return np.bincount(cell, weights=np.where(flat < dim, 1.0, -1.0), minlength=len(lists) * dim).reshape(-1, dim)


def _unit_vectors(dim: int):
    @F.arrow_udf("array<float>")
    def unit(words: pa.Array) -> pa.Array:
        counts = word_counts(words, dim)
        norm = np.sqrt((counts**2).sum(axis=1, keepdims=True))
        vectors = np.divide(counts, norm, out=np.zeros_like(counts), where=norm > 0)
        ends = pa.array(np.arange(len(counts) + 1) * dim, pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(vectors.astype(np.float32).ravel()))

    # Declared nondeterministic so that the optimizer neither repeats nor moves the call.
    return unit.asNondeterministic()


def hash_embedding(text: Column, dim: int = DIM) -> Column:
    """Unit-length feature-hashed vector of a text; zeros for a text without tokens."""
    return _unit_vectors(dim)(tokens(text))


def adjacent_cosine(sentence_array: Column, dim: int = DIM) -> Column:
    """Cosine of each sentence with the one before (first entry 1, empty sentences 0)."""

    @F.pandas_udf("array<double>")
    def similarity(docs: pd.Series) -> pd.Series:
        lists = [[] if d is None else list(d) for d in docs]
        counts = bucket_counts(pd.Series([s for d in lists for s in d], dtype=object), dim)
        power = (counts**2).sum(axis=1)
        out, at = [], 0
        for d in lists:
            block, weight = counts[at : at + len(d)], power[at : at + len(d)]
            at += len(d)
            values = np.ones(len(d))
            if len(d) > 1:
                dot = (block[1:] * block[:-1]).sum(axis=1)
                scale = np.sqrt(weight[1:] * weight[:-1])
                values[1:] = np.divide(dot, scale, out=np.zeros_like(dot), where=scale > 0)
            out.append(values)
        return pd.Series(out)

    return similarity.asNondeterministic()(F.transform(sentence_array, lambda s: token_codes(tokens(s), dim)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine in double precision; NULL if either vector is zero."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)))
