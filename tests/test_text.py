"""Text expressions against plain Python on generated input."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from parchline.functions.text import approx_tokens, fixed_pieces, is_blank, sentences, strip, structured_pieces, tokens

ALPHABET = "abc \n\t éß𝄞."


def windows(text: str, size: int, overlap: int) -> list[str]:
    width, step = 4 * size, 4 * (size - overlap)
    return [text] if len(text) <= width else [text[at : at + width] for at in range(0, len(text), step)]


def evaluate(spark, texts, expression):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["v"] for r in frame.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


texts = st.lists(st.text(alphabet=ALPHABET, max_size=90), min_size=1, max_size=30)
quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@quick
@given(texts)
def test_strip(spark, batch):
    batch = batch + ["\x1c a \x1f", "　x ", "\x85", ""]
    assert evaluate(spark, batch, strip) == [t.strip() for t in batch]
    assert evaluate(spark, batch, is_blank) == [not t.strip() for t in batch]


@quick
@given(texts, st.sampled_from([(4, 1), (3, 2), (5, 0), (8, 7)]))
def test_fixed_pieces(spark, batch, shape):
    size, overlap = shape
    batch = batch + ["x" * (4 * size), "x" * (4 * size + 1), ""]
    found = evaluate(spark, batch, lambda t: fixed_pieces(t, size, overlap))
    assert found == [windows(t, size, overlap) for t in batch]
    for text, pieces in zip(batch, found):
        assert all(len(p) <= 4 * size for p in pieces)
        assert "".join(p if i == 0 else p[4 * overlap :] for i, p in enumerate(pieces)) == text


def test_last_piece_may_lie_inside_the_one_before(spark):
    text = "x" * 15
    (pieces,) = evaluate(spark, [text], lambda t: fixed_pieces(t, 3, 2))
    assert [len(p) for p in pieces] == [12, 11, 7, 3]


def test_overlap_must_be_smaller():
    with pytest.raises(ValueError):
        fixed_pieces(F.lit("x"), 4, 4)


@quick
@given(st.lists(st.text(alphabet="ab \n", max_size=120), min_size=1, max_size=20))
def test_structured_pieces(spark, batch):
    def expected(text):
        if not text:
            return []
        if len(text) <= 16:
            return [text]
        return [piece for part in text.split("\n\n") if part.strip() for piece in windows(part, 4, 1)]

    assert evaluate(spark, batch, lambda t: structured_pieces(t, 4, 1)) == [expected(t) for t in batch]


def test_token_estimate_rounds_half_to_even(spark):
    lengths = [0, 2, 4, 6, 10, 14, 2048]
    assert evaluate(spark, ["x" * n for n in lengths], approx_tokens) == [max(1, round(n / 4)) for n in lengths]


def test_tokens_and_sentences(spark):
    assert evaluate(spark, ["A b-c, ", "..."], tokens) == [["a", "b", "c"], []]
    assert evaluate(spark, ["One. Two!\nThree  ", "\n"], sentences) == [["One.", "Two!", "Three"], []]
