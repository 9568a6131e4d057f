"""Text expressions: trimming, token estimates, tokens, window cuts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .binding import bind

# Fixed value: characters counted as one token.
CHARS_PER_TOKEN = 4

# Fixed value: the characters Python's str.strip removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends (a plain ``trim`` only removes blanks)."""
    return F.trim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def approx_tokens(text: Column) -> Column:
    """Token estimate from the length, ties to even, never below one."""
    return F.greatest(F.lit(1), F.bround(F.length(text) / F.lit(float(CHARS_PER_TOKEN))).cast("int"))


def tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def sentences(text: Column) -> Column:
    """Sentences: cut after ``.``, ``!`` or ``?`` followed by white space, or at line ends."""
    parts = F.split(text, r"(?<=[.!?])\s+|\n+")
    return F.array_remove(F.transform(parts, strip), "")


def fixed_pieces(text: Column, size: int, overlap: int) -> Column:
    """Overlapping windows of ``size`` tokens as an array.

    A window starts at every step below the text length, so the last piece may lie inside the one
    before. The text is cut into step-long blocks in one regex pass and each window is glued from
    the blocks it spans: linear in the text length, where one ``substring`` per window would scan
    from the start each time.
    """
    window, lap = size * CHARS_PER_TOKEN, overlap * CHARS_PER_TOKEN
    if lap >= window:
        raise ValueError(f"windows of {size} tokens cannot share {overlap}")
    step = window - lap
    span = 1 + -(-lap // step)

    def windows(blocks: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(blocks)),
            lambda i: F.substring(F.array_join(F.slice(blocks, i, F.lit(span)), ""), 1, window),
        )

    cut = bind(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0)), windows)
    return F.when(F.length(text) <= window, F.array(text)).otherwise(cut)


def structured_pieces(text: Column, size: int, overlap: int) -> Column:
    """One section as pieces: whole if it fits, else by paragraph, else by window."""
    window = size * CHARS_PER_TOKEN
    paragraphs = F.filter(F.split(text, "\n\n", -1), lambda p: ~is_blank(p))
    return (
        F.when(text == "", F.array().cast("array<string>"))
        .when(F.length(text) <= window, F.array(text))
        .otherwise(F.flatten(F.transform(paragraphs, lambda p: fixed_pieces(p, size, overlap))))
    )
