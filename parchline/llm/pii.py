"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over the text: at-signs, ``://``, plus signs,
digits and identifier cues such as ``token`` or ``iban``. From each anchor a small parser expands
to the left and right over the characters its kind allows, and validates what it finds (labels
of a domain, parts of an address, check digits). Text without anchors costs nothing more.

Base kinds, leftmost and without overlap within a kind; a candidate that fails validation is
dropped and not tried again from a later place:

* ``email``: local part, at-sign, domain of at least two labels
* ``ip``: four dotted numbers of at most 255
* ``card``: 14 to 19 digits, single blanks or hyphens between them, passing the Luhn test
* ``phone``: plus sign and 10 to 15 digits with blanks, brackets, dots and hyphens

Added kinds: ``login`` (user and password before the at-sign of an address with a scheme),
``iban`` (check digits modulo 97) and ``secret`` (16 or more letters and digits, with at least
one digit, after a cue such as ``token = "``). Added spans never change base spans.

Offsets are code points, ends exclusive. Defined results: null and empty texts have no spans; every
row is answered by itself, so repeated rows, ties and null ids need no care.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import words as W

#: In the order in which spans with one start are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "login", "iban", "secret")
_RANK = {k: i for i, k in enumerate(KINDS)}

#: Cues in lower case; they are looked for in three spellings: lower, upper and capitalised.
CUES = ("token", "api_key", "apikey", "secret", "password", "passwd", "access_key")

_DIGITS = frozenset("0123456789")
_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_UPPER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_KEY = _ALNUM | frozenset("_-+/=.")
_USERINFO = _ALNUM | frozenset("-._~!$&'()*+,;=%:")


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in _DIGITS:
        found.add_word(digit, "digit")
    found.add_word("@", "at")
    found.add_word("+", "plus")
    found.add_word("://", "scheme")
    for cue in CUES:
        for spelling in {cue, cue.upper(), cue.capitalize()}:
            found.add_word(spelling, "cue")
    found.make_automaton()
    return found


def _right(text: str, at: int, allowed: frozenset) -> int:
    while at < len(text) and text[at] in allowed:
        at += 1
    return at


def _left(text: str, at: int, allowed: frozenset, stop: int) -> int:
    while at > stop and text[at - 1] in allowed:
        at -= 1
    return at


def parse_email(text: str, at: int, stop: int) -> tuple[int, int] | None:
    """The address around the at-sign, not reaching left of ``stop``."""
    start = _left(text, at, _LOCAL, stop)
    end = _right(text, at + 1, _LABEL)
    if start == at or end == at + 1:
        return None
    labels = 1
    while end < len(text) and text[end] == ".":
        after = _right(text, end + 1, _LABEL)
        if after == end + 1:
            break
        end, labels = after, labels + 1
    return (start, end) if labels > 1 else None


def parse_dotted(text: str, start: int) -> tuple[list[tuple[int, int, bool]], int]:
    """All groups of four in the dotted numbers that begin here, each with its validity; the end."""
    parts, at = [], start
    while True:
        end = _right(text, at, _DIGITS)
        parts.append((at, end))
        if end + 1 < len(text) and text[end] == "." and text[end + 1] in _DIGITS:
            at = end + 1
        else:
            break
    groups = []
    for i in range(0, len(parts) - 3, 4):
        four = parts[i : i + 4]
        valid = all(len(n := text[a:b].lstrip("0")) <= 3 and int(n or 0) <= 255 for a, b in four)
        groups.append((four[0][0], four[3][1], valid))
    return groups, parts[-1][1]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) << (i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def parse_card(text: str, start: int) -> tuple[int, bool]:
    """End of the run of digits with single separators that begins here, and whether it is a card."""
    at = _right(text, start, _DIGITS)
    while at + 1 < len(text) and text[at] in " -" and text[at + 1] in _DIGITS:
        at = _right(text, at + 1, _DIGITS)
    if not 14 <= at - start <= 37:
        return at, False
    digits = "".join(c for c in text[start:at] if c in _DIGITS)
    return at, 14 <= len(digits) <= 19 and luhn(digits)


def parse_phone(text: str, plus: int) -> tuple[int, bool] | None:
    """End of the number after a plus sign and whether it is valid; None if there is none."""
    if plus + 1 >= len(text) or text[plus + 1] not in _DIGITS:
        return None
    end = _right(text, plus + 2, _PHONE)
    while end > plus + 3 and text[end - 1] not in _DIGITS:
        end -= 1
    if end <= plus + 3 or text[end - 1] not in _DIGITS:
        return None
    count = sum(c in _DIGITS for c in text[plus:end])
    return end, 10 <= count <= 15


def parse_login(text: str, scheme: int) -> tuple[int, int] | None:
    """``user:password`` between ``://`` and an at-sign."""
    start = scheme + 3
    end = _right(text, start, _USERINFO)
    inner = text.find(":", start, end)
    valid = end < len(text) and text[end] == "@" and start < inner < end - 1
    return (start, end) if valid else None


def parse_iban(text: str, digit: int) -> tuple[int, int] | None:
    """Two capitals, two digits and 11 to 30 more capitals and digits; the first digit is given."""
    start = digit - 2
    if start < 0 or not (text[start] in _UPPER and text[start + 1] in _UPPER):
        return None
    if start and text[start - 1] in _ALNUM or digit + 1 >= len(text) or text[digit + 1] not in _DIGITS:
        return None
    end = _right(text, digit, _DIGITS | _UPPER)
    if not 15 <= end - start <= 34 or end < len(text) and text[end] in _ALNUM:
        return None
    moved = text[start + 4 : end] + text[start : start + 4]
    return (start, end) if int("".join(str(int(c, 36)) for c in moved)) % 97 == 1 else None


def parse_secret(text: str, last: int) -> tuple[int, int] | None:
    """The value after a cue that ends at ``last``: ``=`` or ``:``, perhaps a quote, then a key."""
    at = _right(text, last + 1, frozenset("\"' "))
    if at >= len(text) or text[at] not in "=:":
        return None
    start = _right(text, at + 1, frozenset("\"' "))
    end = _right(text, start, _KEY)
    return (start, end) if end - start >= 16 and any(c in _DIGITS for c in text[start:end]) else None


def spans_of(text: str | None, anchors: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then by kind."""
    if not text:
        return []
    out: list[tuple[int, int, str]] = []
    email_end = dotted_end = card_end = phone_end = secret_end = 0
    for last, kind in anchors.iter(text):
        if kind == "digit":
            if last >= card_end:
                card_end, valid = parse_card(text, last)
                if valid:
                    out.append((last, card_end, "card"))
            if last >= dotted_end:
                groups, dotted_end = parse_dotted(text, last)
                out += [(a, b, "ip") for a, b, valid in groups if valid]
            if last >= 2 and text[last - 1] in _UPPER and (span := parse_iban(text, last)):
                out.append((*span, "iban"))
        elif kind == "at":
            if span := parse_email(text, last, email_end):
                email_end = span[1]
                out.append((*span, "email"))
        elif kind == "plus":
            if last >= phone_end and (found := parse_phone(text, last)):
                phone_end = found[0]
                if found[1]:
                    out.append((last, phone_end, "phone"))
        elif kind == "scheme":
            if span := parse_login(text, last - 2):
                out.append((*span, "login"))
        elif last >= secret_end and (span := parse_secret(text, last)):
            secret_end = span[1]
            out.append((*span, "secret"))
    return sorted(set(out), key=lambda s: (s[0], _RANK[s[2]], s[1]))


def masked(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    if not spans:
        return text
    out, at = [], 0
    for start, end, kind in merged(spans):
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def merged(spans: list[tuple[int, int, str]]) -> Iterator[tuple[int, int, str]]:
    current = None
    for start, end, kind in spans:
        if current and start < current[1]:
            current = (current[0], max(current[1], end), current[2])
        else:
            if current:
                yield current
            current = (start, end, kind)
    if current:
        yield current


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def personal_data(docs: DataFrame, keep: list[str] | None = None, redact: bool = False) -> DataFrame:
    """``row`` (the kept columns), a count per base kind, base_sha256, spans and, on request, the masked text."""
    fields = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"

    def make():
        anchors = automaton()

        def work(texts: list) -> list[pa.Array]:
            counts = {k: [] for k in BASE_KINDS}
            digests, lists, out = [], [], []
            for text in texts:
                spans = spans_of(text, anchors)
                base = [s for s in spans if s[2] in counts]
                for kind, column in counts.items():
                    column.append(sum(s[2] == kind for s in base))
                digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
                lists.append(listed(spans))
                if redact:
                    out.append(masked(text, spans))
            arrays = [pa.array(c, pa.int64()) for c in counts.values()]
            arrays += [pa.array(digests, pa.string()), pa.array(lists, pa.string())]
            return arrays + [pa.array(out, pa.string())] * redact

        return work

    return W.per_text(W.with_text(docs, keep), make, fields + ", masked string" * redact)


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with their own columns; ``text`` is masked and ``n_chars``, if any, counts it."""
    found = personal_data(docs, redact=True)
    changed = {"text": F.col("masked"), "n_chars": F.length("masked").cast("long")}
    return found.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
