"""Words coded many at once, and short index lists worked on many at once."""

import random
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa

from parchline.llm import jaccard_join, words


def test_words_of_many_texts_are_those_of_each():
    dice = random.Random(1)
    letters = "aAbBé \t\n\x0b\x1f漢\x00"
    texts = [None, "", " ", "a", "A"] + ["".join(dice.choice(letters) for _ in range(dice.randrange(300))) for _ in range(300)]
    span = words.SPAN_BYTES
    # Long words in both cases, words and white space that fill a span, and texts beyond one.
    texts += ["x" * 70 + " " + "X" * 70 + " " + "x" * 69, "q" * (3 * span), ("Ab" * span + " ") * 2 + "z", "word up " * span]
    texts += [" " * (span + 1) + "a", "a" * 64 + " " + "a" * 65, "w " + "y" * (span - 1), "w " * (span // 2), "v" * span, "v" * span + " v"]
    known = words.SpacedCodes()
    for given in (pa.array(texts, pa.string()), pa.array(texts, pa.string()).slice(3)):
        found = [codes for all_, counts in known.of(given) for codes in np.split(all_, np.cumsum(counts)[:-1])]
        wanted = [words.spaced_words(t) for t in given.to_pylist()]
        assert [len(f) for f in found] == [len(w) for w in wanted]
        pairs = {(code, word) for f, w in zip(found, wanted) for code, word in zip(f.tolist(), w)}
        assert len(pairs) == len({c for c, _ in pairs}) == len({w for _, w in pairs})
    sets = jaccard_join.shingle_sets(pa.array(["a b c", "A  b C", "", None, "a b c d e f"]), known)
    found = [s.tolist() for s in sets]
    assert [len(s) for s in found] == [1, 1, 0, 0, 2] and found[0] == found[1]


def test_short_lists_name_every_pair_once_and_not_again():
    dice, rows = random.Random(3), []
    for code in range(200):
        size = dice.randrange(1, jaccard_join.SHORT + 1)
        rows += [(code, *e) for e in sorted((dice.randrange(20, 30), dice.randrange(6), dice.randrange(10**9), dice.randrange(3)) for _ in range(size))]
    table = pa.table(dict(zip(("code", "n", "pos", "id", "group"), (pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))))))
    may = set()
    for _, entries in groupby(rows, key=lambda r: r[0]):
        for x, y in combinations(entries, 2):
            shared = jaccard_join.needed(x[1], y[1])
            if 4 * y[1] <= 5 * x[1] and x[1] - x[2] >= shared and y[1] - y[2] >= shared:
                may.add((x[0], x[3], y[3], x[4] != y[4]))
    other_groups = {frozenset((a, b)) for _, a, b, differ in may if differ}
    for size in (7, 10_000):
        batches = table.to_batches(max_chunksize=size)
        named = [frozenset(r.values()) for b in jaccard_join.partners_between(1)(iter(batches)) for r in b.to_pylist()]
        assert set(named) == other_groups and len(named) == len(other_groups)
        assert not list(jaccard_join.partners_between(2)(iter(batches)))
        assert {frozenset(r.values()) for b in jaccard_join._between_groups(iter(batches)) for r in b.to_pylist()} == other_groups
        index = [b for b in table.drop(["group"]).to_batches(max_chunksize=size)]
        kept = [(r["code"], r["id"], r["partner"]) for b in jaccard_join._with_partners(iter(index)) for r in b.to_pylist()]
        ends = {(c, x) for c, a, b, _ in may for x in (a, b)}
        assert {k[:2] for k in kept} == ends and len(kept) == len(ends)
        assert all((c, i, p) in {m[:3] for m in may} or (c, p, i) in {m[:3] for m in may} for c, i, p in kept[:200])
