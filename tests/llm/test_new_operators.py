"""Merkle manifest, cross-tokenizer alignment and fingerprints against brute-force versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from pyspark.sql import functions as F

from parchline.llm import alignment, fingerprints, manifest, queries
from parchline.sources.tables import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, _g string, idx long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_manifest(rows, tampered):
    """rows: (doc_id, text, lang, source, n_chars); the contract's tree, level by level."""
    leaf = lambda r, text: H(*(field(v) for v in (r[0], r[3], r[2], r[4], text)))
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append(r)

    def tree(nodes):
        """Levels bottom-up: lists of digests."""
        levels = [nodes]
        while len(levels[-1]) > 1:
            cur = levels[-1]
            levels.append([H(*cur[i : i + 16]) for i in range(0, len(cur), 16)])
        return levels

    def path(levels, i):
        out = []
        for level in levels[:-1]:
            run = i // 16 * 16
            out.append(("".join(level[run:i]), "".join(level[i + 1 : run + 16])))
            i //= 16
        return out

    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees, orders = {}, {}
    for s in sources:
        order = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        orders[s] = order
        trees[s] = tree([leaf(r, r[1]) for r in order])
    top = tree([trees[s][-1][0] for s in sources])
    root = top[-1][0]
    out = []
    for si, s in enumerate(sources):
        for i, r in enumerate(orders[s]):
            p = path(trees[s], i) + path(top, si)
            text = r[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) if tampered(r) and r[1] is not None else r[1]
            h = leaf(r, text)
            for left, right in p:
                h = H(left, h, right)
            proof = H(*(left + right for left, right in p))
            out.append((r[0], leaf(r, r[1]), trees[s][-1][0], root, proof, h, h == root))
    return sorted(out, key=lambda t: (t[0] is None, t[0] or 0, t[1]))


def crc_rule(r):
    return r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0


@pytest.fixture(scope="module")
def manifest_rows():
    rows = []
    for i in range(300):  # three levels in one source
        rows.append((i, f"Text Number {i}" if i % 7 else None, "en" if i % 3 else None, "big", i % 50))
    for i in range(300, 317):  # just over one run
        rows.append((i, f"Other {i}", "de", "small", None))
    rows += [(900, "Lone", "fr", "lone", 4), (None, "No Id", "en", None, 5), (901, "Ünïcode ✓", "en", None, 9)]
    rows += [(5, "Text Number 5", "en", "big", 5)] * 2 + [(5, "Same Id Other Text", "en", "big", 5)]
    return rows


def test_manifest_brute_force(spark, manifest_rows):
    docs = spark.createDataFrame([(*r, "clash", "x", 7) for r in manifest_rows], SCHEMA)
    found = manifest.manifest(docs, manifest.tamper_rule(F.col("doc_id")))
    got = sorted(
        (tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()),
        key=lambda t: (t[0] is None, t[0] or 0, t[1]),
    )
    assert got == brute_manifest(manifest_rows, crc_rule)
    assert any(not t[6] for t in got) and any(t[6] for t in got)


def test_manifest_one_row_and_empty(spark):
    one = spark.createDataFrame([(1, "A", "en", "s", 1, "", "", 0)], SCHEMA)
    (r,) = manifest.manifest(one).collect()
    assert r["leaf"] == r["subroot"] == r["root"] == r["folded_root"] and r["verified"]
    assert r["proof_sha256"] == hashlib.sha256(b"").hexdigest()
    assert manifest.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_manifest_query(spark, folder):
    rows = [tuple(r) for r in table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = sorted(tuple(r)[:7] for r in queries.op11_merkle(spark, folder).collect())
    assert got == sorted(brute_manifest(rows, crc_rule))


A_FILE, B_FILE = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
A_RANKS = P.path("byte_bpe_50k.tiktoken")


def brute_alignment(texts):
    """The tokenizers library on the json file, sentencepiece on the model, tokens compared as bytes."""
    import json

    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    back = alignment.byte_alphabet()
    vocab = {i: bytes(back[c] for c in t) for t, i in json.load(open(A_FILE))["model"]["vocab"].items()}
    b = sentencepiece.SentencePieceProcessor(model_file=B_FILE)

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("\u2581", " ").encode()

    def pieces(ids, side):
        return [vocab[i] for i in ids] if side == "a" else [piece(i) for i in ids]

    per, links = [], Counter()
    for text in texts:
        if not text:
            per.append(None)
            continue
        ea = a.encode(" " + text, add_special_tokens=False).ids
        eb = b.encode(text)
        pa_, pb_ = pieces(ea, "a"), pieces(eb, "b")
        want = (" " + text).encode()
        if b"".join(pa_) != want or b"".join(pb_) != want:
            per.append(None)
            continue
        ends_a, ends_b = list(accumulate(map(len, pa_))), list(accumulate(map(len, pb_)))
        pairs, groups, i0, j0 = [], [], 0, 0
        for i, e in enumerate(ends_a):
            if e in ends_b:
                j = ends_b.index(e)
                pairs.append((ea[i], eb[j]))
                groups.append(",".join(map(str, ea[i0 : i + 1])) + "|" + ",".join(map(str, eb[j0 : j + 1])))
                i0, j0 = i + 1, j + 1
        links.update(pairs)
        per.append((len(ea), len(eb), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = defaultdict(int)
    for (x, y), c in links.items():
        top[y] = max(top[y], c)
    out = []
    for p in per:
        if p is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, pairs, digest = p
            best = sum(1 for q in pairs if links[q] == top[q[1]])
            out.append((n_a, n_b, len(pairs), len(pairs), best, sum(links[q] for q in pairs), digest))
    return out


def test_alignment_brute_force(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    extra = [
        (-1, None), (-2, ""), (-3, "a <|endoftext|> b <s></s> c"), (-4, "double  spaces\tand\nlines\n\n"),
        (-5, "émoji 😀 ✓ ünïcode"), (-6, "a"), (-6, "a"), (None, "no id"), (-7, "x" * 20000),
    ]
    rows = [tuple(r) for r in docs.collect()] + extra
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_a", F.lit("clash"))
    got = [
        tuple(r) for r in alignment.aligned(frame, A_RANKS, B_FILE)
        .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    ]
    want = [(i, *w) for (i, _), w in zip(rows, brute_alignment([t for _, t in rows]))]
    key = lambda t: (t[0] is None, t[0] or 0, t)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_galloping_intersection():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(50):
        x = np.unique(rng.integers(0, 5000, rng.integers(0, 300)))
        y = np.unique(rng.integers(0, 5000, rng.integers(0, 3000)))
        ix, iy = alignment.common_ends(x, y)
        both = np.intersect1d(x, y)
        assert x[ix].tolist() == both.tolist() == y[iy].tolist()


def test_alignment_empty(spark):
    assert alignment.aligned(spark.createDataFrame([], "doc_id long, text string"), A_RANKS, B_FILE).count() == 0


def test_fingerprint_local_consistency():
    body = "the same passage of words stands here in both texts and is long enough to hold phrases " * 5
    a = fingerprints.phrase_names("first prefix. " + body)[0]
    b = fingerprints.phrase_names("quite another and longer beginning! " + body + " tail")[0]
    names_a = {v for level in a for v in level.tolist()}
    names_b = {v for level in b for v in level.tolist()}
    # Equal substrings share their interior phrases, wherever they stand.
    assert len(names_a & names_b) > 0.6 * len(names_a) > 50
    assert fingerprints.fingerprint(body) == fingerprints.fingerprint(str(body))
    assert fingerprints.likeness(fingerprints.fingerprint(body), fingerprints.fingerprint(body + "x")) > 0.5
    assert fingerprints.fingerprint("") == fingerprints.fingerprint(None) == ""
    assert fingerprints.fingerprint("a") != "" and fingerprints.fingerprint("aaaa") != fingerprints.fingerprint("aaa")


def brute_fingerprints(rows):
    def tie(text):
        v = xxhash.xxh64_intdigest(text.encode(), seed=42)
        return v - (1 << 64) if v >= 1 << 63 else v

    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), tie(r[1] or ""), r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text = text or ""
        nxt = order[(i + 1) % len(order)][1] or ""
        edited = fingerprints.edited(text, nxt)
        fp, efp, nfp = (fingerprints.fingerprint(t) for t in (text, edited, nxt))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp, efp,
                    fingerprints.likeness(fp, efp), fingerprints.likeness(fp, nfp)))
    return out


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def test_fingerprints_brute_force(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "ünï 😀" * 3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit(1))
    got = sorted(tuple(r) for r in fingerprints.fingerprints(frame).select(*COLUMNS).collect())
    assert got == sorted(brute_fingerprints(rows))
    by = {r[0]: r for r in got}
    assert by[10**6][3] == "" and by[10**6 + 1][3] == ""
    assert all(0 <= r[5] <= 1 and 0 <= r[6] <= 1 for r in got)


def test_fingerprints_ties_one_and_empty(spark):
    rows = [(3, "Same text here."), (3, "Same text here."), (None, "null id text"), (3, "other text at three")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = fingerprints.fingerprints(frame).collect()
    assert len(got) == 4
    same = [r for r in got if r["n_chars"] == len("Same text here.")]
    assert same[0]["fingerprint"] == same[1]["fingerprint"]
    (one,) = fingerprints.fingerprints(spark.createDataFrame([(1, "alone")], "doc_id long, text string")).collect()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"alona").hexdigest()
    assert fingerprints.fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_batched_fingerprints_equal_single():
    texts = ["", None, "a", "aa", "abab abab abab", "the same passage " * 40, "ünï 😀 ✓ " * 50, "x" * 3000, "ab", "ba"]
    texts += [f"document {i}: " + "word " * (i % 17) + "end" for i in range(200)]
    assert fingerprints.fingerprints_of(texts) == [fingerprints.fingerprint(t) for t in texts]


def test_batched_fingerprints_of_long_wide_and_repeated_texts():
    dice = random.Random(5)
    wide = ["".join(chr(dice.choice([dice.randrange(0x4E00, 0x9FFF), dice.randrange(0x1F300, 0x1F900)])) for _ in range(n)) for n in (1, 2, 900, 7000)]
    plain = ["".join(dice.choice("abcdeé  \n") for _ in range(n)) for n in (1, 3, 40, 500, 30000)]
    # Many names but few distinct ones, so that hardly any of them is small.
    repeated = ["the same line again\n" * 900, "aab" * 5000, "z" * 70000, "ab" * 2 + "c" * 300]
    for texts in (wide, plain, repeated, [*repeated, "", *wide, *plain, None], wide[:1], plain[:2]):
        assert fingerprints.fingerprints_of(texts) == [fingerprints.fingerprint(t) for t in texts]


def test_few_names_of_a_long_text_are_sorted(monkeypatch):
    dice = random.Random(6)
    text = "".join(dice.choice("abcdefgh ij") for _ in range(60000))
    wanted, sorted_names, lexsort = fingerprints.fingerprint(text), [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys, *a, **k: (sorted_names.append(len(keys[0])), lexsort(keys, *a, **k))[1])
    assert fingerprints.fingerprints_of([text]) == [wanted]
    assert sum(sorted_names) < len(text) // 100
