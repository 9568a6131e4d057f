"""Each method against a brute-force version, a public library or an exact round trip."""

import hashlib
import random
import re
import struct
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from parchline.llm import byte_bpe, chat, decontaminate, jaccard_join, line_dedup, pii, queries, quality, rans, topk, words
from parchline.llm.components import components
from parchline.sources.tables import table

RANKS = P.path("byte_bpe_50k.tiktoken")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


@pytest.fixture(scope="module")
def texts(spark, folder):
    return {r["doc_id"]: r["text"] for r in table(spark, folder, "documents").collect()}


def grouped(links, ids):
    head = {i: i for i in ids}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        head[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def sets_of(texts):
    out = {}
    for d, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))
        out[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    return out


def brute_components(texts):
    sets, lists, shared = sets_of(texts), defaultdict(list), defaultdict(int)
    for d, s in sets.items():
        for x in s:
            lists[x].append(d)
    for ids in lists.values():
        for pair in combinations(ids, 2):
            shared[pair] += 1
    links = [p for p, c in shared.items() if 100 * c >= 80 * (len(sets[p[0]]) + len(sets[p[1]]) - c)]
    found = grouped(links, sets)
    return {d: (len(sets[d]), found[d]) for d in sets}


def test_jaccard_join_equals_brute_force(spark, folder, texts):
    found = {r[0]: tuple(r[1:3]) for r in queries.op2_jaccard_join(spark, folder).collect()}
    assert found == brute_components(texts)


def test_jaccard_join_on_similar_sets(spark):
    dice = random.Random(5)
    base = [str(dice.randrange(10**6)) for _ in range(60)]
    texts = {}
    for i in range(150):  # copies with zero to three changed words, so many pairs lie near the threshold
        own = list(base)
        for _ in range(dice.randrange(4)):
            own[dice.randrange(60)] = f"x{dice.randrange(40)}"
        texts[i] = " ".join(own[: dice.choice([60, 60, 55, 50])])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r[0]: tuple(r[1:3]) for r in jaccard_join.near_duplicates(docs).collect()}
    assert found == brute_components(texts)


@given(st.lists(st.integers(0, 2**64 - 1), unique=True, max_size=60), st.lists(st.integers(0, 2**64 - 1), unique=True, max_size=300))
@settings(max_examples=60, deadline=None)
def test_bitmaps_never_overstate(x, y):
    y = y + x[: len(x) // 2]
    a, b = np.unique(np.array(x, np.uint64)), np.unique(np.array(y, np.uint64))
    if len(a) and len(b):
        assert jaccard_join.fewest_differing(jaccard_join.bitmap(a), jaccard_join.bitmap(b)) <= len(set(x) ^ set(y))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(139, 200), (7, 7), (300, 250)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = grouped(links, {i for p in links for i in p})
    assert found == {i: c for i, c in wanted.items()}


def test_line_dedup_equals_brute_force(spark, folder, texts):
    seen, wanted = set(), {}
    for d in sorted(texts):
        kept = []
        for unit in re.findall(r"(?s).*?(?:[.!?]+[ \t]+|\n|$)", texts[d]):
            w = re.findall(r"[^\x20\x09-\x0D]+", lower(unit))
            if len(w) < line_dedup.MIN_WORDS or tuple(w) not in seen:
                kept.append(unit)
            if len(w) >= line_dedup.MIN_WORDS:
                seen.add(tuple(w))
        wanted[d] = "".join(kept)
    found = queries.op1_line_dedup(spark, folder).collect()
    assert {r["doc_id"]: r["text"] for r in found} == wanted
    for r in found:
        spans = [(s["start"], s["end"]) for s in r["removed"]]
        assert len(texts[r["doc_id"]]) - sum(b - a for a, b in spans) == len(r["text"])


def test_line_dedup_of_short_units_and_unbroken_scripts(spark):
    chinese, unbroken = "\u5168\u6587" * 400, "x" * 5000
    rows = [(1, f"All rights reserved.\n\nYes. It is one.\n{chinese}\n{unbroken}\n \nEnd"), (2, f"{chinese}\nall  rights reserved.\n\n \nYes. No.\n{unbroken}\n"), (3, "End\nNo.")]
    found = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: rows[0][1], 2: "\n \nNo.\n", 3: ""}


def test_quality_on_held_out_labels(spark, folder):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, folder, "labels").collect()}
    found = queries.op4_quality(spark, folder).collect()
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    held = [r for r in found if r["held_out"] and r["doc_id"] in labels]
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in held)
    assert right >= 0.85 * len(held)
    assert found == queries.op4_quality(spark, folder).collect()


def test_quality_learns_from_all_words_of_long_rows(spark):
    long = " ".join(f"w{i}" for i in range(6000)) + " w5 w5"
    known = quality.Slots()
    row = quality.counted(long, None, known)
    assert len(row[0]) > 4000
    assert all((a == b).all() for a, b in zip(row, quality.opened(quality.packed(*row))))
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1]
    docs = spark.createDataFrame([(i, long if i % 2 else "short") for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    machine = quality.train(docs, labels)
    assert (machine.linear[row[0]] != 0).all()


def test_sum_of_squares_identity():
    dice = np.random.default_rng(3)
    machine = quality.Machine(0.1, dice.normal(size=quality.SLOTS) / 9, dice.normal(size=(quality.SLOTS, 3)) / 9)
    slots, values = np.array([1, 5, 70, 9000]), np.array([0.5, 1.0, 0.2, 0.7])
    pairs = sum(machine.factors[a] @ machine.factors[b] * x * y for (a, x), (b, y) in combinations(zip(slots, values), 2))
    raw = 0.1 + machine.linear[slots] @ values + pairs
    assert abs(machine.score(slots, values) - 1 / (1 + np.exp(-raw))) < 1e-12


def brute_hits(text, items, span=10):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    hit, found = set(), set()
    for item, passage in items:
        v = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(passage or ""))
        size = min(span, len(v))
        wins = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)} if v else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in wins:
                hit |= set(range(i, i + size))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


def test_decontaminate_equals_brute_force(spark, folder, texts):
    items = [tuple(r) for r in table(spark, folder, "benchmark").select("item_id", "text").collect()]
    found = {r["doc_id"]: r for r in queries.op5_decontaminate(spark, folder).collect()}
    assert any(r["contaminated"] for r in found.values())
    for d, t in texts.items():
        n, hit, ids = brute_hits(t, items)
        r = found[d]
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (n, hit, len(ids), digest, hit > 0)


@given(st.lists(st.sampled_from("aab c"), max_size=60).map(" ".join), st.lists(st.lists(st.sampled_from("ab"), max_size=14).map(" ".join), max_size=4))
@settings(max_examples=150, deadline=None)
def test_every_shared_window_is_found(text, passages):
    items = list(enumerate(passages))
    test = decontaminate.test_side(items, 10, 5)
    spans, found = decontaminate.hits(words.Codes().of(words.alnum_words(text)), test)
    _, n, ids = brute_hits(text, items)
    assert len({i for a, b in spans for i in range(a, b)}) == n and sorted(str(test.ids[i]) for i in found) == ids


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m.group())
            valid = kind == "email"
            valid |= kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
            valid |= kind == "card" and 14 <= len(digits) <= 19 and pii.luhn(digits)
            valid |= kind == "phone" and 10 <= len(digits) <= 15
            if valid:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], list(PATTERNS).index(s[2])))


@given(st.text("0129.@+- ()ab%_:/é\u0661", max_size=60))
@settings(max_examples=400, deadline=None)
def test_anchors_find_what_patterns_find(text):
    found = [s for s in pii.spans_of(text, pii.automaton()) if s[2] in PATTERNS]
    assert found == brute_spans(text)


def test_pii_equals_brute_force(spark, folder, texts):
    for r in queries.op6_pii(spark, folder).collect():
        base = brute_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(pii.listed(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[2] == k for s in base) for k in PATTERNS]
        assert set(filter(None, pii.listed(base).split(","))) <= set(r["spans"].split(","))


def test_added_kinds_and_masks():
    text = 'x http://bob:pw@h.de, DE89370400440532013000; token = "0a1b2c3d4e5f60718293"'
    spans = pii.spans_of(text, pii.automaton())
    assert {k for *_, k in spans} >= {"login", "iban", "secret"}
    assert "pw" not in pii.masked(text, spans) and "0a1b" not in pii.masked(text, spans)


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.vocabulary(RANKS).ranks
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_the_library(spark, folder, texts, library):
    for r in queries.op7_byte_bpe(spark, folder).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]])
        data = struct.pack(f"<{len(ids)}I", *ids)
        whole = hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(data).hexdigest(), whole)


@given(st.binary(max_size=40), st.binary(max_size=12), st.data())
@settings(max_examples=200, deadline=None)
def test_prefixes_append_and_edit(library, data, more, draw):
    known = byte_bpe.vocabulary(RANKS)
    whole = byte_bpe.Prefixes(known, data + more)
    assert whole.ids() == (library._encode_single_piece(data + more) if data + more else [])
    grown = byte_bpe.Prefixes(known, data)
    grown.append(more)
    assert grown.last == whole.last
    start = draw.draw(st.integers(0, len(data)))
    end = draw.draw(st.integers(start, len(data)))
    edited = byte_bpe.Prefixes(known, data)
    edited.edit(start, end, more)
    assert edited.last == byte_bpe.Prefixes(known, data[:start] + more + data[end:]).last


def test_edit_reuses_what_follows():
    known = byte_bpe.vocabulary(RANKS)
    table = byte_bpe.Prefixes(known, b"the quick brown fox jumps " * 200)
    assert table.edit(10, 12, b"zz") < 400
    assert table.last == byte_bpe.Prefixes(known, table.data).last


def test_topk_equals_brute_force(spark, folder):
    rows = [(r["vec_id"], np.floor(256 * np.array(r["embedding"], np.float64)).astype(np.int64)) for r in table(spark, folder, "embeddings").collect()]
    wanted = []
    for q, v in rows:
        if q % 50 == 0:
            best = sorted((-int(v @ w), i) for i, w in rows if i != q)[:5]
            wanted += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    assert sorted(map(tuple, queries.op8_topk(spark, folder).collect())) == sorted(wanted)


@given(st.integers(1, 80), st.integers(1, 12), st.integers(0, 10**6))
@settings(max_examples=80, deadline=None)
def test_search_stops_only_on_proof(count, width, seed):
    dice = np.random.default_rng(seed)
    vectors, ids = dice.integers(-50, 50, (count, width)), np.arange(count) * 2
    query = dice.integers(-50, 50, width)
    wanted = sorted((-int(s), int(i)) for s, i in zip(vectors @ query, ids) if i != 4)[:5]
    found = topk.search(topk.build(ids, vectors), np.array([4]), query[None], 5, few=5)[0]
    assert [(-s, i) for s, i in found] == wanted


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", ""]), st.text("<|\\/endstarp>x\n", max_size=30)), max_size=6))
@settings(max_examples=200, deadline=None)
def test_chat_reads_back(turns):
    pieces = list(chat.compile_template(chat.TEMPLATE)(messages=({"role": r, "text": t} for r, t in turns)))
    back = [x for x in chat.read_back(pieces) if x[0] is not None]
    assert [(r, t) for r, t, *_ in back] == turns
    assert [x for *_, x, _ in back] == [t if r == "assistant" else "" for r, t in turns]


def test_template_language():
    def shown(source, **values):
        return "".join(t for t, _ in chat.compile_template(source)(**values))

    assert shown("{% if 1 + 1 == 2 %}a{% else %}b{% endif %}{{ 'x' ~ 2 | length }}") == "ax1"
    assert shown("{% for m in ms %}{% if loop.first %}[{% elif m == 'b' %},{% endif %}{{ m | upper }}{% endfor %}", ms=["a", "b"]) == "[A,B"
    assert shown("{% set y = x.k['z'] %}{{ y or 'none' }}{{ not y }}", x={"k": {"z": None}}) == "nonetrue"
    assert chat.fold_body(chat.parse("a{{ 'b' ~ 1 }}c{% if false %}d{% endif %}")) == [("print", ("const", "ab1c"))]
    for bad in ("{% for x %}", "{% if x %}", "{{ x.__class__.y | evil }}", "{% endfor %}", "{{ 'a' b }}"):
        with pytest.raises(chat.TemplateError):
            chat.parse(bad)
    with pytest.raises(chat.TemplateError):
        shown("{{ x.__class__ }}", x="text")


def test_rans_equals_the_library(spark, folder, texts):
    path = P.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    start, wanted = 0, []
    for d in sorted(texts):
        ids = [*whole.encode(texts[d], add_special_tokens=False).ids, 2]
        wanted.append((d, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert sorted(map(tuple, queries.op10_rans(spark, folder).collect())) == wanted


def test_names_of_added_tokens_are_encoded_as_by_the_library(spark):
    path = P.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    texts = ["a <|endoftext|> b", "x<|startoftext|>Y, z.", "a <|ENDOFTEXT|> b", "\u03a3 <|ENDOFTEXT|> <|endoftext|>\n\u03a3", "<|endof text|> <|end", "plain words, here."]
    start, wanted = 0, []
    for d, text in enumerate(texts):
        ids = [*whole.encode(text, add_special_tokens=False).ids, 2]
        wanted.append((d, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(map(tuple, rans.written(docs, path).collect())) == wanted


@given(st.text(max_size=80))
@settings(max_examples=150, deadline=None)
def test_words_are_encoded_as_in_the_text(text):
    path = P.path("word_bpe_49k.json")
    found = np.frombuffer(rans.tokenize([text], path, 2)[0], rans.IDS).tolist()
    whole = words.process_store(rans.STORE)[path].tokenizer
    assert found == [*whole.encode(text, add_special_tokens=False).ids, 2]


@given(st.text("abzéßÿ'.,!<>/w|-09 \n\tA\u00e6\u00aa\u0301", max_size=60))
@settings(max_examples=300, deadline=None)
def test_pieces_of_words_are_encoded_as_in_the_text(text):
    path = P.path("word_bpe_49k.json")
    found = [np.frombuffer(x, rans.IDS).tolist() for x in rans.tokenize([text, None, text + ".", " " + text], path, 2)]
    whole = words.process_store(rans.STORE)[path].tokenizer
    assert found == [[*whole.encode(t, add_special_tokens=False).ids, 2] for t in (text, "", text + ".", " " + text)]


def test_known_letters_with_new_signs_are_not_encoded_again(monkeypatch):
    path = P.path("word_bpe_49k.json")
    words.process_store(rans.STORE).clear()
    rans.tokenize(["somewordé otherword"], path, 2)
    store = words.process_store(rans.STORE)[path]
    whole, asked = store.tokenizer, []

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def __getattr__(self, name):
            def call(texts, **options):
                asked.extend([texts] if isinstance(texts, str) else texts)
                return getattr(self.tokenizer, name)(texts, **options)

            return call

    for name, value in list(vars(store).items()):
        if isinstance(value, Tokenizer):
            monkeypatch.setattr(store, name, Counted(value))
    text = "somewordé!!! (otherword), otherword7 somewordé."
    assert np.frombuffer(rans.tokenize([text], path, 2)[0], rans.IDS).tolist() == [*whole.encode(text, add_special_tokens=False).ids, 2]
    assert not any("word" in x for x in asked)
    assert "x" * 70 not in store and rans.tokenize(["x" * 70 + "!"], path, 2) and "x" * 70 not in store


def test_rans_blocks():
    dice = np.random.default_rng(1)
    ids = dice.zipf(1.3, 5000).clip(0, 40000).astype(np.uint32)
    coded = rans.Table.of({int(s): int(c) for s, c in zip(*np.unique(ids, return_counts=True))})
    block = rans.encode_block([(7, ids[:100]), (-8, ids[100:100]), (9, ids[100:])], coded, lanes=16, check_steps=10)
    opened = rans.Block(block, coded)
    assert [(d, x.tolist()) for d, x in opened.documents()] == [(7, ids[:100].tolist()), (-8, []), (9, ids[100:].tolist())]
    assert len(opened.marks) > 5 and opened.part(3).tolist() == ids[480:640].tolist()
    with pytest.raises(rans.DamagedBlock):
        rans.Block(block[:200] + bytes([block[200] ^ 1]) + block[201:], coded)
    with pytest.raises(rans.DamagedBlock):
        rans.Block(block, rans.Table.of({1: 1}))


def test_pipeline_equals_its_parts(spark, folder, texts, library):
    import corpus_pipeline

    scores = {r["doc_id"]: r["score"] for r in queries.op4_quality(spark, folder).collect()}
    left = {d: t for d, t in texts.items() if scores[d] >= 0.5}
    left = {d: left[d] for d, (_, c) in brute_components(left).items() if d == c}
    items = [tuple(r) for r in table(spark, folder, "benchmark").select("item_id", "text").collect()]
    left = {d: t for d, t in left.items() if not brute_hits(t, items)[1]}
    anchors = pii.automaton()
    wanted = {d: len(library.encode_ordinary(pii.masked(t, pii.spans_of(t, anchors)))) for d, t in left.items()}
    assert {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, folder).collect()} == wanted
