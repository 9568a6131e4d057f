"""Sections to chunks.

A document's sections sit in one row, so its chunks are computed in that row and exploded: no
shuffle at all. Sections kept as table rows are chunked per section and numbered blockwise.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binding import bind, explode_rows
from ..functions.identity import chunk_id
from ..functions.text import CHARS_PER_TOKEN, approx_tokens, fixed_pieces, sentences, structured_pieces
from ..functions.vector import adjacent_cosine
from .ordered import running
from .rules import CHUNKING_RULES, chunking_decision

PIECES_TYPE = "array<struct<index:int,text:string,heading:string>>"
SEMANTIC_THRESHOLD = 0.1


def _indexed(pairs: Column) -> Column:
    return F.transform(
        pairs, lambda p, i: F.struct(i.cast("int").alias("index"), p["text"].alias("text"), p["heading"].alias("heading"))
    )


def _with_heading(texts: Column, heading: Column) -> Column:
    return F.transform(texts, lambda t: F.struct(t.alias("text"), heading.alias("heading")))


def joined_text(sections: Column) -> Column:
    """The non-empty section texts joined by a blank line."""
    texts = F.transform(sections, lambda s: s["text"])
    return F.array_join(F.filter(texts, lambda t: t != ""), "\n\n")


def fixed_chunks(sections: Column, size: int, overlap: int) -> Column:
    return _indexed(_with_heading(bind(joined_text(sections), lambda t: fixed_pieces(t, size, overlap)), F.lit(None).cast("string")))


def structured_chunks(sections: Column, size: int, overlap: int) -> Column:
    """By section, paragraph, then window; every piece keeps its section's heading."""
    return _indexed(
        F.flatten(
            F.transform(sections, lambda s: _with_heading(structured_pieces(s["text"], size, overlap), s["heading"]))
        )
    )


def row_chunks(sections: Column) -> Column:
    """One chunk per section; the index keeps the gaps left by empty sections."""
    every = F.transform(
        sections,
        lambda s, i: F.struct(i.cast("int").alias("index"), s["text"].alias("text"), s["heading"].alias("heading")),
    )
    return F.filter(every, lambda c: c["text"] != "")


def semantic_chunks(sentence_array: Column, similarity: Column, size: int, overlap: int, threshold: float) -> Column:
    """A new chunk wherever a sentence is less similar than ``threshold`` to the one before.

    A chunk longer than the window is cut further by fixed windows.
    """
    places = F.transform(similarity, lambda s, i: F.when((i > 0) & (s < threshold), i + 1))

    def topics(turns: Column) -> Column:
        starts = F.concat(F.array(F.lit(1)), turns)
        ends = F.concat(turns, F.array(F.size(sentence_array) + 1))
        return F.zip_with(starts, ends, lambda a, b: F.array_join(F.slice(sentence_array, a, b - a), " "))

    texts = bind(F.filter(places, lambda i: i.isNotNull()), topics)
    pieces = F.flatten(F.transform(texts, lambda t: fixed_pieces(t, size, overlap)))
    none = F.array().cast("array<string>")
    chosen = F.when(F.size(sentence_array) > 0, pieces).otherwise(none)
    return _indexed(_with_heading(chosen, F.lit(None).cast("string")))


def _distinct_decisions(config: dict[str, Any]) -> list[tuple[str, int | None, int | None]]:
    body = config.get("chunking") or {}
    rules = [*(body.get("defaults") or {}).values(), *(body.get("overrides") or [])]
    return list(dict.fromkeys((r["method"], r.get("chunk_size"), r.get("overlap")) for r in rules))


def chunk(
    extracted: DataFrame,
    config: dict[str, Any] = CHUNKING_RULES,
    threshold: float = SEMANTIC_THRESHOLD,
) -> DataFrame:
    """Successfully extracted documents to chunk rows, by each one's resolved method."""
    decisions = _distinct_decisions(config)
    # Not a filter: pushed below a freshly computed extraction it would compute that twice.
    success = F.col("extraction_status") == "success"
    ready = extracted.withColumn(
        "_rule", F.when(success, chunking_decision(F.col("file_type"), F.col("extraction_method_used"), config))
    )
    method, sections = F.col("_rule.method"), F.col("sections")

    if any(name == "semantic_split" for name, _, _ in decisions):
        semantic = method == "semantic_split"
        ready = ready.withColumn("_sentences", F.when(semantic, sentences(joined_text(sections))))
        ready = ready.withColumn("_similarity", adjacent_cosine(F.col("_sentences")))

    pieces = F.array().cast(PIECES_TYPE)
    for name, size, overlap in decisions:
        if name == "fixed_size_with_overlap":
            value = fixed_chunks(sections, size, overlap)
        elif name in ("recursive_structure_aware", "heading_hierarchy_split"):
            value = structured_chunks(sections, size, overlap)
        elif name == "table_aware_row_based":
            value = row_chunks(sections)
        elif name == "semantic_split":
            value = semantic_chunks(F.col("_sentences"), F.col("_similarity"), size, overlap, threshold)
        else:
            continue
        chosen = (
            (method == name)
            & F.col("_rule.chunk_size").eqNullSafe(F.lit(size).cast("int"))
            & F.col("_rule.overlap").eqNullSafe(F.lit(overlap).cast("int"))
        )
        pieces = F.when(chosen, value.cast(PIECES_TYPE)).otherwise(pieces)
    return chunk_rows(
        ready.select("content_hash", "extraction_method_used", method.alias("chunking_method_used"), pieces.alias("_pieces"))
    )


def chunk_rows(df: DataFrame) -> DataFrame:
    """Explode ``_pieces`` into the chunk schema."""
    kept = [c for c in ("chunking_method_used", "extraction_method_used") if c in df.columns]
    return explode_rows(df, "_pieces", "content_hash", *kept, value="p").select(
        chunk_id(F.col("content_hash"), F.col("p.index")).alias("chunk_id"),
        "content_hash",
        F.col("p.index").alias("chunk_index"),
        F.col("p.text").alias("chunk_text"),
        F.col("p.heading").alias("section_heading"),
        *kept,
        approx_tokens(F.col("p.text")).alias("token_count"),
        F.lit(True).alias("is_active"),
    )


def chunkless(extracted: DataFrame, chunks: DataFrame) -> DataFrame:
    """Successful documents that produced no chunk and would otherwise vanish silently."""
    ok = extracted.filter(F.col("extraction_status") == "success")
    return ok.select("content_hash", "file_type", "extraction_method_used").join(
        chunks.select("content_hash"), "content_hash", "left_anti"
    )


# --- sections as table rows ---------------------------------------------------------------------


def structured_table(sections: DataFrame, doc: str, size: int, overlap: int) -> DataFrame:
    """Structure-aware chunks over section rows ``doc, position, heading, text``.

    Cutting is row-local; the index over the document is a blockwise running sum of piece counts.
    """
    cut = sections.withColumn("_pieces", structured_pieces(F.col("text"), size, overlap))
    placed = running(
        cut.select(doc, "position", "heading", "_pieces"), [doc], "position", sums={"_first": F.size("_pieces")}
    )
    return explode_rows(placed, "_pieces", doc, "heading", "_first", index="_i", value="chunk_text").select(
        doc,
        (F.col("_first") + F.col("_i")).cast("int").alias("chunk_index"),
        "chunk_text",
        F.col("heading").alias("section_heading"),
        approx_tokens(F.col("chunk_text")).alias("token_count"),
    )


def row_chunk_table(sections: DataFrame, *keys: str) -> DataFrame:
    """One chunk per section row, index = position."""
    return sections.filter(F.col("text") != "").select(
        *keys,
        F.col("position").alias("chunk_index"),
        F.col("text").alias("chunk_text"),
        F.col("heading").alias("section_heading"),
        approx_tokens(F.col("text")).alias("token_count"),
    )


def fixed_table(sections: DataFrame, doc: str, size: int, overlap: int) -> DataFrame:
    """Fixed windows over the joined text of section rows, without joining the text.

    Every section knows the offset at which it starts in the joined text (a blockwise running
    sum), hence which windows it touches. It sends its share of text to each of them, and a window
    only gathers its own shares, never a document.
    """
    window, lap = size * CHARS_PER_TOKEN, overlap * CHARS_PER_TOKEN
    if lap >= window:
        raise ValueError(f"windows of {size} tokens cannot share {overlap}")
    step = window - lap
    full = sections.filter(F.col("text") != "").select(doc, F.col("position").cast("long").alias("position"), "text")
    # Every section is preceded by its separator except the first one of the document.
    placed = running(full, [doc], "position", sums={"_at": F.length("text").cast("long") + 2})
    framed = placed.withColumn("_body", F.when(F.col("_at") > 0, F.concat(F.lit("\n\n"), F.col("text"))).otherwise(F.col("text")))
    framed = framed.withColumn("_from", F.greatest(F.col("_at") - 2, F.lit(0)))
    total = framed.groupBy(doc).agg(F.max(F.col("_from") + F.length("_body")).alias("_total"))
    sized = framed.join(total, doc)

    end = F.col("_from") + F.length("_body")
    first = F.greatest(F.lit(0), F.floor((F.col("_from") - window) / step) + 1)
    last = F.when(F.col("_total") <= window, F.lit(0)).otherwise(F.floor((end - 1) / step))
    shares = sized.select(
        doc, "position", "_from", "_body", F.explode(F.sequence(first.cast("long"), last.cast("long"))).alias("_w")
    )
    begin = F.greatest(F.col("_w") * step - F.col("_from"), F.lit(0))
    stop = F.least(F.col("_w") * step + window - F.col("_from"), F.length("_body").cast("long"))
    share = F.substring(F.col("_body"), (begin + 1).cast("int"), (stop - begin).cast("int"))
    return (
        shares.select(doc, F.col("_w").cast("int").alias("chunk_index"), "position", share.alias("t"))
        .groupBy(doc, "chunk_index")
        .agg(F.array_sort(F.collect_list(F.struct("position", "t"))).alias("p"))
        .select(doc, "chunk_index", F.array_join(F.col("p.t"), "").alias("chunk_text"))
        .withColumn("token_count", approx_tokens(F.col("chunk_text")))
    )
