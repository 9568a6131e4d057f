"""Merkle manifest of a documents table by nested-interval labels, with proofs and their check.

H is the lowercase hex sha256 of its inputs concatenated, digests given as hex text. A row's leaf is H of
doc_id, source, lang, n_chars and text, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value
(integers in decimal). Per source, leaves ascend by doc_id; while more than one node remains, each run of
``FANOUT`` consecutive nodes (the last run shorter, even of one) becomes their H. What remains is the
source's subroot (a lone leaf is its own). Subroots ordered by source (null first, then UTF-8 bytewise)
give the root the same way.

Nested-interval labels: a node at level l with index i covers the leaf ranks [i * F^l, (i + 1) * F^l) of its
source, so its ancestor at level l' is the node with index rank div F^(l' - l). Every level is one grouping by
(source, index div F): a group holds at most F children, however large the source. In that same group each
child gets its siblings as the parent's interval minus its own: the digests left and right of it. Proofs are
then passed downwards one level at a time, joined by (source, parent index), again at most F children
a key; a leaf's proof is the list of (left, right) pairs from its level to the root, and folding a leaf
digest through it gives the root back.

Defined results: a null text, source, lang, n_chars or doc_id is ``-`` in the leaf; rows with a null
doc_id come first in their source. Repeated rows are separate leaves (equal, next to each other); rows
tied in doc_id are ordered by leaf digest. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.tables import stored
from .ranks import ranked

#: Children of a node.
FANOUT = 16

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*(field(c) for c in (doc_id, source, lang, n_chars, text))), 256)


def _source_key(source: Column) -> Column:
    """Never null, and ordered as sources are: null first, then the bytes of the source."""
    return F.when(source.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), source))


def _levels(nodes: DataFrame, purpose: str) -> tuple[DataFrame, list[DataFrame]]:
    """Build trees bottom-up from ``nodes`` (_g, _total, idx, h: level 0 of every group).

    Returns the tops (_g, level, h) and, per level l, the nodes of level l + 1 that have children:
    (_g, pidx, hs), hs the digests of the children in order. A node at level l is a top when the group's
    level l has one node only: _total <= F^l.
    """
    nodes = nodes.withColumn("level", F.lit(0))
    tops, parents, level = [], [], 0
    while True:
        span = FANOUT**level
        tops.append(nodes.filter(F.col("_total") <= span).select("_g", "level", "h"))
        inner = nodes.filter(F.col("_total") > span)
        if inner.isEmpty():
            break
        kids = inner.groupBy("_g", "_total", (F.col("idx") / FANOUT).cast("long").alias("pidx")).agg(
            F.array_sort(F.collect_list(F.struct("idx", "h"))).alias("kids")
        )
        kids = stored(kids.select("_g", "_total", "pidx", F.transform("kids", lambda k: k["h"]).alias("hs")), f"{purpose}-level{level + 1}")
        parents.append(kids.select("_g", "pidx", "hs"))
        nodes = kids.select(
            "_g", "_total", F.col("pidx").alias("idx"), F.sha2(F.array_join("hs", ""), 256).alias("h"), F.lit(level + 1).alias("level")
        )
        level += 1
    top = tops[0]
    for more in tops[1:]:
        top = top.unionByName(more)
    return top, parents


def _own_path(idx: Column) -> Column:
    """The node's (left, right) siblings, read from its parent's ``hs``, before the parent's ``path``."""
    at = (idx % FANOUT).cast("int")
    hs = F.col("hs")
    own = F.struct(F.array_join(F.slice(hs, 1, at), "").alias("l"), F.array_join(F.slice(hs, at + 2, F.size(hs)), "").alias("r"))
    return F.concat(F.array(own), F.col("path"))


def _paths(nodes: DataFrame, parents: list[DataFrame], tops: DataFrame, purpose: str) -> DataFrame:
    """``nodes`` (level 0: _g, idx, ...) with ``path`` and the carried columns of ``tops``.

    ``tops`` holds (_g, level, path, ...): the path from each group's top upwards. A child's path is its own
    (left, right), cut from its parent's digests, followed by its parent's path; each level is one join by
    (group, parent index), at most ``FANOUT`` children a key. Paths of inner levels are written; those of
    level 0 are only formed where they are used.
    """
    carried = [c for c in tops.columns if c not in ("_g", "level", "path")]

    def tops_at(level: int) -> DataFrame:
        return tops.filter(F.col("level") == level).select("_g", F.lit(0).cast("long").alias("idx"), "path", *carried)

    above = tops_at(len(parents))
    for level in reversed(range(len(parents))):
        # Parents at level + 1, each with its children's digests and its own path.
        upper = parents[level].join(above.withColumnRenamed("idx", "pidx"), ["_g", "pidx"])
        if level == 0:
            break
        children = upper.select("_g", "pidx", "hs", "path", *carried, F.posexplode("hs").alias("at", "h")).withColumn(
            "idx", F.col("pidx") * FANOUT + F.col("at")
        )
        here = children.select("_g", "idx", _own_path(F.col("idx")).alias("path"), *carried)
        above = stored(here, f"{purpose}-paths{level}").unionByName(tops_at(level))
    else:
        return nodes.join(tops_at(0), ["_g", "idx"])
    single = nodes.filter(F.col("_total") == 1).join(tops_at(0), ["_g", "idx"])
    inner = nodes.filter(F.col("_total") > 1).withColumn("pidx", (F.col("idx") / FANOUT).cast("long"))
    inner = inner.join(upper, ["_g", "pidx"]).withColumn("path", _own_path(F.col("idx"))).drop("pidx", "hs")
    return inner.unionByName(single)


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified: one row per documents row.

    ``tampered`` (a column of ``docs``, boolean) marks rows whose text is lower-cased (A-Z) before their
    leaf is folded again through the untampered proof; ``folded_root`` then differs from ``root`` if the
    text had capitals. Without it nothing is tampered and every row is verified.
    """
    t = F.col("text")
    changed = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    rows = docs.select(
        F.col("doc_id"),
        F.col("source"),
        leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), t).alias("leaf"),
        F.when(changed, leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.translate(t, UPPER, LOWER)))
        .otherwise(F.lit(None).cast("string"))
        .alias("tleaf"),
    ).withColumn("_g", _source_key(F.col("source")))
    leaves = ranked(rows, [F.col("doc_id").asc_nulls_first(), F.col("leaf")], "_g", "manifest-leaves")
    leaves = leaves.withColumn("idx", F.col("_rank"))

    source_tops, source_parents = _levels(leaves.select("_g", "_total", "idx", F.col("leaf").alias("h")), "manifest-source")
    subroots = stored(source_tops, "manifest-subroots")
    # The root tree: one group, subroots in the order of their key.
    placed = ranked(subroots.select(F.col("_g").alias("_sg"), "level", "h", F.lit("").alias("_g")), [F.col("_sg")], "_g", "manifest-order")
    placed = placed.withColumn("idx", F.col("_rank"))
    root_tops, root_parents = _levels(placed.select("_g", "_total", "idx", "h"), "manifest-root")
    no_path = F.array().cast("array<struct<l:string,r:string>>")
    root_top = root_tops.select("_g", F.lit(len(root_parents)).alias("level"), no_path.alias("path"), F.col("h").alias("root"))
    # The subroots' paths in the root tree become the tops of the source trees.
    tops = _paths(placed, root_parents, root_top, "manifest-root").select(
        F.col("_sg").alias("_g"), "level", "path", F.col("h").alias("subroot"), "root"
    )
    found = _paths(leaves, source_parents, stored(tops, "manifest-tops"), "manifest-source")
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), ""), 256)
    start = F.coalesce(F.col("tleaf"), F.col("leaf"))
    folded = F.aggregate("path", start, lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))
    return found.select(
        "doc_id", "source", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def tamper_rule(doc_id: Column) -> Column:
    """Rows whose unsigned crc32 of the decimal doc_id is divisible by 5; a null id is never tampered."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0
