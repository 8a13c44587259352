"""Merkle manifest of a dataset by sibling-shift self-joins.

Every row is a leaf; the leaves of a group, in order of their ids, are a tree of its own, and the
roots of the groups are the leaves of the tree above. At every level each node computes the indices of
its siblings (the shifts of its slot within its run of ``arity``; for two the other one, which is XOR
with 1) and is sent to them; an equi-join on (tree, index) gives each node its siblings, and the
rows of slot zero emit the parents. A way back down hands every leaf its siblings of all levels: its proof.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .ordering import numbered

PATH = "array<struct<before: binary, after: binary>>"


def sha(data: Column) -> Column:
    """SHA-256 as 32 bytes (half of the hex text in shuffles and tables)."""
    return F.unhex(F.sha2(data, 256))


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def row_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values end to end: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    parts = [F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string"))) for v in values]
    return sha(F.concat(*parts))


def parent_of(before: Column, own: Column, after: Column) -> Column:
    return sha(F.concat(hex_text(before), hex_text(own), hex_text(after)))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda own, step: parent_of(step["before"], own, step["after"]))


def path_digest(path: Column) -> Column:
    """SHA-256 (hex) of the siblings' digests as hex text, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(hex_text(step["before"]), hex_text(step["after"]))), ""), 256)


def with_siblings(nodes: DataFrame, arity: int, carry: Sequence[str] = ()) -> DataFrame:
    """``tree, idx, size, digest, before, after`` and ``carry``: each node with the digests of its siblings.

    A node with slot s goes to the slots (s + 1), ..., (s + run - 1) modulo the length of its run, so
    it emits at most ``arity - 1`` rows, and the join's keys are spread however large a tree is. What
    follows the join needs no further shuffle.
    """
    slot = F.col("idx") % arity
    run = F.least(F.lit(arity), F.col("size") - (F.col("idx") - slot))
    sent = (
        nodes.where(run > 1)
        .select("tree", "idx", "digest", slot.alias("slot"), run.alias("run"), F.explode(F.sequence(F.lit(1).cast("long"), run - 1)).alias("shift"))
        .select("tree", (F.col("idx") - F.col("slot") + (F.col("slot") + F.col("shift")) % F.col("run")).alias("to"), F.col("idx").alias("sibling"), F.col("digest").alias("theirs"))
    )
    paired = nodes.alias("n").join(sent.alias("s"), (F.col("n.tree") == F.col("s.tree")) & (F.col("n.idx") == F.col("s.to")), "left")
    gathered = paired.groupBy(F.col("n.tree").alias("tree"), F.col("n.idx").alias("idx")).agg(
        F.first("n.size").alias("size"), F.first("n.digest").alias("digest"), *[F.first(f"n.{c}").alias(c) for c in carry],
        F.sort_array(F.collect_list(F.when(F.col("s.sibling").isNotNull(), F.struct("s.sibling", "s.theirs")))).alias("siblings"),
    )
    nothing = F.unhex(F.lit(""))
    end_to_end = lambda which: F.aggregate(F.filter("siblings", which), nothing, lambda all_, s: F.concat(all_, s["theirs"]))
    return gathered.select(
        "tree", "idx", "size", "digest", *carry,
        end_to_end(lambda s: s["sibling"] < F.col("idx")).alias("before"), end_to_end(lambda s: s["sibling"] > F.col("idx")).alias("after"),
    )


def build_levels(leaves: DataFrame, arity: int, name: str, carry: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """(levels, tops): the stored nodes of every level that have siblings to meet, with them, and
    ``tree, height, digest``: what remains of each tree. Trees end at their own heights."""
    levels, tops, nodes = [], [], leaves
    largest = leaves.agg(F.max("size")).first()[0] or 0
    while True:
        tops.append(nodes.where("size = 1").select("tree", F.lit(len(levels)).alias("height"), "digest"))
        if largest <= 1:
            break
        level, _ = stored(with_siblings(nodes.where("size > 1"), arity, carry if not levels else ()), f"{name}-level")
        levels.append(level)
        nodes = level.where(F.col("idx") % arity == 0).select(
            "tree", F.floor(F.col("idx") / arity).alias("idx"), F.ceil(F.col("size") / arity).alias("size"),
            parent_of(F.col("before"), F.col("digest"), F.col("after")).alias("digest"),
        )
        largest = -(-largest // arity)
    every = tops[0]
    for one in tops[1:]:
        every = every.unionByName(one)
    return levels, stored(every, f"{name}-tops")[0]


def hand_down(levels: list[DataFrame], above: DataFrame, arity: int, passed: Sequence[str]) -> DataFrame:
    """``tree, idx, path`` and ``passed`` for the nodes of the lowest level: their siblings, level by level.

    ``above`` has ``tree, height, path`` and ``passed`` for the top of each tree. Each level is one
    equi-join of nodes with their parents, whose keys have at most ``arity`` rows; paths move for the parents only.
    """
    known = None
    for height in range(len(levels), 0, -1):
        tops = above.where(F.col("height") == height).select("tree", F.lit(0).cast("long").alias("idx"), "path", *passed)
        known = tops if known is None else known.unionByName(tops)
        parents = known.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), F.col("path").alias("_path"), *passed)
        level = levels[height - 1]
        known = level.join(parents, (F.col("tree") == F.col("_tree")) & (F.floor(F.col("idx") / arity) == F.col("_idx"))).select(
            *[c for c in level.columns if c not in ("size", "before", "after")],
            F.concat(F.array(F.struct("before", "after")), F.col("_path")).alias("path"), *passed,
        )
        if height > 1:
            known, _ = stored(known.select("tree", "idx", "path", *passed), "paths")
    return known


def manifest(
    rows: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id", group_col: str = "source",
    arity: int = 16, others: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``rows``: ``id, leaf, subroot, root`` (32 bytes each), ``path`` (array of the siblings
    before and after, leaf to root) and the columns ``others``, computed from ``rows``.

    Texts are read and hashed once, in the scan; only ids and digests are shuffled. Leaves of a
    group are ordered by id, null first, rows with the same id by their digest; repeated rows are leaves
    of their own. Rows without a group are a group (the first). Values are hashed as text,
    null and empty differ. A group of one row is its own subroot, a table of one group has its
    subroot as root. Other columns are not read. An empty table gives no rows.
    """
    extra = dict(others or {})
    at = {c: F.col(f"`{c}`") for c in fields}
    kind = rows.schema[id_col].dataType
    leaves, _ = stored(
        rows.select(
            F.col(f"`{id_col}`").alias("id"), F.col(f"`{group_col}`").cast("string").alias("part_of"),
            row_digest([at[c] for c in fields]).alias("digest"), *[v.alias(f"own_{k}") for k, v in extra.items()],
        ),
        "leaves",
    )
    own = ["id", *[f"own_{k}" for k in extra]]
    placed = numbered(leaves, ["part_of"], ["id", "digest"], "placed").drop("part_of")
    levels, subroots = build_levels(placed, arity, "groups", own)
    upper, roots = build_levels(numbered(subroots.select(F.lit(0).alias("all"), F.col("tree").alias("of"), "height", "digest"), ["all"], ["of"], "subroots").drop("all"), arity, "roots", ["of", "height"])
    root = roots.select(F.col("digest").alias("root"))
    empty_path = F.array().cast(PATH)
    if upper:
        above = roots.select("tree", "height", empty_path.alias("path"))
        paths = hand_down(upper, above, arity, []).select(F.col("of").alias("tree"), "height", F.col("digest").alias("subroot"), "path")
    else:
        paths = subroots.select("tree", "height", F.col("digest").alias("subroot"), empty_path.alias("path"))
    above, _ = stored(paths.crossJoin(F.broadcast(root)), "above")  # one root
    single = placed.where("size = 1").join(above.where("height = 0").select(F.col("tree").alias("_tree"), "path", "subroot", "root"), F.col("tree") == F.col("_tree"))
    out = single.select(*own, "digest", "subroot", "root", "path")
    if levels:
        out = hand_down(levels, above, arity, ["subroot", "root"]).select(*own, "digest", "subroot", "root", "path").unionByName(out)
    return out.select(F.col("id").cast(kind).alias("id"), F.col("digest").alias("leaf"), "subroot", "root", "path", *[F.col(f"own_{k}").alias(k) for k in extra])
