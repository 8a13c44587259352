"""Prefix trie of rebuilt conversations by whole-sequence collapse.

Conversations that are equal as a whole become one weighted sequence with the list of those that end there.
Sequences that are a proper prefix of another are found by an anti-join; what remains are the leaves.
The sequences' prefixes, with their weights, are aggregated to the nodes of the trie. A prefix is
known by 128 bits: the XOR of a digest of each of its turns and the turn's place, so running digests
need only associative sums, a parent's digest follows from its child's, and a long conversation is
summed in chunks by different tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .ordering import numbered

CHUNK = 4096  # turns of a sequence that one task sums at once
NODE = ("depth", "p1", "p2")  # what identifies a node
WORDS = r"[^\x20\x09-\x0D]+"


def running(rows: DataFrame, key: Sequence[str], place: str, sums: dict[str, tuple[str, str]], descending: bool = False) -> DataFrame:
    """``rows`` with running totals: ``sums`` maps a new column to (aggregate function, column).

    ``place`` counts a key's rows. A window covers CHUNK places of a key; the totals of the
    chunks before it are added from a table with one row per chunk, so no key is one task.
    """
    aggregate = lambda how, c: getattr(F, how)(c)
    combine = lambda how, a, b: a.bitwiseXOR(b) if how == "bit_xor" else a + b
    rows = rows.withColumn("_chunk", F.floor(F.col(place) / CHUNK))
    order = F.col(place).desc() if descending else F.col(place).asc()
    chunk_order = F.col("_chunk").desc() if descending else F.col("_chunk").asc()
    inside = Window.partitionBy(*key, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumns({name: aggregate(how, c).over(inside) for name, (how, c) in sums.items()})
    long = rows.groupBy(*key, "_chunk").agg(*[aggregate(how, c).alias(f"_t_{name}") for name, (how, c) in sums.items()])
    before = Window.partitionBy(*key).orderBy(chunk_order).rowsBetween(Window.unboundedPreceding, -1)
    carried = long.select(*key, "_chunk", *[aggregate(how, f"_t_{name}").over(before).alias(f"_c_{name}") for name, (how, _) in sums.items()])
    carried = carried.where(F.col(f"_c_{next(iter(sums))}").isNotNull())  # keys of one chunk carry nothing
    out = local.join(carried, [*key, "_chunk"], "left")
    return out.select(
        *[c for c in rows.columns if c != "_chunk"],
        *[combine(how, F.col(name), F.coalesce(F.col(f"_c_{name}"), F.lit(0))).alias(name) for name, (how, _) in sums.items()],
    )


def ordered_turns(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv_id, seq, k1, k2, words``: turns in order, by 128 bits of a digest of role and text. Stored, without texts."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = conversations.select(
        F.col(f"`{id_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"), text.alias("text"),
    ).where("conv_id is not null")
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    hashed = rows.withColumns({"words": F.size(F.regexp_extract_all("text", F.lit(WORDS), F.lit(0))), "digest": digest})
    # role and text order turns that tie; they move once and are not stored
    return numbered(hashed, ["conv_id"], ["turn", "role", "text"], "turns", drop=["turn", "role", "text"]).select(
        "conv_id", F.col("idx").alias("seq"), F.xxhash64("digest", F.lit(1)).alias("k1"), F.xxhash64("digest", F.lit(2)).alias("k2"), "words",
    )


def rebuilt_turns(turns: DataFrame, base_of: Column, borrowed: Column) -> tuple[DataFrame, DataFrame]:
    """(``conv_id, pos, k1, k2, words``, ``conv_id, length``): each conversation begins with the first
    ``borrowed`` turns (columns of ``conv_id``) of conversation ``base_of``, then has its own after as many.

    Only the few first turns of the base conversations are joined to those that borrow them.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("turns"))
    convs = sizes.withColumns({"base": base_of, "h": borrowed})
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("turns").alias("base_turns"))
    convs, _ = stored(
        convs.join(bases, "base", "left").withColumn("kept", F.least("h", F.coalesce("base_turns", F.lit(0))))
        .select("conv_id", "base", "h", "kept", (F.greatest(F.col("turns") - F.col("h"), F.lit(0)) + F.col("kept")).alias("length")),
        "convs",
    )
    most = convs.agg(F.max("h")).first()[0] or 0
    own = turns.join(convs.select("conv_id", "h", "kept"), "conv_id").where("seq >= h").select(
        "conv_id", (F.col("seq") - F.col("h") + F.col("kept")).alias("pos"), "k1", "k2", "words"
    )
    first = turns.where(F.col("seq") < most).withColumnRenamed("conv_id", "base")
    lent = convs.where("kept > 0").select("conv_id", "base", "kept").join(first, "base").where("seq < kept").select(
        "conv_id", F.col("seq").alias("pos"), "k1", "k2", "words"
    )
    return own.unionByName(lent), convs.select("conv_id", "length")


def end_lists(ends: DataFrame) -> DataFrame:
    """``depth, p1, p2, ends_sha256``: digest of each node's conversations, ascending, comma-joined.

    Lists of one need no shuffle of their own. A longer list streams through its task in order,
    as a digest of a concatenation must; it is never held.
    """
    sizes = ends.groupBy(*NODE).agg(F.count("*").alias("n"), F.min("conv_id").alias("least"))
    alone = sizes.where("n = 1").select(*NODE, F.sha2(F.col("least").cast("string"), 256).alias("ends_sha256"))
    several = ends.join(sizes.where("n > 1").select(*NODE), list(NODE)).select(*NODE, "conv_id")
    several = several.repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state, done = None, None, []
        for batch in batches:
            for depth, p1, p2, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (depth, p1, p2) != own:
                    if own is not None:
                        done.append((*own, state.hexdigest()))
                    own, state = (depth, p1, p2), hashlib.sha256(str(conv).encode())
                else:
                    state.update(f",{conv}".encode())
            if len(done) >= 10_000:
                yield _rows(done)
                done = []
        if own is not None:
            done.append((*own, state.hexdigest()))
        if done:
            yield _rows(done)

    return alone.unionByName(several.mapInArrow(run, "depth long, p1 long, p2 long, ends_sha256 string"))


def _rows(done: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], k) for i, k in enumerate(kinds)], names=[*NODE, "ends_sha256"])


def prefix_trie(
    conversations: DataFrame, base_of: Column | None = None, borrowed: Column | None = None,
    id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row per node: ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Turns are ordered by turn, null first, ties by role and text; null roles and texts are empty ones;
    repeated rows are turns of their own. Conversations may begin with turns of another (``base_of`` and
    ``borrowed``, columns over ``conv_id``). Rows without a conversation id are no conversation. Other
    columns are not read. An empty table gives no rows, a table of turnless conversations the root.

    ``saved_tokens`` sums (members - 1) x words of the last text over a subtree. Each node is owned by one
    leaf sequence through it (the least); the owned nodes of a leaf are the end of its path. So a
    node's subtree holds what its owner owns from it on, and all that the other leaves below it own.
    """
    turns = ordered_turns(conversations, id_col, turn_col, role_col, text_col)
    base = base_of if base_of is not None else F.col("conv_id")
    rebuilt, lengths = rebuilt_turns(turns, base, borrowed if borrowed is not None else F.lit(0).cast("long"))
    placed = rebuilt.withColumns({f"t{i}": F.xxhash64(f"k{i}", F.col("k1") if i == 2 else F.col("k2"), "pos", F.lit(i)) for i in (1, 2)})
    prefixes, _ = stored(
        running(placed, ["conv_id"], "pos", {"p1": ("bit_xor", "t1"), "p2": ("bit_xor", "t2")})
        .select("conv_id", (F.col("pos") + 1).alias("depth"), "p1", "p2", F.col("p1").bitwiseXOR(F.col("t1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("t2")).alias("q2"), "words"),
        "prefixes",
    )
    lengths = lengths.withColumnRenamed("length", "depth")
    nought = [F.lit(0).cast("long").alias(c) for c in ("p1", "p2")]
    # whole conversations: the last prefix of each, the root for those without turns
    ends, _ = stored(
        prefixes.join(lengths, ["conv_id", "depth"]).select("conv_id", *NODE)
        .unionByName(lengths.where("depth = 0").select("conv_id", "depth", *nought)),
        "ends",
    )
    sequences, _ = stored(ends.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight")), "sequences")
    roots = sequences.select("conv_id", F.lit(0).cast("long").alias("depth"), *nought, *[c.alias(f"q{i + 1}") for i, c in enumerate(nought)], F.lit(0).alias("words"))
    paths, _ = stored(
        prefixes.unionByName(roots).join(sequences.select("conv_id", "weight", F.col("depth").alias("length")), "conv_id"), "paths"
    )
    # a sequence that a longer one passes through is no leaf
    inner = paths.where("depth < length").select(*NODE).distinct()
    leaves, _ = stored(sequences.join(inner, list(NODE), "left_anti").select("conv_id", F.lit(1).alias("leaf")), "leaves")
    nodes, _ = stored(
        paths.join(leaves, "conv_id", "left").groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.count("leaf").alias("n_leaves"),
            F.min(F.when(F.col("leaf") == 1, F.col("conv_id"))).alias("owner"), F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.min("words").alias("words"),
        ).withColumn("saved", (F.col("n_convs") - 1) * F.col("words")),
        "nodes",
    )
    owned = nodes.groupBy("owner").agg(F.sum("saved").alias("total"))
    below = (
        paths.join(leaves, "conv_id").join(owned, F.col("conv_id") == F.col("owner"))
        .groupBy(*NODE).agg(F.sum("total").alias("below"))
    )
    chains = running(nodes.select(*NODE, "owner", "saved"), ["owner"], "depth", {"from_here": ("sum", "saved")}, descending=True)
    saved = (
        chains.join(owned, "owner").join(below, list(NODE))
        .select(*NODE, (F.col("below") - F.col("total") + F.col("from_here")).alias("saved_tokens"))
    )
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n_children"))
    # the root's children need no join by key: it is one row
    root = nodes.where("depth = 0").select(F.col("conv_id").alias("of_root"))
    deeper = nodes.where("depth > 1").select(*NODE, (F.col("depth") - 1).alias("_d"), "q1", "q2")
    above = nodes.select(F.col("depth").alias("_d"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent"))
    parents = deeper.join(above, ["_d", "q1", "q2"]).select(*NODE, "parent").unionByName(
        nodes.where("depth = 1").select(*NODE).crossJoin(F.broadcast(root)).withColumnRenamed("of_root", "parent")
    )
    key = list(NODE)
    return (
        nodes.select(*key, "conv_id", "n_convs", "n_leaves")
        .join(saved, key).join(children, key, "left").join(parents, key, "left").join(end_lists(ends), key, "left")
        .select(
            "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
            "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
