"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints within ``2 r`` bits of each other share a variant within ``r`` bits of
both. So every distinct fingerprint emits all variants within ``r`` bits, equal variants
meet, and whoever shares one is a pair at most ``2 r`` bits apart.

The variants are shuffled by ``b`` of their bits: a fingerprint is sent once to every
bucket that one of its variants falls into, and the bucket's task derives the variants
inside it. That moves ``1 + b + b(b-1)/2`` rows per fingerprint instead of 2,081, while
each variant still meets its equals in exactly one task. Crowded buckets are halved at their
own evenest bits within the task, and sent on by further bits where too many reach them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored, text_udf, utf8
from .graph import connected_components

SEED = 42
VARIANTS_PER_BUCKET = 1 << 21
MOST_IN_BUCKET = 1 << 20  # fingerprints that one task walks
FURTHER_BITS = 8  # by which a fuller bucket is sent on
SEGMENT_BYTES = 1 << 21  # of a text whose words are held at once
_CHUNK = 1 << 16
_BLANK = re.compile(rb"[\x20\x09-\x0d]")


def fingerprint(text: str | None, words_per_shingle: int = 4) -> int:
    """64-bit SimHash of the word shingles of a text, as an unsigned integer.

    A-Z are lower-cased, words are split at ASCII blanks, shingles (repeats included) are
    hashed by XXH64 with seed 42, and a bit is 1 if it is set in over half the hashes.
    Fewer words than a shingle has: the whole sequence is the one shingle. No words: 0.
    """
    data = utf8(text or "").lower()  # on bytes: A-Z only
    k, at, count, words = words_per_shingle, 0, 0, []
    ones = np.zeros(64, np.int64)
    while at < len(data):  # a segment at a time; the last k - 1 words go on into the next
        blank = _BLANK.search(data, at + SEGMENT_BYTES)
        end = blank.start() if blank else len(data)
        words += data[at:end].split()  # at the six ASCII blanks
        at = end
        if len(words) >= k:
            own, n = _set_bits(words, k)
            ones += own
            count += n
            words = words[len(words) - k + 1:]
    if not count and words:
        ones, count = _set_bits(words, len(words))
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def _set_bits(words: list[bytes], k: int) -> tuple[np.ndarray, int]:
    """(how many shingle hashes have each bit set, number of shingles)."""
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    first, last, digest = (ends - lengths)[: len(words) - k + 1], ends[k - 1:], xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(first), _CHUNK):
        spans = zip(first[at:at + _CHUNK].tolist(), last[at:at + _CHUNK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return ones, len(first)


def fingerprint_column(text: Column, words_per_shingle: int = 4) -> Column:
    """:func:`fingerprint` of a text column, as a signed long."""

    def run(texts: list[str | None]) -> pa.Array:
        return pa.array(np.array([fingerprint(t, words_per_shingle) for t in texts], np.uint64).view(np.int64))

    return text_udf(run, "long")(text)


def hex_column(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _masks(bits: list[int], most: int) -> list[np.ndarray]:
    """For each number of flips from 0 to ``most``: the XOR masks that flip so many of ``bits``."""
    return [
        np.array([sum(1 << i for i in flipped) for flipped in combinations(bits, n)], np.uint64)
        for n in range(most + 1)
    ]


def bucket_bits(fps: DataFrame, rows: int, radius: int, variants_per_bucket: int = VARIANTS_PER_BUCKET) -> list[int]:
    """The bits of a variant that name its bucket: as many as keep a bucket's variants at
    the stated number on average, the evenest ones (one narrow aggregate over ``fps``)."""
    per_fp = sum(math.comb(64, n) for n in range(radius + 1))
    wanted = min(32, max(0, math.ceil(math.log2(max(1, rows * per_fp / variants_per_bucket)))))
    if not wanted:
        return []
    ones = fps.agg(*[F.sum(F.shiftrightunsigned("fp", i).bitwiseAND(F.lit(1).cast("long"))).alias(f"b{i}") for i in range(64)]).first()
    return sorted(sorted(range(64), key=lambda i: (abs(ones[i] - rows / 2), i))[:wanted])


def _fixed(fps: np.ndarray, mask: int, value: int) -> tuple[np.ndarray, np.ndarray]:
    """(each fingerprint with the bits of ``mask`` set as in ``value``, how many of them that flips)."""
    m, v = np.uint64(mask), np.uint64(value)
    return (fps & ~m) | v, np.bitwise_count((fps ^ v) & m)


def _even_bits(values: np.ndarray, free: list[int], wanted: int) -> list[int]:
    """The ``wanted`` bits of ``free`` that split ``values`` most evenly."""
    off = [abs(2 * int(((values >> np.uint64(i)) & np.uint64(1)).sum()) - len(values)) for i in free]
    return [free[i] for i in sorted(range(len(free)), key=lambda i: (off[i], i))[:wanted]]


def _slices(at: np.ndarray, base: np.ndarray, spent: np.ndarray, free: list[int], radius: int, limit: int, joined) -> Iterator[tuple]:
    """Parts of one bucket with at most ``limit`` variants each; every variant lies in exactly one.

    A part with more is halved at its own evenest bit: those with the other value of the bit spend
    a flip on it or drop out. Parts whose members ``joined`` says are linked already are left out.
    """
    todo = [(at, base, spent, free)]
    while todo:
        at, base, spent, free = todo.pop()
        if len(at) < 2 or joined(at):
            continue
        left = np.bincount(spent, minlength=radius + 1).tolist()
        total = sum(left[n] * math.comb(len(free), k) for n in range(radius + 1) for k in range(radius - n + 1))
        if total <= limit or not free:
            yield at, base, spent, free
            continue
        (bit,) = _even_bits(base, free, 1)
        flag, rest, halves = np.uint64(1 << bit), [i for i in free if i != bit], []
        for value in (0, 1):
            into = base | flag if value else base & ~flag
            more = spent + (into != base)
            stay = np.flatnonzero(more <= radius)
            halves.append((at[stay], into[stay], more[stay], rest))
        todo += sorted(halves, key=lambda h: int((h[2] == 0).sum()))  # the fuller one first: its links spare others


def _unite(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """``label`` (least member of each one's component) once ``u`` and ``v`` are linked."""
    while True:
        a, b = label[u], label[v]
        apart = np.flatnonzero(a != b)
        if not len(apart):
            return label
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _star_links(fps: np.ndarray, mask: int, value: int, radius: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the fingerprints that share a variant in this bucket, as a spanning forest.

    ``fps`` are distinct and ascending. Everyone with a variant in common is within
    ``2 * radius`` bits of everyone else there, so a star around the least of them keeps the
    connection without all pairs; each link is checked on its bits all the same. Variants are
    derived in slices of at most ``limit``, so memory is bounded however tight a cluster is.
    """
    base, spent = _fixed(fps, mask, value)
    label, masks = np.arange(len(fps)), {}
    at = np.flatnonzero(spent <= radius)
    free = [i for i in range(64) if not mask >> i & 1]
    joined = lambda some: bool((label[some] == label[some[0]]).all())
    for at, base, spent, free in _slices(at, base[at], spent[at].astype(np.int64), free, radius, limit, joined):
        if tuple(free) not in masks:
            masks = {tuple(free): _masks(free, radius)}
        values, owners = [], []
        for n in range(radius + 1):
            own = np.flatnonzero(spent == n)
            for flips in masks[tuple(free)][: radius - n + 1]:
                if len(own) and len(flips):
                    values.append((base[own, None] ^ flips[None, :]).ravel())
                    owners.append(np.repeat(at[own].astype(np.int32), len(flips)))
        variant, owner = np.concatenate(values), np.concatenate(owners)
        order = np.argsort(variant)
        variant, owner = variant[order], owner[order]
        starts = np.flatnonzero(np.concatenate([[True], variant[1:] != variant[:-1]]))
        least = np.minimum.reduceat(owner, starts)  # fps ascend, so the least index is the least fingerprint
        other = np.repeat(least, np.diff(np.append(starts, len(owner))))
        apart = np.flatnonzero(label[owner] != label[other])
        packed = np.unique(owner[apart].astype(np.int64) << 32 | other[apart])
        u, v = packed >> 32, packed & 0xFFFFFFFF
        close = np.bitwise_count(fps[u] ^ fps[v]) <= 2 * radius
        label = _unite(label, u[close], v[close])
    linked = np.flatnonzero(label != np.arange(len(fps)))
    return fps[linked], fps[label[linked]]


def _spread(fps: np.ndarray, mask: int, value: int, bits: list[int], radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket value, fingerprint) for each bucket of ``mask`` and ``bits`` that a variant of a fingerprint
    of bucket ``(mask, value)`` falls into, some at a time."""
    base, spent = _fixed(fps, mask, value)
    now = mask | sum(1 << i for i in bits)
    for n, flips in enumerate(_masks(bits, radius)):
        at = np.flatnonzero(spent <= radius - n)
        for some in np.array_split(at, -(-len(at) * max(1, len(flips)) // _CHUNK) or 1):
            if len(some) and len(flips):
                yield ((base[some] & np.uint64(now))[:, None] ^ flips[None, :]).ravel(), np.repeat(fps[some], len(flips))


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _same(value: int, n: int) -> pa.Array:
    return _long(np.full(n, value, np.uint64))


def ball_links(
    fps: DataFrame, max_bits: int = 4, variants_per_bucket: int = VARIANTS_PER_BUCKET, most_in_bucket: int = MOST_IN_BUCKET
) -> DataFrame:
    """Edges ``(u, v)`` whose components are those of "at most ``max_bits`` bits apart".

    ``fps``: a stored table with one row per distinct fingerprint, column ``fp`` (long).
    ``max_bits`` is even; half of it is the ball's radius.

    A bucket is ``(mask, value)``: the variants with these bits. One that more than
    ``most_in_bucket`` fingerprints reach is not walked; its task sends them on to buckets of further
    bits, even within it, and the next round meets them there.
    """
    if max_bits % 2:
        raise ValueError("max_bits must be even: each side spends half of it")
    radius = max_bits // 2
    bits = bucket_bits(fps, fps.count(), radius, variants_per_bucket)
    first = sum(1 << i for i in bits)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, fp in _spread(np.asarray(batch.column(0)).view(np.uint64), 0, 0, bits, radius):
                yield pa.RecordBatch.from_arrays([_same(first, len(fp)), _long(value), _long(fp)], names=["mask", "value", "fp"])

    def meet(group: pa.Table) -> pa.Table:
        mask, value = (int(group.column(c)[0].as_py()) & (1 << 64) - 1 for c in ("mask", "value"))
        found = np.unique(np.asarray(group.column("fp").combine_chunks()).view(np.uint64))
        free = [i for i in range(64) if not mask >> i & 1]
        if len(found) <= most_in_bucket or not free:
            u, v = _star_links(found, mask, value, radius, variants_per_bucket)
            return pa.table({"mask": pa.nulls(len(u), pa.int64()), "u": _long(u), "v": _long(v)})
        more = _even_bits(found, free, FURTHER_BITS)
        parts = list(_spread(found, mask, value, more, radius))
        u, v = (np.concatenate(c) for c in zip(*parts, strict=True))
        return pa.table({"mask": _same(mask | sum(1 << i for i in more), len(u)), "u": _long(u), "v": _long(v)})

    sent, links = fps.select("fp").mapInArrow(send, "mask long, value long, fp long"), []
    while True:
        met, _ = stored(sent.groupBy("mask", "value").applyInArrow(meet, "mask long, u long, v long"), "met")
        links.append(met.where(F.col("mask").isNull()).select("u", "v"))
        over = met.where(F.col("mask").isNotNull())
        if over.isEmpty():
            return reduce(DataFrame.unionByName, links).distinct()
        sent = over.select("mask", F.col("u").alias("value"), F.col("v").alias("fp"))


def _classes(prints: DataFrame, id_col: str, max_bits: int) -> DataFrame:
    """``(fp, component_id)`` for each distinct fingerprint of ``prints``."""
    fps, _ = stored(prints.groupBy("fp").agg(F.min(id_col).alias("least_id")), "fingerprints")
    parts, _ = stored(connected_components(ball_links(fps, max_bits)), "components")
    members = parts.join(fps, parts["node"] == fps["fp"]).select("fp", "root", "least_id")
    least = members.groupBy("root").agg(F.min("least_id").alias("component_id"))
    linked = members.join(least, "root").select("fp", "component_id")
    return (
        fps.join(linked.withColumn("linked", F.lit(True)), "fp", "left")
        .select("fp", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least_id")).alias("component_id"))
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 4, max_bits: int = 4
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    Documents are grouped by fingerprint first (a group of copies is one row from there on),
    fingerprints at most ``max_bits`` bits apart are linked by :func:`ball_links`, and
    ``component_id`` is the least id reachable over links.

    A null or empty text has fingerprint zero and links like any other. Null ids are
    never a component's id while it has another; repeated rows stay. Other columns of
    ``docs`` are not read. An empty table gives no rows.
    """
    prints, _ = stored(
        docs.select(F.col(f"`{id_col}`").alias("doc_id"), fingerprint_column(F.col(f"`{text_col}`").cast("string"), words_per_shingle).alias("fp")),
        "prints",
    )
    classes, _ = stored(_classes(prints, "doc_id", max_bits), "classes")
    return prints.join(classes, "fp").select("doc_id", hex_column(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one_per_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 4, max_bits: int = 4
) -> DataFrame:
    """The columns of ``docs``, one row per near-duplicate group: the one with the least id.

    Ties (repeated rows, null ids) go to the first row of the written table, so exactly
    one row of a group stays.
    """
    row, fp = fresh(docs, "row_no"), fresh(docs, "print_of_text")
    marked, _ = stored(
        docs.withColumn(fp, fingerprint_column(F.col(f"`{text_col}`").cast("string"), words_per_shingle)).withColumn(row, F.monotonically_increasing_id()),
        "marked",
    )
    prints = marked.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    fps, _ = stored(
        prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first")), "fingerprints"
    )
    parts, _ = stored(connected_components(ball_links(fps, max_bits)), "components")
    best = (
        fps.join(parts, fps["fp"] == parts["node"], "left")
        .groupBy(F.coalesce("root", "fp").alias("root"))
        .agg(F.min("first").alias("first"))
        .select(F.col("first.row").alias(row))
    )
    return marked.join(best, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
