"""Best-fit packing of token sequences by a distributed grouping genetic algorithm.

A solution groups pieces into bins. Crossover injects whole well-filled bins of one parent
into the other, drops the bins that hold the same pieces twice and best-fits the displaced
pieces. Pieces are dealt into shards of bounded size; every shard has several islands, each
with its own population, and between epochs an island's best solution moves to the next one.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boundaries import with_blanks
from .common import give_back_memory, slices_by_bytes, stored

CACHE_WORDS = 800_000  # kept by a worker from task to task, about 120 MB
CACHE_BYTES = 1 << 27  # the same, as bytes of words and ids
LONG_CHARS = 1 << 15  # a run without blanks is read in parts of about this length
CALL_CHARS = 1 << 18  # that the library is given at once
# Fixed value: the pre-token pattern of the files that are read by chunks.
_PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BATCH_BYTES = 1 << 23
# A word of Latin letters and the marks after it: two pre-tokens, whatever stands around them.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_CHUNK = f"^(?P<word>[{_LETTERS}]+)(?P<marks>[.,!?;:]*)$"
_WORD = re.compile(f"[{_LETTERS}]+")
_BLANK = re.compile(r"[\x20\x09-\x0d]")


class BlankFreeIds:
    """Token ids for a ``tokenizers`` file whose pre-tokens never hold white space.

    Such a tokenizer gives a text the ids of its blank-separated chunks one after the
    other. So the distinct chunks of a batch are looked up, not its words: a chunk is a word
    and its marks, or else itself, and what was not met before goes to the library.
    The ids of the batch are then gathered by number. The cache is emptied when full. Long runs without
    blanks are parted where a letter meets a mark; one endless pre-token stays whole. Files with
    other pre-tokens or that do not lower-case are left to the library, text by text.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already runs a task per core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        with open(path, encoding="utf-8") as fh:
            made = json.load(fh)
        steps = (made.get("pre_tokenizer") or {}).get("pretokenizers", [])
        cases = (made.get("normalizer") or {}).get("normalizers", [])
        splits = [s["pattern"].get("Regex") for s in steps if s["type"] == "Split"]
        self.by_chunks = splits == [_PRE_TOKENS] and any(c["type"] == "Lowercase" for c in cases)
        self.suffix = getattr(self.tok.model, "end_of_word_suffix", None)
        vocabulary = self.tok.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = bool(self.suffix) and token.endswith(self.suffix)
        self.forget()

    def forget(self) -> None:
        """Empty the cache."""
        self.held = self.held_ids = 0
        self.numbers: dict[str, int] = {"": 0}
        self.ids = np.empty(0, "<u4")
        self.offsets = np.zeros(2, np.int64)

    def full(self, words: int) -> bool:
        """Whether the cache holds more than ``words`` or CACHE_BYTES."""
        return len(self.numbers) > words or self.held > CACHE_BYTES

    def _library(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The library's ids of each text, about CALL_CHARS characters in one call."""
        at = 0
        while at < len(texts):
            to, size = at + 1, len(texts[at])
            while to < len(texts) and size + len(texts[to]) <= CALL_CHARS:
                size += len(texts[to])
                to += 1
            for one in self.tok.encode_batch_fast(texts[at:to], add_special_tokens=False):
                yield np.array(one.ids, "<u4")
            at = to

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        if not self.by_chunks:
            return [ids.tobytes() for ids in self._library(texts.to_pylist())]
        if (pc.max(pc.binary_length(texts)).as_py() or 0) > LONG_CHARS:
            texts = pa.array([with_blanks(t, LONG_CHARS) for t in texts.to_pylist()], pa.string())
        chunks = pc.ascii_split_whitespace(texts)
        coded = chunks.flatten().dictionary_encode()
        if self.full(CACHE_WORDS):
            self.forget()
        parts = pc.extract_regex(coded.dictionary, _CHUNK)
        simple = parts.is_valid()
        words = pc.if_else(simple, pc.utf8_lower(pc.struct_field(parts, "word")), coded.dictionary).dictionary_encode()
        marks = pc.if_else(simple, pc.struct_field(parts, "marks"), "").dictionary_encode()
        both = np.stack([self._lookup(words), self._lookup(marks)], axis=1).ravel()
        pool, lengths = _gathered(self.ids, self.offsets, both)
        offsets = np.concatenate([[0], np.cumsum(lengths)])[::2]  # of the chunks
        ids, lengths = _gathered(pool, offsets, np.asarray(coded.indices))
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.asarray(chunks.offsets)] * 4
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def encode_long(self, text: str) -> list[bytes]:
        """The ids of one text, as a list of one: long ones are read in parts, cut at blanks."""
        if not self.by_chunks:
            return self.encode([text])
        text = with_blanks(text, LONG_CHARS)
        parts, at = [], 0
        while len(text) - at > BATCH_BYTES:
            blank = _BLANK.search(text, at + BATCH_BYTES)
            if blank is None:
                break
            parts.append(self.encode([text[at:blank.start()]])[0])
            at = blank.start()
        return [b"".join([*parts, self.encode([text[at:]])[0]])]

    def _lookup(self, coded: pa.DictionaryArray) -> np.ndarray:
        names = coded.dictionary.to_pylist()
        numbers = list(map(self.numbers.get, names))
        new = [w for w, n in zip(names, numbers, strict=True) if n is None]
        if new:
            self._learn(new)
            numbers = list(map(self.numbers.get, names))
        return np.array(numbers, np.int64)[np.asarray(coded.indices)]

    def _learn(self, new: list[str]) -> None:
        words = [w for w in new if self.suffix and _WORD.fullmatch(w)]
        plain = set(words)
        others = [w for w in new if w not in plain]
        found, sizes = [], []
        runs = [words[at:at + 1000] for at in range(0, len(words), 1000)]
        joined = self.tok.encode_batch_fast([" ".join(part) for part in runs], add_special_tokens=False)
        for part, text in zip(runs, joined, strict=True):  # words of letters: each ends where a token has the suffix
            ids = np.array(text.ids, "<u4")
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) != len(part):
                others += part
                plain.difference_update(part)
                continue
            found.append(ids)
            sizes.append(np.diff(ends, prepend=-1))
        words = [w for w in words if w in plain]
        if others:
            singles = list(self._library(others))
            found += singles
            sizes.append(np.array(list(map(len, singles))))
        self.numbers.update(zip(chain(words, others), count(len(self.numbers)), strict=False))
        self.ids = np.concatenate([self.ids, *found])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(np.concatenate(sizes))])
        self.held = self.ids.nbytes + self.offsets.nbytes + 2 * sum(map(len, new)) + (self.held - self.held_ids)
        self.held_ids = self.ids.nbytes + self.offsets.nbytes


def _gathered(ids: np.ndarray, offsets: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``ids[offsets[n]:offsets[n + 1]]`` of the numbers, end to end, and their lengths."""
    lengths = offsets[numbers + 1] - offsets[numbers]
    first = np.cumsum(lengths) - lengths
    return ids[np.repeat(offsets[numbers] - first, lengths) + np.arange(int(lengths.sum()))], lengths


@lru_cache(maxsize=2)
def _ids_of(path: str) -> BlankFreeIds:
    return BlankFreeIds(path)


def cut_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
    text_col: str = "text", with_ids: bool = False, keep_words: int = CACHE_WORDS,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` (and ``ids``), one narrow pass.

    A document is its token ids and then ``end_id``; it is cut only if longer than
    ``capacity``. Null and empty texts are the end id alone.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    end = np.array([end_id], "<u4").tobytes()
    width = 4 * capacity
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ids_of(tokenizer_path)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for a, b in slices_by_bytes(texts, BATCH_BYTES):
                row, piece, length, crc, held = [], [], [], [], []
                for i, ids in enumerate(encoder.encode_long(texts[a].as_py()) if b - a == 1 else encoder.encode(texts.slice(a, b - a)), a):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), width)):
                        own = ids[at:at + width]
                        row.append(i)
                        piece.append(k)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                        if with_ids:
                            held.append(np.frombuffer(own, "<u4").astype(np.int32))
                columns = [
                    batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array([k * capacity for k in piece], pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(held, pa.list_(pa.int32()))] * with_ids, names=names)
        if encoder.full(keep_words):
            encoder.forget()
        give_back_memory()

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    )


def best_fit(order: np.ndarray, lengths: np.ndarray, bins: np.ndarray, fills: list[int], capacity: int) -> None:
    """Put the pieces of ``order`` one by one into the open bin with the least room that holds them.

    ``bins`` gets each piece's bin and ``fills`` the bins' new fills; new bins are appended.
    Open bins are stacked by their room, and one integer has a bit for each room in use.
    """
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for b, fill in enumerate(fills):
        if room := capacity - fill:
            stacks[room].append(b)
            rooms |= 1 << room
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            stack = stacks[room]
            b = stack.pop()
            if not stack:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[i] = b
        fills[b] += n
        if left := room - n:
            stacks[left].append(b)
            rooms |= 1 << left


def cost(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first; of equal numbers, the one with the less even fills."""
    fills = np.bincount(bins, lengths)
    return len(fills), -float(np.mean((fills / capacity) ** 2))


def first_solutions(lengths: np.ndarray, n: int, capacity: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Best-fit solutions: one in decreasing order, the others in orders disturbed ever more."""
    out = []
    for k in range(n):
        noise = 1 + rng.uniform(-0.15 * k, 0.15 * k, len(lengths)) if k else 1
        bins = np.empty(len(lengths), np.int64)
        best_fit(np.argsort(-lengths * noise, kind="stable"), lengths, bins, [], capacity)
        out.append(bins)
    return out


def cross(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """A child of ``a`` with well-filled bins of ``b``.

    Bins of ``a`` that share a piece with an injected one go, with a few of its emptiest
    bins; what they held beside the injected pieces is best-fitted, longest first.
    """
    fill_b, fill_a = np.bincount(b, lengths), np.bincount(a, lengths)
    good = np.flatnonzero(fill_b >= max(np.median(fill_b), 0.98 * fill_b.max()))
    chosen = np.zeros(len(fill_b), bool)
    chosen[rng.permutation(good)[: max(1, int(len(good) * rng.uniform(0.02, 0.15)))]] = True
    injected = chosen[b]
    gone = np.zeros(len(fill_a), bool)
    gone[a[injected]] = True
    gone[np.argsort(fill_a, kind="stable")[: 1 + len(fill_a) // 50]] = True
    displaced = np.flatnonzero(gone[a] & ~injected)
    kept = np.cumsum(~gone) - 1
    n_kept = int((~gone).sum())
    renumbered = np.cumsum(chosen) - 1 + n_kept
    child = np.where(injected, renumbered[b], kept[a])
    placed = np.ones(len(child), bool)
    placed[displaced] = False
    fills = np.bincount(child[placed], lengths[placed], minlength=n_kept + int(chosen.sum())).astype(np.int64).tolist()
    best_fit(displaced[np.argsort(-lengths[displaced], kind="stable")], lengths, child, fills, capacity)
    return np.unique(child, return_inverse=True)[1]


def evolve(
    lengths: np.ndarray, population: list[np.ndarray], immigrant: np.ndarray | None, generations: int, size: int,
    capacity: int, rng: np.random.Generator,
) -> list[np.ndarray]:
    """The population after some generations, best first; the immigrant takes the worst one's place."""
    if not population:
        population = first_solutions(lengths, size, capacity, rng)
    ranked = sorted(((cost(s, lengths, capacity), k, s) for k, s in enumerate(population)), key=lambda x: x[:2])
    if immigrant is not None:
        ranked = sorted([*ranked[: size - 1], (cost(immigrant, lengths, capacity), -1, immigrant)], key=lambda x: x[:2])
    bound = -(-int(lengths.sum()) // capacity)
    for g in range(generations):
        if ranked[0][0][0] <= bound or len(ranked) < 2:
            break  # no solution has fewer bins
        x, y = sorted(rng.choice(len(ranked), 2, replace=False))
        child = cross(ranked[x][2], ranked[y][2], lengths, capacity, rng)
        score = cost(child, lengths, capacity)
        if score < ranked[-1][0] and all(score != r[0] for r in ranked):
            ranked = sorted([*ranked[: size - 1], (score, size + g, child)], key=lambda x: x[:2])
    return [s for _, _, s in ranked]


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    shard_pieces: int = 8192,
    islands: int = 3,
    population: int = 4,
    epochs: int = 3,
    generations: int = 10,
    seed: int = 11,
    keep_words: int = CACHE_WORDS,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns per piece ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and
    ``ids``). Texts are encoded once, into a stored piece table whose row numbers are the
    keys from there on, so null or repeated ids and repeated rows are packed like any
    other row. Pieces of full length are sequences of their own. The rest are dealt evenly
    into shards of about ``shard_pieces`` pieces, whatever their source or text. Each
    (shard, island) is one row that evolves in a task; epochs are stored tables, joined by
    key for the migration. A shard leaves at most one sequence more than one packing of
    everything would, so the loss is below one in some thousand sequences.

    ``keep_words`` is how many cached words a worker may take from one task to the next;
    where its memory is shared with other stages, 0 empties the cache with each task.

    An empty table gives no rows. Other columns of ``docs`` are not read.
    """

    uid = "piece_uid"
    pieces, _ = stored(
        cut_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, with_ids, keep_words).withColumn(uid, F.monotonically_increasing_id()),
        "pieces",
    )
    short = pieces.where(F.col("length") < capacity)
    shards = max(1, -(-short.count() // shard_pieces))
    dealt = (
        short.groupBy(F.pmod(F.xxhash64(uid), F.lit(shards)).cast("int").alias("shard"))
        .agg(F.sort_array(F.collect_list(F.struct(uid, F.col("length").cast("int").alias("length")))).alias("items"))
        .select("shard", F.col(f"items.{uid}").alias("uids"), F.col("items.length").alias("lengths"))
    )
    dealt, _ = stored(dealt, "shards")
    state = dealt.select("shard", "lengths", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island")).select(
        "shard", "island", "lengths", F.array().cast("array<array<int>>").alias("population"), F.lit(None).cast("array<int>").alias("immigrant")
    )
    schema = "shard int, island int, lengths array<int>, population array<array<int>>"
    for epoch in range(epochs):

        def step(frames: Iterator[pd.DataFrame], epoch: int = epoch) -> Iterator[pd.DataFrame]:
            for frame in frames:
                rows = []
                for r in frame.itertuples(index=False):
                    rng = np.random.default_rng([seed, r.shard, r.island, epoch])
                    known = [np.asarray(s, np.int64) for s in r.population]
                    guest = None if r.immigrant is None else np.asarray(r.immigrant, np.int64)
                    found = evolve(np.asarray(r.lengths, np.int64), known, guest, generations, population, capacity, rng)
                    rows.append((r.shard, r.island, r.lengths, [s.astype(np.int32) for s in found]))
                yield pd.DataFrame(rows, columns=["shard", "island", "lengths", "population"])

        evolved = state.repartition(max(1, min(shards * islands, 20_000)), "shard", "island").mapInPandas(step, schema)
        evolved, _ = stored(evolved, f"epoch{epoch}")
        elite = evolved.select(
            "shard", ((F.col("island") + 1) % islands).alias("island"), F.col("population")[0].alias("immigrant")
        )
        state = evolved.join(elite, ["shard", "island"])

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                found = np.asarray(r.best, np.int64)
                rows.append((r.shard, r.island, found.astype(np.int32), *cost(found, np.asarray(r.lengths, np.int64), capacity)))
            yield pd.DataFrame(rows, columns=["shard", "island", "best", "n_bins", "evenness"])

    best = (
        evolved.select("shard", "island", "lengths", F.col("population")[0].alias("best"))
        .mapInPandas(score, "shard int, island int, best array<int>, n_bins int, evenness double")
        .groupBy("shard")
        .agg(F.min_by("best", F.struct("n_bins", "evenness", "island")).alias("best"))
    )

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                bins, lengths = np.asarray(r.best, np.int64), np.asarray(r.lengths, np.int64)
                order = np.argsort(bins, kind="stable")
                before = np.cumsum(lengths[order]) - lengths[order]
                first = np.concatenate([[True], np.diff(bins[order]) != 0])
                offset = before - before[first][np.cumsum(first) - 1]
                yield pd.DataFrame(
                    {uid: np.asarray(r.uids, np.int64)[order], "sequence_id": (np.int64(r.shard) << 32) + bins[order], "offset": offset}
                )

    placed = dealt.join(best, "shard").mapInPandas(place, f"{uid} long, sequence_id long, offset long")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    return pieces.join(placed, uid, "left").select(
        *columns,
        F.coalesce("sequence_id", -1 - F.col(uid)).alias("sequence_id"),
        F.coalesce("offset", F.lit(0).cast("long")).alias("offset"),
    )
