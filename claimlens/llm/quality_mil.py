"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded as the tanh of the average of its
hashed character n-gram embeddings plus the embedding of its repetition (the binned share of
long grams that are distinct within it); a gated attention (a tanh gate times a sigmoid gate)
weighs the passages; the weighted sum is scored by a logistic unit. Only documents have
labels: the attention learns from them which passages tell.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import stored, text_udf
from .hashing import bags, code_points, gram_buckets, grams_inside, remainder_of_id, runs_of_chars, sampled_rows, segment_sums

GRAMS = (1, 3)
BITS = 13
PASSAGE_CHARS = 400
LONG_GRAM, TABLE_BITS = 6, 12
BINS = 16
ROWS = (1 << BITS) + 1 + BINS + 1  # n-grams, none, bins of the distinct share


@dataclass(frozen=True)
class QualityModel:
    embedding: np.ndarray  # (ROWS, dims); row 2 ** BITS, for grams across texts, is zero
    shift: np.ndarray
    tanh_gate: np.ndarray  # (dims, gates)
    sigmoid_gate: np.ndarray
    attention: np.ndarray  # (gates,)
    weights: np.ndarray  # (dims,)
    bias: float


def passage_offsets(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of the passages, offsets of the documents among the passages).

    A text is cut into passages of equal length, of about PASSAGE_CHARS characters; an
    empty text is one empty passage.
    """
    sizes = np.diff(offsets)
    counts = np.maximum(1, -(-sizes // PASSAGE_CHARS))
    docs = np.concatenate([[0], np.cumsum(counts)])
    within = np.arange(docs[-1]) - np.repeat(docs[:-1], counts)
    starts = np.repeat(offsets[:-1], counts) + within * np.repeat(sizes, counts) // np.repeat(counts, counts)
    return np.append(starts, offsets[-1]), docs


def _grams(points: np.ndarray, offsets: np.ndarray):
    for n in GRAMS:
        buckets = gram_buckets(points, n, BITS)
        buckets[~grams_inside(offsets, n)] = 1 << BITS
        yield buckets


def repetition(points: np.ndarray, offsets: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Embedding row of each passage's share of distinct long grams.

    A gram is distinct if it is the last of its kind in its passage: all positions of a
    passage write to its own table by hash, and the last writer remains. So a passage's
    share does not depend on what is encoded with it.
    """
    of = np.repeat(np.arange(len(cuts) - 1, dtype=np.int64), np.diff(cuts))
    grams = gram_buckets(points, LONG_GRAM, TABLE_BITS)
    m = len(grams)
    key = (of[:m] << TABLE_BITS) | grams
    table = np.empty((len(cuts) - 1) << TABLE_BITS, np.int32)
    at = np.arange(m, dtype=np.int32)
    table[key] = at
    inside = grams_inside(offsets, LONG_GRAM)
    ends = np.minimum(cuts, m)
    count = segment_sums(inside, ends)
    distinct = segment_sums(inside & (table[key] == at), ends)
    share = np.where(count > 0, distinct / np.maximum(count, 1), 1.0)
    return (1 << BITS) + 1 + np.round(share * BINS).astype(np.int64)


def encode_passages(model: QualityModel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(one row per passage, offsets of the documents). A long text is encoded some passages
    at a time, each with the few characters that its last grams reach into the next."""
    if len(texts) == 1 and len(texts[0]) > hashing.SLICE_CHARS:
        text = texts[0]
        cuts, docs = passage_offsets(np.array([0, len(text)]))
        step = max(1, hashing.SLICE_CHARS // PASSAGE_CHARS)
        rows = []
        for a in range(0, len(cuts) - 1, step):
            some = cuts[a:a + step + 1]
            points, offsets = code_points([text[some[0]:some[-1] + LONG_GRAM - 1]])
            rows.append(_encode(model, points, offsets, some - some[0]))
        return np.concatenate(rows), docs
    points, offsets = code_points(texts)
    cuts, docs = passage_offsets(offsets)
    return _encode(model, points, offsets, cuts), docs


def _encode(model: QualityModel, points: np.ndarray, offsets: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    total, count = np.zeros((len(cuts) - 1, model.embedding.shape[1]), np.float32), np.zeros(len(cuts) - 1, np.int64)
    for buckets in _grams(points, offsets):
        at = np.minimum(cuts, len(buckets))
        total += segment_sums(model.embedding[buckets], at)
        count += segment_sums(buckets != 1 << BITS, at)
    total = total / np.maximum(count, 1)[:, None] + model.embedding[repetition(points, offsets, cuts)]
    return np.tanh(total + model.shift)


def _attend(model: QualityModel, hidden: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, ...]:
    a, b = np.tanh(hidden @ model.tanh_gate), 1 / (1 + np.exp(-(hidden @ model.sigmoid_gate)))
    e = (a * b) @ model.attention
    top = np.maximum.reduceat(e, docs[:-1])
    x = np.exp(e - np.repeat(top, np.diff(docs)))
    return a, b, x / np.repeat(np.add.reduceat(x, docs[:-1]), np.diff(docs))


def score_texts(model: QualityModel, texts: list[str]) -> np.ndarray:
    """Score of each whole text: the probability of label 1."""
    out = np.zeros(len(texts))
    for a, b in runs_of_chars(texts, each=PASSAGE_CHARS):
        hidden, docs = encode_passages(model, texts[a:b])
        share = _attend(model, hidden, docs)[2]
        z = np.add.reduceat(share[:, None] * hidden, docs[:-1], axis=0) @ model.weights + model.bias
        out[a:b] = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    return out


def _features(texts: pd.Series, most_passages: int) -> pd.Series:
    out = []
    for text in texts:
        points, offsets = code_points([text])
        cuts, _ = passage_offsets(offsets)
        grams, bins = list(_grams(points, offsets)), repetition(points, offsets, cuts)
        chosen = range(len(cuts) - 1)
        if len(cuts) - 1 > most_passages:
            rng = np.random.default_rng(zlib.crc32(text.encode("utf-8", "surrogatepass")))
            chosen = sorted(rng.choice(len(cuts) - 1, most_passages, replace=False).tolist())
        rows = []
        for k in chosen:
            found = np.concatenate([b[min(cuts[k], len(b)):min(cuts[k + 1], len(b))] for b in grams])
            bucket, count = np.unique(found[found != 1 << BITS], return_counts=True)
            share = np.append(count / max(1, count.sum()), 1.0)
            rows.append({"bucket": np.append(bucket, bins[k]).astype(np.int32), "share": share.astype(np.float32)})
        out.append(rows)
    return pd.Series(out, index=texts.index)


def descend(bags: list[list[tuple[np.ndarray, np.ndarray]]], y: np.ndarray, dims: int, gates: int, epochs: int, rate: float, rng) -> QualityModel:
    """Adagrad on the logistic loss of whole documents, through attention and encoder."""
    scale = 1 / np.sqrt(dims)
    p = {
        "embedding": rng.normal(0, 1.0, (ROWS, dims)).astype(np.float32),
        "shift": np.zeros(dims, np.float32),
        "tanh_gate": rng.normal(0, scale, (dims, gates)).astype(np.float32),
        "sigmoid_gate": rng.normal(0, scale, (dims, gates)).astype(np.float32),
        "attention": rng.normal(0, 0.1, gates).astype(np.float32),
        "weights": np.zeros(dims, np.float32),
        "bias": np.zeros(1, np.float32),
    }
    p["embedding"][1 << BITS] = 0
    memory = {k: np.full(v.shape, 1e-3, np.float32) for k, v in p.items()}

    def move(name: str, gradient: np.ndarray, rows=slice(None)) -> None:
        memory[name][rows] += gradient**2
        p[name][rows] -= rate * gradient / np.sqrt(memory[name][rows])

    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), 16):
            some = order[at:at + 16]
            passages = [x for i in some for x in bags[i]]
            docs = np.concatenate([[0], np.cumsum([len(bags[i]) for i in some])])
            of = np.repeat(np.arange(len(some)), np.diff(docs))
            used = np.unique(np.concatenate([b for b, _ in passages]))
            x = np.zeros((len(passages), len(used)), np.float32)
            for r, (bucket, share) in enumerate(passages):
                x[r, np.searchsorted(used, bucket)] = share
            model = QualityModel(**{**p, "bias": float(p["bias"][0])})
            h = np.tanh(x @ p["embedding"][used] + p["shift"])
            a, b, share = _attend(model, h, docs)
            z = np.add.reduceat(share[:, None] * h, docs[:-1], axis=0)
            d = (1 / (1 + np.exp(-np.clip(z @ p["weights"] + p["bias"], -60, 60))) - y[some]) / len(some)
            dz = d[of][:, None] * p["weights"]
            dh = share[:, None] * dz
            # softmax within the document: de_k = share_k * (dz.h_k - sum_j share_j dz.h_j)
            g = (dz * h).sum(axis=1)
            de = share * (g - np.add.reduceat(share * g, docs[:-1])[of])
            dab = de[:, None] * p["attention"]
            da, db = dab * b * (1 - a**2), dab * a * b * (1 - b)
            dh += da @ p["tanh_gate"].T + db @ p["sigmoid_gate"].T
            du = dh * (1 - h**2)
            move("weights", d @ z)
            move("bias", np.array([d.sum()], np.float32))
            move("attention", (a * b).T @ de)
            move("tanh_gate", h.T @ da)
            move("sigmoid_gate", h.T @ db)
            move("shift", du.sum(axis=0))
            move("embedding", x.T @ du, used)
    return QualityModel(**{**p, "bias": float(p["bias"][0])})


def fit_quality_model(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    per_label: int = 1200, most_passages: int = 12, dims: int = 16, gates: int = 8, epochs: int = 20, rate: float = 0.2, seed: int = 3,
) -> QualityModel | None:
    """Learn from labelled rows where ``learn`` (over ``doc_id``) holds.

    The bounds of the fit: ``per_label`` rows of each label by a seeded hash of the text and
    ``most_passages`` passages of each, whose hashed counts are all that reaches the driver.
    A document with several labels counts only if they agree; labels other than 0 and 1,
    null ids and null texts teach nothing. Without both labels there is no model.
    """
    agreed = (
        labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(learn)
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other").select("doc_id", "label")
    )
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null")
    # which labelled rows are drawn is decided on ids, so only the drawn rows' texts move
    there = agreed.join(texts.select("doc_id"), "doc_id", "left_semi").withColumn("key", F.col("doc_id").cast("string"))
    drawn, _ = stored(sampled_rows(there, per_label, 2 * per_label, seed).select("doc_id", "label"), "drawn")

    @F.pandas_udf("array<struct<bucket:array<int>,share:array<float>>>")
    def features(column):
        return _features(column, most_passages)

    # at most 2 * per_label narrow rows are sent to the texts; rows that repeat an id teach once
    labelled = texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = labelled.orderBy("doc_id").select("label", features("text").alias("x")).toArrow()
    y = rows.column("label").to_numpy()
    if len(set(y.tolist())) < 2:
        return None
    return descend(bags(rows.column("x")), y.astype(np.float32), dims, gates, epochs, rate, np.random.default_rng(seed))


def quality_column(model: QualityModel | None, text: Column) -> Column:
    """Score of each whole text; without a model 0.5."""

    def run(texts: list[str | None]) -> pa.Array:
        if model is None:
            return pa.array(np.full(len(texts), 0.5))
        return pa.array(score_texts(model, [t or "" for t in texts]))

    return text_udf(run, "double")(text.cast("string"))


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", modulus: int = 3,
    held_out: int = 1, **fit,
) -> DataFrame:
    """``doc_id, held_out, score, predicted``: one row per row of ``docs``; scoring has no shuffle.

    Learned from labels whose crc32(id as text) mod ``modulus`` is not ``held_out``; rows
    without an id are scored and never learned from (``held_out`` is false). Whole texts are
    scored, in slices of bounded size; a null text scores like an empty one (one empty
    passage). Repeated rows score alike. Without labels of both kinds every score is 0.5. Other
    columns are not read. An empty table gives no rows.
    """
    rest = remainder_of_id(F.col("doc_id"), modulus)
    model = fit_quality_model(docs, labels, rest != held_out, id_col, text_col, label_col, **fit)
    scored = docs.select(F.col(f"`{id_col}`").alias("doc_id"), quality_column(model, F.col(f"`{text_col}`")).alias("score"))
    return scored.select(
        "doc_id", F.coalesce(rest == held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
