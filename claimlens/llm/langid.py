"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the average of the embeddings of its subwords: the 2-, 3- and 4-grams of letters,
word edges included, hashed into buckets. The embeddings and the softmax are learned by
stochastic gradient descent in numpy from a bounded sample of labelled rows. As the
softmax's logits are linear in the average, scoring needs only each bucket's logits:
one table that every task gets. The temperature, and a rejection threshold for each class of
text length (a few words can't be as sure as a page), are calibrated on rows of the sample
that were left out of the descent.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import fresh, text_udf
from .hashing import bags, code_points, gram_buckets, remainder_of_id, runs_of_chars, sampled_rows, segment_sums, words_of

GRAMS = (2, 3, 4)
BITS = 15
UNKNOWN = "und"
LENGTHS = (32, 128, 512)  # subwords at which the next class of text length begins
LEAST_WINDOWS = 50  # a class with fewer is calibrated on all windows
MOST_ODDS = 1.0  # log odds that are never rejected: a confidence of 0.73
_GAP = re.compile(r"[\W\d_]")


@dataclass(frozen=True)
class LanguageModel:
    labels: tuple[str, ...]
    logits: np.ndarray  # (2 ** BITS + 1, labels): of each bucket, the last row is zero
    bias: np.ndarray
    temperature: float
    threshold: tuple[float, ...]  # of each class of length: a lower confidence is rejected


def _subwords(texts: list[str]):
    """Per gram size: (buckets, with 2 ** BITS for grams across word edges; offsets of the texts)."""
    points, offsets = code_points([f" {t.lower()} " for t in texts])
    points, offsets, gap = words_of(points, offsets)
    for n in GRAMS:
        buckets = gram_buckets(points, n, BITS)
        m = len(buckets)
        inner = gap[:m] & gap[1:m + 1] if n == 2 else np.logical_or.reduce([gap[k:m + k] for k in range(1, n - 1)])
        buckets[inner] = 1 << BITS
        yield buckets, np.minimum(offsets, m)


def parts_of(text: str, limit: int) -> list[str]:
    """A long text in parts cut where a word has ended, so the parts have its subwords (a single
    word longer than ``limit`` is read in pieces)."""
    parts, at = [], 0
    while len(text) - at > limit:
        gap = _GAP.search(text, at + limit, at + 2 * limit)
        end = gap.start() if gap else at + limit
        parts.append(text[at:end])
        at = end
    return [*parts, text[at:]]


def score_texts(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """(label, confidence) of each whole text; ``und`` and 0 where there is no letter."""
    return _scored(model, texts)[:2]


def rejections(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """:func:`score_texts`, and whether the confidence is below that of the text's class of length."""
    labels, scores, subwords = _scored(model, texts)
    least = np.array(model.threshold or (0.0,) * (len(LENGTHS) + 1))[np.searchsorted(LENGTHS, subwords, side="right")]
    return labels, scores, (np.array(labels, object) == UNKNOWN) | (scores < least)


def _scored(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(label, confidence, number of subwords) of each whole text."""
    labels, scores, subwords = [], np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    for a, b in runs_of_chars([t or "" for t in texts]):
        part = [t or "" for t in texts[a:b]]
        total, count = np.zeros((b - a, len(model.labels)), np.float32), np.zeros(b - a, np.int64)
        # a run is one long text, or texts that are short together
        for some in [[p] for p in parts_of(part[0], hashing.SLICE_CHARS)] if b - a == 1 else [part]:
            for buckets, offsets in _subwords(some):
                total += segment_sums(model.logits[buckets], offsets)
                count += segment_sums(buckets != 1 << BITS, offsets)
        subwords[a:b] = count
        if not model.labels:
            labels += [UNKNOWN] * (b - a)
            continue
        z = (total / np.maximum(count, 1)[:, None] + model.bias) / model.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        known = count > 0  # a gram needs a letter
        labels += [model.labels[i] if k else UNKNOWN for i, k in zip(best, known, strict=True)]
        scores[a:b] = np.where(known, p[np.arange(b - a), best], 0.0)
    return labels, scores, subwords


def training_windows(text: str, window_chars: int) -> list[str]:
    """A window of the text, at a place its hash chooses, and a short one of 1 to 12 words of it."""
    seed = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    at = seed % max(1, len(text) - window_chars + 1)
    window = text[at:at + window_chars]
    words = window.split()
    n = 1 + seed % 12
    first = (seed >> 8) % max(1, len(words) - n + 1)
    return [window, " ".join(words[first:first + n])]


def _features(texts: pd.Series, window_chars: int) -> pd.Series:
    out = []
    for text in texts:
        rows = []
        for window in training_windows(text, window_chars):
            found = np.concatenate([b for b, _ in _subwords([window])])
            bucket, count = np.unique(found[found != 1 << BITS], return_counts=True)
            rows.append({"bucket": bucket.astype(np.int32), "share": (count / max(1, count.sum())).astype(np.float32), "subwords": int(count.sum())})
        out.append(rows)
    return pd.Series(out, index=texts.index)


def _subword_counts(column: pa.ChunkedArray) -> list[np.ndarray]:
    """Per row, the number of subwords of each of its windows."""
    out = []
    for chunk in column.chunks:
        offsets, counts = np.asarray(chunk.offsets), np.asarray(chunk.values.field("subwords"))
        out += [counts[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return out


def _thresholds(confidence: np.ndarray, subwords: np.ndarray, false_rejects: float) -> tuple[float, ...]:
    """Per class of length: half the log odds that all but ``false_rejects`` of its windows reach, at most
    ``MOST_ODDS`` (log odds below zero are taken as they are)."""
    p = np.clip(confidence.astype(np.float64), 1e-9, 1 - 1e-9)
    odds, group, out = np.log(p / (1 - p)), np.searchsorted(LENGTHS, subwords, side="right"), []
    for g in range(len(LENGTHS) + 1):
        own = odds[group == g] if (group == g).sum() >= LEAST_WINDOWS else odds
        low = float(np.quantile(own, false_rejects))
        out.append(1 / (1 + float(np.exp(-min(MOST_ODDS, low, low / 2)))))
    return tuple(out)


def _descend(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, dims: int, epochs: int, rate: float, rng) -> tuple:
    """SGD over the average embedding and the softmax; batches are dense, so every step is a few products."""
    embedding = rng.uniform(-1 / dims, 1 / dims, ((1 << BITS) + 1, dims)).astype(np.float32)
    embedding[-1] = 0
    weights, bias = np.zeros((dims, classes), np.float32), np.zeros(classes, np.float32)
    steps, step = max(1, epochs * -(-len(x) // 32)), 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), 32):
            rows = order[at:at + 32]
            used = np.unique(np.concatenate([x[i][0] for i in rows]))
            dense = np.zeros((len(rows), len(used)), np.float32)
            for r, i in enumerate(rows):
                dense[r, np.searchsorted(used, x[i][0])] = x[i][1]
            table = embedding[used]
            hidden = dense @ table
            z = hidden @ weights + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            lr = rate * (1 - step / steps)
            step += 1
            embedding[used] = table - lr * (dense.T @ (p @ weights.T))
            weights -= lr * (hidden.T @ p) / len(rows) * 4
            bias -= lr * p.mean(axis=0) * 0.1
    return embedding, weights, bias


def fit_language_model(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_label: int = 500, most: int = 4000,
    window_chars: int = 2048, dims: int = 16, epochs: int = 10, rate: float = 2.0, false_rejects: float = 0.0005, seed: int = 5,
) -> LanguageModel:
    """Learn from rows where ``learn`` holds, with a label and a letter in the text.

    The bounds of the fit: ``per_label`` rows a label, ``most`` rows in all, and windows of
    ``window_chars`` characters of each (and a short one, as texts may be a few words long),
    whose hashed counts are all that reaches the driver. A fifth of the rows calibrates the
    temperature and the thresholds, which reject at most ``false_rejects`` of them.
    Without labelled rows the model knows no language.
    """
    text, label = F.col(f"`{text_col}`").cast("string"), F.col(f"`{label_col}`").cast("string")
    key = F.concat_ws("|", F.col(f"`{id_col}`").cast("string"), F.md5(text))  # the draw's, never the model's
    labelled = docs.where(learn & label.isNotNull() & text.rlike(r"\p{L}")).select(label.alias("label"), text.alias("text"), key.alias("key"))

    @F.pandas_udf("array<struct<bucket:array<int>,share:array<float>,subwords:int>>")
    def features(texts):
        return _features(texts, window_chars)

    drawn = sampled_rows(labelled, per_label, most, seed)
    rows = drawn.select("label", F.pmod(F.col("at"), F.lit(5)).alias("part"), features("text").alias("x")).toArrow()
    names, parts = rows.column("label").to_pylist(), rows.column("part").to_pylist()
    labels = tuple(sorted(set(names)))
    if not labels:
        return LanguageModel((), np.zeros(((1 << BITS) + 1, 0), np.float32), np.zeros(0, np.float32), 1.0, ())
    x, y, held, subwords = [], [], [], []
    for name, part, windows, counts in zip(names, parts, bags(rows.column("x")), _subword_counts(rows.column("x")), strict=True):
        for window, count in zip(windows, counts, strict=True):
            if len(window[0]):
                x.append(window)
                subwords.append(count)
                y.append(labels.index(name))
                held.append(part == 0)
    y, held = np.array(y), np.array(held)
    if held.all() or not held.any():
        held[:] = False
    train = np.flatnonzero(~held)
    embedding, weights, bias = _descend([x[i] for i in train], y[train], len(labels), dims, epochs, rate, np.random.default_rng(seed))
    logits = (embedding @ weights).astype(np.float32)
    calibrate = np.flatnonzero(held) if held.any() else train
    z = np.array([x[i][1] @ logits[x[i][0]] for i in calibrate]) + bias
    temperature = min((0.25 * 1.15**k for k in range(30)), key=lambda t: _log_loss(z / t, y[calibrate]))
    p = np.exp(z / temperature - (z / temperature).max(axis=1, keepdims=True))
    confidence = p.max(axis=1) / p.sum(axis=1)
    return LanguageModel(labels, logits, bias, temperature, _thresholds(confidence, np.array(subwords)[calibrate], false_rejects))


def _log_loss(z: np.ndarray, y: np.ndarray) -> float:
    top = z.max(axis=1)
    return float(np.mean(np.log(np.exp(z - top[:, None]).sum(axis=1)) + top - z[np.arange(len(y)), y]))


def language_column(model: LanguageModel, text: Column) -> Column:
    """``struct<lang_pred, score, rejected>`` of each whole text."""

    def run(texts: list[str | None]) -> pa.Array:
        labels, scores, rejected = rejections(model, texts)
        columns = [pa.array(labels, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
        return pa.StructArray.from_arrays(columns, names=["lang_pred", "score", "rejected"])

    return text_udf(run, "lang_pred string, score double, rejected boolean")(text.cast("string"))


def identify_language(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", modulus: int = 4, held_out: int = 2, **fit
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected``: one row per row of ``docs``, no shuffle.

    Learned from labelled rows whose crc32(id as text) mod ``modulus`` is not ``held_out``; rows
    without an id are scored and never learned from (``held_out`` is false). Whole texts are scored, in
    slices of bounded size. A text that is null, empty or without a letter is ``und`` with score
    0 and rejected. Rejected texts keep their likeliest label. Other columns are not
    read. An empty table gives no rows.
    """
    rest = remainder_of_id(F.col(f"`{id_col}`"), modulus)
    model = fit_language_model(docs, rest != held_out, id_col, text_col, label_col, **fit)
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(rest == held_out, F.lit(False)).alias("held_out"),
        language_column(model, F.col(f"`{text_col}`")).alias("found"),
    ).select("doc_id", "held_out", "found.lang_pred", "found.score", "found.rejected")


def keep_identified(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", modulus: int = 4, held_out: int = 2, **fit
) -> DataFrame:
    """The rows of ``docs``, all columns, whose language the model does not reject."""
    model = fit_language_model(docs, remainder_of_id(F.col(f"`{id_col}`"), modulus) != held_out, id_col, text_col, label_col, **fit)
    found = fresh(docs, "language_found")
    marked = docs.withColumn(found, language_column(model, F.col(f"`{text_col}`")))
    return marked.where(~F.col(f"{found}.rejected")).select(*[F.col(f"`{c}`") for c in docs.columns])
