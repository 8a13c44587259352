"""Token counts: lengths only, from batches balanced by bytes, long texts split where it is safe."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boundaries import ANY, boundary_of, cut
from .common import fresh, give_back_memory, slices_by_bytes

BATCH_BYTES = 1 << 20
SPLIT_CHARS = 1 << 16


@lru_cache(maxsize=4)
def load_encoder(path: str):
    """``texts -> lengths`` for a tokenizer file, once per worker process.

    ``.json`` files are read by ``tokenizers`` (special strings inside texts handled as its
    default), ``.model`` files by ``sentencepiece``; neither adds begin or end tokens.
    """
    if path.endswith(".json"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already runs a task per core
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        return lambda texts: [len(e) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in sp.encode(texts, num_threads=1)]


def split_safely(text: str, limit: int | None = None, boundary: re.Pattern = ANY) -> list[str]:
    """Cut ``text`` after about every ``limit`` characters, at safe boundaries only.

    Joined again the parts are the text. A stretch without any boundary (one endless pre-token) stays
    whole: its merges depend on all of it.
    """
    return cut(text, limit or SPLIT_CHARS, boundary)


def count_texts(texts: list[str], path: str, split: bool = True) -> list[int]:
    """Token count of each text; parts of long texts are encoded with others, about
    BATCH_BYTES characters in one call however long a text is."""
    encode, boundary = load_encoder(path), boundary_of(path) if split else ANY
    counts, parts, owner, held = [0] * len(texts), [], [], 0

    def flush() -> None:
        for i, n in zip(owner, encode(parts), strict=True):
            counts[i] += n

    for i, text in enumerate(texts):
        for part in split_safely(text, None, boundary) if split else [text]:
            if parts and held + len(part) > BATCH_BYTES:
                flush()
                parts, owner, held = [], [], 0
            parts.append(part)
            owner.append(i)
            held += len(part)
    flush()
    return counts


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    text_col: str = "text",
    limit: int = 1024,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """All columns of ``docs`` but the text, with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    One narrow pass (no shuffle). Arrow batches are cut into runs of about
    ``batch_bytes`` bytes, so a few long texts never meet in one encoding call; texts
    above ``SPLIT_CHARS`` are encoded in parts cut at safe boundaries. SentencePiece
    files encode each text whole (their pieces may span blanks).

    A null or empty text counts 0 bytes and 0 tokens. Repeated rows are counted one by
    one. Columns named like a result are replaced by it. An empty table gives no rows.
    """
    results = ("n_bytes", "n_tokens", "over_limit")
    kept = [c for c in docs.columns if c.lower() not in results and c != text_col]
    text = fresh(docs, "text_to_count")
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").cast("string").alias(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    schema = f"{fields}{', ' if fields else ''}n_bytes long, n_tokens long, over_limit boolean"
    split = tokenizer_path.endswith(".json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(len(kept)), "")
            for a, b in slices_by_bytes(texts, batch_bytes):
                part = texts.slice(a, b - a)
                n = pa.array(count_texts(part.to_pylist(), tokenizer_path, split), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(a, b - a) for i in range(len(kept))]
                    + [pc.cast(pc.binary_length(part), pa.int64()), n, pc.greater(n, limit)],
                    names=[*kept, *results],
                )
        give_back_memory()

    return source.mapInArrow(run, schema)
