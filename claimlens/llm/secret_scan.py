"""Secret scan: base patterns, and incompressible strings in sensitive contexts.

For a candidate next to a sensitive word, zstandard measures what it adds: the compressed
size of the surrounding code with the candidate less the size without it, with a dictionary
of identifiers primed. Names, paths and prose repeat the dictionary or their surroundings
and add few bytes; a key adds about as many bytes as it has characters. Other copies of the
candidate and all other candidates are taken out of its surroundings first: a key that is repeated is found at
each place, and one in a list of keys is not measured against their alphabet.
Every candidate is measured; one without a digit or without a letter must add more, as words and
plain numbers look like it.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_udf

# Fixed values of the base scan, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LONG_HEX = re.compile(r"[0-9a-f]{16,}")  # a match of [0-9a-f]+ is a maximal run, so the long ones can be asked for
ASSIGN_CHARS, ACCESS_CHARS = 12, 18
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "novel")

# A sensitive word, whatever joins it to a value, and a value of 12 or more characters.
CANDIDATE = re.compile(
    r"""(?ai:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key|bearer|signature)"""
    r"""[A-Za-z0-9_\]-]{0,24}["']?\s{0,4}(?::=|=>|[:=(,]|\s)\s{0,4}["'(]?([A-Za-z0-9+/_.=~!@#$%^&*-]{12,})"""
)
PIECE = re.compile(r"[A-Za-z0-9_-]{12,}")
CONTEXT_CHARS = 256
LEAST_NOVELTY = 0.7  # bytes a character that a candidate must add
PLAIN_NOVELTY = 0.9  # the same for one without a digit or without a letter, as words and numbers are
# Identifiers and values that stand beside keys in code and configuration.
IDENTIFIERS = (
    "password passwd passphrase secret token api_key apikey access_key secret_access_key client_secret private_key "
    "authorization bearer credentials username account connection string endpoint region bucket session signature "
    "https://www.example.com/ http://localhost:8080/ localhost 127.0.0.1 config settings environment production "
    "development default placeholder changeme your_api_key_here REPLACE_ME TODO None null true false undefined "
    "os.environ.get process.env getenv System.getProperty import from return const let var def class function self "
    "public static final String private void new this get set request response headers Content-Type application/json "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 1234567890 xxxxxxxxxxxxxxxx ****************"
)


@lru_cache(maxsize=1)
def _compressor():
    import zstandard

    primed = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=9, dict_data=primed, write_checksum=False, write_content_size=False)


def added_bytes(before: str, value: str, after: str) -> int:
    """Compressed bytes that ``value`` adds to its surroundings."""
    size = lambda s: len(_compressor().compress(s.encode("utf-8", "replace")))
    return size(before + value + after) - size(before + after)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base matches; failing matches are found, then dropped."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    return out + [(m.start(), m.end(), "hex") for m in LONG_HEX.finditer(text)]


def _without(text: str, start: int, end: int, gone: list[tuple[int, int]]) -> str:
    """``text[start:end]`` without the characters of ``gone``."""
    kept = bytearray(b"\1" * (end - start))
    for a, b in gone:
        a, b = max(a, start) - start, min(b, end) - start
        if a < b:
            kept[a:b] = bytes(b - a)
    return "".join(c for c, k in zip(text[start:end], kept, strict=True) if k)


def _copies(text: str, value: str, low: int, high: int) -> Iterator[tuple[int, int]]:
    """Where ``value`` stands in ``text[low:high]``, without overlaps."""
    at = text.find(value, low, high)
    while at >= 0:
        yield at, at + len(value)
        at = text.find(value, at + len(value), high)


def surroundings(text: str, start: int, end: int, others: Iterable[tuple[int, int]] = ()) -> tuple[str, str]:
    """What stands before and after a value, without its other occurrences and without ``others``.

    A key that stands twice would only repeat its copy, and one beside other keys would be written in
    the letters that they have taught the compressor: both would look like nothing new. Other ends may be joined to a
    copy, so long pieces of the value between punctuation are taken out as well.
    """
    pieces = dict.fromkeys([text[start:end], *PIECE.findall(text, start, end)])
    low, high = max(0, start - CONTEXT_CHARS), min(len(text), end + CONTEXT_CHARS)
    gone = [*others]
    for piece in pieces:
        gone += _copies(text, piece, max(0, low - len(piece) + 1), start)
        gone += _copies(text, piece, end, min(len(text), high + len(piece) - 1))
    return _without(text, low, start, gone), _without(text, end, high, gone)


def _union(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans as disjoint ones in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _meeting(spans: list[tuple[int, int]], starts: list[int], start: int, end: int) -> list[tuple[int, int]]:
    """Of disjoint spans in order, those that meet ``start`` to ``end``."""
    first = max(0, bisect_right(starts, start) - 1)
    return [s for s in spans[first:bisect_left(starts, end)] if s[1] > start]


def novel_spans(text: str, known: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Candidates that known spans do not cover wholly and that add at least LEAST_NOVELTY bytes a
    character (PLAIN_NOVELTY without a digit or a letter), as a whole or by what known spans leave of them.

    Other candidates and known spans do not count as surroundings; for a candidate without a digit or
    a letter only those that have both are left out, as names in a list tell each other's alphabet. Each candidate
    looks only at what stands within its surroundings, so the time follows the length of the text.
    """
    found = [m.span(1) for m in CANDIDATE.finditer(text)]
    covered = _union((a, b) for a, b, _ in known)
    covered_at = [a for a, _ in covered]
    mixed = lambda a, b: bool(re.search(r"\d", text[a:b]) and re.search(r"[A-Za-z]", text[a:b]))
    values, keys = _union([*found, *covered]), _union([*(s for s in found if mixed(*s)), *covered])
    values_at, keys_at = [a for a, _ in values], [a for a, _ in keys]
    out = []
    for a, b in found:
        value = text[a:b]
        own = bytearray(b"\1" * len(value))
        for s, e in _meeting(covered, covered_at, a, b):
            own[max(s - a, 0):max(0, e - a)] = bytes(min(e, b) - max(s, a))
        rest = "".join(c for c, k in zip(value, own, strict=True) if k)
        if not rest:
            continue
        least, others, at = (LEAST_NOVELTY, values, values_at) if mixed(a, b) else (PLAIN_NOVELTY, keys, keys_at)
        before, after = surroundings(text, a, b, _meeting(others, at, a - CONTEXT_CHARS, b + CONTEXT_CHARS))
        if any(added_bytes(before, v, after) >= least * len(v) for v in dict.fromkeys([value, rest])):
            out.append((a, b, "novel"))
    return out


def find_spans(text: str | None) -> list[tuple[int, int, str]]:
    """All spans of a text in code points, end exclusive, by start and then kind as listed."""
    text = text or ""
    base = base_spans(text)
    return sorted(base + novel_spans(text, base), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def redact_text(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span (overlapping ones as one) replaced by ``mark``."""
    spans = find_spans(text)
    if not spans:
        return text
    parts, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def spans_column(text: Column) -> Column:
    """:func:`find_spans` as ``array<struct<kind, start, end>>``."""

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(texts: list[str | None]) -> pa.Array:
        return pa.array([[{"kind": k, "start": a, "end": b} for a, b, k in find_spans(t)] for t in texts], kind)

    return text_udf(run, "array<struct<kind:string,start:int,end:int>>")(text)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, found``: the spans of every whole text, one row per row of ``docs``, no shuffle.

    A null text is scanned as an empty one: no spans. Spans of one kind never overlap; a "novel"
    span may overlap base spans that hold a part of its value, but none covers it. Repeated rows and null ids stay as they are; other
    columns are not read. An empty table gives no rows.
    """
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), spans_column(F.col(f"`{text_col}`").cast("string")).alias("found"))


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with the spans of each text replaced by ``mark`` and the length column, if any,
    brought up to date. A null text stays null; every row stays."""

    def run(texts: list[str | None]) -> pa.Array:
        return pa.array([redact_text(t, mark) for t in texts], pa.string())

    redacted = text_udf(run, "string")(F.col(f"`{text_col}`").cast("string"))
    out = docs.withColumn(text_col, redacted)
    if length_col and length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.when(F.col(f"`{text_col}`").isNull(), F.col(f"`{length_col}`")).otherwise(F.length(f"`{text_col}`").cast(kind)))
    return out
