import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from claimlens.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, P1 string"


def rebuild(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [t[2:] for t in sorted(own)] for c, own in turns.items()}
    out = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = original.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])
        out[c] = base[:h] + own[h:]
    return out


def plain(rows):
    """Every node by its own path, with loops over all pairs of nodes."""
    rebuilt = rebuild(rows)
    members = {}
    for c, own in rebuilt.items():
        for d in range(len(own) + 1):
            members.setdefault(tuple(own[:d]), []).append(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in members)]
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)
    conv = F.col("conv_id")
    found = trie.prefix_trie(df, conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4)
    return sorted(map(tuple, found.collect()), key=str)


def some_rows(convs, seed, words=3):
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(["user", "assistant"]), " ".join(rng.choice(["a", "b"]) for _ in range(rng.randrange(words))))
        for c in rng.sample(range(-45, 300), convs) for t in range(rng.randrange(1, 7))
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_plain_trie(spark, seed):
    rows = some_rows(60, seed)
    assert run(spark, rows) == plain(rows)


def test_copies_odd_rows_and_turnless(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(100, 160) for t in range(4)]  # a large group of copies
    rows += [(7, None, None, None), (7, 3, "user", "x"), (7, 3, "user", "x"), (7, 1, None, "y  z\t w"), (None, 0, "user", "lost")]
    rows += [(c, 0, "user", "short") for c in (25, 27, 31, 33)]  # bases are absent: turnless where one or more turns are borrowed
    rows += [(40, 0, "a", "b"), (41, 0, "ab", ""), (42, 0, "", "ab"), (60, 0, "user", "w " * 500_000)]
    got = run(spark, rows)
    assert got == plain(rows) and any(not own for own in rebuild(rows).values())


def test_empty_and_only_turnless(spark):
    assert run(spark, []) == [] == plain([])
    rows = [(c, 0, "user", "x") for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4]
    assert run(spark, rows) == plain(rows) and len(run(spark, rows)) == 1


def test_long_conversations_are_summed_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 8)
    rng = random.Random(5)
    rows = [(c, t, "user", rng.choice("ab") if t > 30 else "a") for c in (0, 20, 40, 80) for t in range(60 + c)]
    rows += [(c, t, "user", "a") for c in (100, 120) for t in range(45)]
    assert run(spark, rows) == plain(rows)
    window = trie.running(spark.range(100).select(F.lit(1).alias("k"), F.col("id").alias("pos"), F.lit(1).alias("n")), ["k"], "pos", {"s": ("sum", "n")})
    assert [r.s for r in window.orderBy("pos").collect()] == list(range(1, 101))


def test_ties_by_role_and_text(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "z"), (2, None, "user", "q"), (2, 0, "user", "p")]
    assert run(spark, rows) == plain(rows)
