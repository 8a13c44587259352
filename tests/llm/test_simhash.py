import random

import numpy as np
import pytest
import xxhash

from claimlens.llm.graph import connected_components
from claimlens.llm.simhash import ball_links, fingerprint, keep_one_per_group, near_duplicates


def plain_fingerprint(text, k=4):
    words, word = [], ""
    for ch in (text or "") + " ":
        if ch in " \t\n\v\f\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def components(items, linked):
    parent = {i: i for i in items}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in items:
        for b in items:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in items}


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "a b c", "A b C d", "É À b\x0bc\x1cd ß e f", "x " * 70_000])
def test_fingerprint_of_edge_texts(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_long_texts_are_read_in_segments(monkeypatch):
    from claimlens.llm import simhash

    rng = random.Random(5)
    texts = [" ".join(rng.choice(["a", "Bb", "ccc", "é"]) + rng.choice(["", "\n", "  "]) for _ in range(n)) for n in (1, 3, 4, 5, 40, 400)]
    for size in (1, 7, 50):
        monkeypatch.setattr(simhash, "SEGMENT_BYTES", size)
        assert [fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_components_match_brute_force(spark):
    rng = random.Random(3)
    prints = {0, 1, 2**64 - 1}
    for _ in range(40):
        at = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 8])):
            prints.add(at)
            for bit in rng.sample(range(64), rng.randint(1, 6)):
                at ^= 1 << bit
    prints = sorted(prints)
    fps = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    truth = components(range(len(prints)), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 4)
    # one bucket, several, buckets walked in slices, and buckets sent on (once, again and again)
    for limit, most in ((1 << 21, 1 << 20), (5_000, 1 << 20), (60, 1 << 20), (1 << 21, 60), (5_000, 20)):
        links = ball_links(fps, 4, limit, most)
        got = {r.node: r.root for r in connected_components(links).collect()}
        at = {int(np.uint64(p).astype(np.int64)): i for i, p in enumerate(prints)}
        groups = {}
        for i in range(len(prints)):
            groups.setdefault(truth[i], set()).add(i)
        found = {}
        for fp, i in at.items():
            found.setdefault(got.get(fp, fp), set()).add(i)
        assert sorted(map(sorted, found.values())) == sorted(map(sorted, groups.values()))


def cluster(size, flips, seed):
    """Distinct fingerprints, each ``flips`` bits off one centre."""
    rng = random.Random(seed)
    centre, out = rng.getrandbits(64), set()
    while len(out) < size:
        out.add(centre ^ sum(1 << i for i in rng.sample(range(64), flips)))
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize("flips", [2, 3, 7])
def test_slices_hold_each_variant_once_within_the_limit(flips):
    from claimlens.llm.simhash import _masks, _slices

    fps, limit, seen = cluster(150, flips, 8), 2_000, []
    start = (np.arange(len(fps)), fps, np.zeros(len(fps), np.int64), list(range(64)))
    for at, base, spent, free in _slices(*start, 2, limit, lambda some: False):
        masks, part = _masks(free, 2), []
        for i, value, used in zip(at.tolist(), base.tolist(), spent.tolist(), strict=True):
            part += [(i, value ^ m) for group in masks[: 3 - used] for m in group.tolist()]
        assert len(part) <= limit
        seen += part
    assert len(seen) == len(set(seen))
    met = {}
    for i, f in enumerate(fps.tolist()):
        for m in np.concatenate(_masks(list(range(64)), 2)).tolist():
            met.setdefault(f ^ m, set()).add(i)
    # parts with one member hold nothing to meet and are left out; every variant that two share is there
    assert {(i, v) for v, who in met.items() if len(who) > 1 for i in who} <= set(seen)


@pytest.mark.parametrize(("size", "flips"), [(30_000, 3), (100_000, 4)])
def test_tight_cluster_above_the_limit(size, flips):
    from claimlens.llm.simhash import _star_links

    fps = cluster(size, flips, 9)
    u, v = _star_links(fps, 0, 0, 2, 1 << 19)
    assert len(u) == size - 1 and set(v.tolist()) == {int(fps[0])}  # all of them are one component


DOCS = "doc_id long, text string, fp string, row_no int"


def rows():
    base = " ".join(f"w{i}" for i in range(300))
    near = base.replace("w7 ", "v7 ")
    return [(5, base, "a", 1), (3, near, "b", 1), (9, base, None, None), (9, base, None, None), (None, base, "c", 2),
            (7, None, "d", 1), (8, "", "e", 1), (6, "quite another text of six words", "f", 1), (None, "lone text here now", "g", 3)]


def test_documents(spark):
    got = near_duplicates(spark.createDataFrame(rows(), DOCS)).collect()
    texts = [(r[0], plain_fingerprint(r[1])) for r in rows()]
    truth = components(range(len(texts)), lambda a, b: bin(texts[a][1] ^ texts[b][1]).count("1") <= 4)
    want = []
    for i, (doc, fp) in enumerate(texts):
        ids = [texts[j][0] for j in truth if truth[j] == truth[i] and texts[j][0] is not None]
        want.append((doc, f"{fp:016x}", min(ids, default=None)))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_one_document_of_each_group_stays(spark):
    docs = spark.createDataFrame(rows(), DOCS)
    kept = keep_one_per_group(docs)
    assert kept.columns == docs.columns
    classes = {r.component_id for r in near_duplicates(docs).collect()}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(classes, key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert near_duplicates(docs).collect() == [] and keep_one_per_group(docs).collect() == []


def test_components_of_long_path_and_hub(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    hub = [(1, i) for i in range(500, 900)]
    edges = spark.createDataFrame([*path, *hub, (7, 7), (None, 4)], "u long, v long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 1 for i in range(500, 900)) and 7 not in got
