import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from claimlens.llm.mixing import mix_sources, repeat_copies

DOCS = "doc_id long, text string, lang string, source string, copies string, level_domain int"
WEIGHTS = {"domain": {"a": 3, "b": 1}, "lang": {"en": 2}, "source": {"a1": 5}}


def levels():
    return {"domain": F.substring("source", 1, 1), "lang": F.col("lang"), "source": F.col("source")}


def fill(children, given):
    """{name: (weight, supply)} -> budgets, one used-up child at a time."""
    budgets, left, open_ = {}, given, dict(children)
    while open_:
        total = sum(w for w, _ in open_.values())
        full = [n for n, (w, s) in open_.items() if s * total <= left * w]
        if not full:
            break
        n = min(full, key=lambda n: (open_[n][1] / open_[n][0], n))
        budgets[n] = open_.pop(n)[1]
        left -= budgets[n]
    total = sum(w for w, _ in open_.values())
    return budgets | {n: left * w // total for n, (w, _) in open_.items()}


def brute(rows, percent, epochs, seed=17, domain=lambda s: s[0] if s else "(none)"):
    docs = []
    for i, text, lang, source, *_ in rows:
        words = len(re.findall(r"[^ \t-\r]+", text or ""))
        leaf = (domain(source), lang or "(none)", source or "(none)")
        ident = f"{'(none)' if i is None else i}|{hashlib.md5((text or '').encode()).hexdigest()}"
        docs.append((leaf, words, ident))
    supply = defaultdict(int)
    for leaf, words, _ in docs:
        supply[leaf] += words
    total = sum(supply.values())
    budgets = {(): min(total * percent // 100, total * epochs)}
    for depth, level in enumerate(("domain", "lang", "source")):
        below = {}
        for parent, given in budgets.items():
            children = defaultdict(int)
            for leaf, s in supply.items():
                if leaf[:depth] == parent:
                    children[leaf[depth]] += s * epochs
            shares = fill({n: (WEIGHTS[level].get(n, 1), s) for n, s in children.items()}, given)
            below |= {(*parent, n): b for n, b in shares.items()}
        budgets = below
    taken = []
    for leaf, s in supply.items():
        if not s:
            continue
        whole, rest = divmod(budgets[leaf], s)
        own = [(hashlib.md5(f"{seed}|{whole}|{ident}".encode()).hexdigest(), n, ident) for at, n, ident in docs if at == leaf]
        for key, _, ident in own:
            upto = sum(n for k, n, _ in own if k <= key)
            copies = whole + (rest > 0 and upto <= rest)
            if copies:
                taken.append((ident, copies))
    return sorted(taken)


def ident(r):
    return f"{'(none)' if r.doc_id is None else r.doc_id}|{hashlib.md5((r.text or '').encode()).hexdigest()}"


def sample():
    rng = random.Random(8)
    rows = []
    for i in range(600):
        source = "a1" if i % 3 == 0 else rng.choice(["a2", "b1", "b2", "c1", None])
        rows.append((i if i % 50 else None, "w " * rng.choice([0, 1, 3, 30, 200]), rng.choice(["en", "fr", None]), source, "x", 1))
    return rows + [(7, "same row", "en", "b1", "x", 1)] * 30 + [(900, None, "en", "b1", "x", 1), (901, "", "zz", "c9", "x", 1)]


def test_matches_brute_force(spark):
    docs = spark.createDataFrame(sample(), DOCS)
    for percent, epochs in ((20, 1), (60, 1), (90, 2), (150, 3), (1000, 2)):
        got = mix_sources(docs, levels(), WEIGHTS, percent, epochs)
        assert sorted((ident(r), r.copies) for r in got.collect()) == brute(sample(), percent, epochs)
    assert "n_tokens" in got.columns and "level_domain" in got.columns


def test_shortage_stays_below_its_ancestor(spark):
    rows = [(i, "w " * 10, "en", s, "x", 1) for i, s in enumerate(["a1"] * 2 + ["a2"] * 100 + ["b1"] * 200)]
    got = mix_sources(spark.createDataFrame(rows, DOCS), levels(), {"source": {"a1": 9}}, 50, 1).groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()
    n = {r.source: r.n for r in got}
    assert n["a1"] == 20 and n["a2"] == 730 and n["b1"] == 750  # a2 makes up for a1; b1 keeps its half


def test_copies_and_empty_table(spark):
    docs = spark.createDataFrame(sample(), DOCS)
    mixed = mix_sources(docs, levels(), WEIGHTS, 150, 3)
    assert repeat_copies(mixed).count() == mixed.agg(F.sum("copies")).first()[0]
    assert mix_sources(spark.createDataFrame([], DOCS), levels(), WEIGHTS).collect() == []
