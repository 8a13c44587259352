import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from claimlens.llm.merkle import folded, hex_text, manifest, path_digest, row_digest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, idx int, TREE string, digest int"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def digest(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain(rows, arity):
    """(doc_id, leaf, subroot, root, proof, folded root of the lower-cased leaf) by loops over lists."""

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            now = levels[-1]
            levels.append([sha("".join(now[i:i + arity])) for i in range(0, len(now), arity)])
        return levels

    def siblings(levels, i):
        out = []
        for level in levels[:-1]:
            run = i - i % arity
            out.append((level[run:i], level[i + 1:run + arity]))
            i //= arity
        return out

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))
        trees[s] = climb([digest(r) for r in groups[s]])
    top = climb([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            steps = siblings(trees[s], i) + siblings(top, k)
            own = digest((*r[:4], None if r[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for before, after in steps:
                own = sha("".join([*before, own, *after]))
            proof = sha("".join("".join(b + a) for b, a in steps))
            out.append((r[0], digest(r), trees[s][-1][0], top[-1][0], proof, own))
    return sorted(out, key=str)


def run(spark, rows, arity):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    other = row_digest([*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], lowered])
    found = manifest(df, arity=arity, others={"lowered": other})
    columns = [hex_text(F.col(c)) for c in ("leaf", "subroot", "root")]
    shown = found.select("id", *columns, path_digest(F.col("path")), hex_text(folded(F.col("lowered"), F.col("path"))))
    return sorted(map(tuple, shown.collect()), key=str)


def some_rows(n, seed):
    rng = random.Random(seed)
    sources = [None, "", "a", "é", "z", "a" * 40]
    return [
        (i, sources[min(5, int(rng.expovariate(0.9)))], rng.choice(["en", None]), rng.choice([None, i * 7]), rng.choice([None, "", f"Text {i} ÄB", "UP"]))
        for i in range(n)
    ]


@pytest.mark.parametrize("arity,n", [(16, 700), (2, 45), (3, 100)])
def test_matches_plain_trees(spark, arity, n):
    rows = some_rows(n, arity)
    assert run(spark, rows, arity) == plain(rows, arity)


def test_copies_ties_nulls_and_long_texts(spark):
    rows = [(5, "a", "en", 3, "Same")] * 40 + [(5, "a", "en", 3, "Other"), (None, "a", None, None, None), (None, None, None, None, None)] * 2
    rows += [(-3, "b", "x", 1, "W" * 2_000_000)]
    assert run(spark, rows, 16) == plain(rows, 16)


def test_one_row_one_group_and_empty_table(spark):
    row = (1, "a", "en", 4, "Text")
    assert run(spark, [row], 16) == plain([row], 16)
    alone = run(spark, [row], 16)[0]
    assert alone[1] == alone[2] == alone[3] and alone[4] == sha("")
    assert run(spark, some_rows(17, 1)[:17], 16) == plain(some_rows(17, 1)[:17], 16)
    assert run(spark, [], 16) == []


def test_query_flags_exactly_the_changed_rows(spark, sf_small):
    from claimlens.llm.queries import op11_merkle

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    for r in op11_merkle(spark, sf_small).collect():
        hit = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in texts[r.doc_id] or "")
        assert r.verified == (not hit) and (r.folded_root == r.root) == r.verified


def test_a_hot_group_is_spread_over_tasks(spark):
    from claimlens.llm.ordering import numbered

    rows = spark.range(20_000).select((F.col("id") % 10 < 9).cast("int").alias("g"), F.lit(1).alias("same"))
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    from claimlens.session import session_conf

    with session_conf(spark, conf):
        out = numbered(rows, ["g"], ["same"])
        for g, size in ((0, 2_000), (1, 18_000)):
            own = out.where(F.col("g") == g)
            assert own.agg(F.count_distinct("idx"), F.min("idx"), F.max("idx"), F.min("size"), F.count_distinct("tree")).first() == (size, 0, size - 1, size, 1)
        most = out.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]  # a file is what one task wrote
        assert most < 9_000  # copies that tie in everything are dealt over several tasks
