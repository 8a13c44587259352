"""The pipeline against a plain version of each stage, on its own predecessor's rows."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")
public_tokenizers = pytest.importorskip("public_tokenizers")

from claimlens.llm import langid as L  # noqa: E402
from claimlens.llm import secret_scan as S  # noqa: E402
from claimlens.llm.queries import MIX_WEIGHTS  # noqa: E402

from . import test_mixing as mixing  # noqa: E402
from . import test_simhash as simhash  # noqa: E402


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """[(rows in, rows out)] of each stage, on small documents and planted ones."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    base = " ".join(f"The thing {i} was with the others and" for i in range(80))
    planted = [
        (900_001, base, "en", "src3", 1), (900_002, base, "en", "src4", 1), (900_003, base.replace("thing 7 ", "things 7 "), "en", "src5", 1),
        (900_004, "12345 --- 678", "en", "src1", 13), (900_005, None, "en", "src1", 0), (900_006, "", "de", "src2", 0),
        (900_007, base[500:] + ' password = "hunter2hunter2xyz" and more', "en", "src6", 1),
        (None, "Ein Text ohne Nummer und mit der Sprache", "de", None, 40),
    ]
    docs = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    folder = tmp_path_factory.mktemp("pipeline")
    docs.write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, str(folder))
        if name != "packing":
            assert done.columns == docs.columns
        done.write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out.append((docs.collect(), after.collect()))
        docs = after
    out.append(str(folder))
    return out


def test_language_stage(spark, stages):
    before, after = stages[0]
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    model = L.fit_language_model(spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long"), learn)
    rejected = L.rejections(model, [r.text for r in before])[2]
    want = [r for r, gone in zip(before, rejected, strict=True) if not gone]
    assert collections.Counter(map(tuple, after)) == collections.Counter(map(tuple, want))
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert {900_004, 900_005, 900_006} <= gone and len(gone) <= 6


def test_dedup_stage(stages):
    before, after = stages[1]
    prints = [simhash.plain_fingerprint(r.text) for r in before]
    groups = simhash.components(range(len(before)), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 4)
    first = {}
    for i, g in groups.items():
        key = (before[i].doc_id is None, before[i].doc_id or 0)
        first[g] = min(first.get(g, (key, i)), (key, i))
    assert collections.Counter(map(tuple, after)) == collections.Counter(tuple(before[i]) for _, i in first.values())
    assert {r.doc_id for r in after} & {900_001, 900_002, 900_003} == {900_001}


def test_secret_stage(stages):
    before, after = stages[2]
    want = [(*r[:1], S.redact_text(r.text), *r[2:4], len(S.redact_text(r.text))) for r in before]
    assert collections.Counter(map(tuple, after)) == collections.Counter(want)
    assert not any("hunter2" in r.text for r in after) and len(after) == len(before)


def test_mixing_stage(stages, monkeypatch):
    before, after = stages[3]
    monkeypatch.setattr(mixing, "WEIGHTS", MIX_WEIGHTS)
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in before]
    domain = lambda s: f"d{int(s[3:]) // 5}" if s else "(none)"
    want = dict(mixing.brute(rows, corpus_pipeline.MIX_PERCENT, corpus_pipeline.MIX_EPOCHS, corpus_pipeline.MIX_SEED, domain))
    got = collections.Counter(mixing.ident(r) for r in after)
    assert set(got) == set(want)
    words = lambda rows: sum(len((r.text or "").split()) for r in rows)
    assert 0.7 * words(before) <= words(after) <= 0.8 * words(before)


def test_packing_stage(stages):
    from tokenizers import Tokenizer

    before, after = stages[4]
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = {r.doc_id: len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in before}
    got = collections.Counter()
    bins = collections.defaultdict(list)
    for r in after:
        got[r.doc_id] += r.length
        bins[r.sequence_id].append((r.offset, r.length))
    assert got == tokens
    for places in bins.values():
        assert sorted(places)[0][0] == 0 and sum(n for _, n in places) <= corpus_pipeline.CAPACITY
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(places), sorted(places)[1:], strict=False))
    assert len(bins) <= np.ceil(sum(tokens.values()) / corpus_pipeline.CAPACITY) * 1.03 + 1


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, stages[-1]).select("doc_id", "piece", "length", "ids_crc32").collect()
    want = [(r.doc_id, r.piece, r.length, r.ids_crc32) for r in stages[4][1]]
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
