import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimlens.llm import packing as P

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, sequence_id string, piece_uid int"


def library_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("aàÉß İKé'st.,!?<|>endoftxENDOFTX09_-\n\t\x0b\x1c\x85\xa0́ 中"), max_size=40) | st.text(max_size=30))
def test_ids_are_the_librarys(text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    assert np.frombuffer(P.BlankFreeIds(PATH).encode([text])[0], "<u4").tolist() == library_ids(text)


def test_special_strings():
    for text in ("a <|endoftext|> b", "x<|endoftext|>y", "It's <|startoftext|>THE's, end.", "'s 't don't."):
        assert np.frombuffer(P.BlankFreeIds(PATH).encode([text])[0], "<u4").tolist() == library_ids(text)


def test_long_texts_are_read_in_parts(monkeypatch):
    text = "It's a Wörd, <|endoftext|> and 12 more.\n\x0b" * 30 + "x" * 300
    monkeypatch.setattr(P, "BATCH_BYTES", 50)
    assert np.frombuffer(P.BlankFreeIds(PATH).encode_long(text)[0], "<u4").tolist() == library_ids(text)


def test_best_fit_and_crossover_keep_every_piece_once():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 100, 400)
    a, b = P.first_solutions(lengths, 2, 100, rng)
    for _ in range(20):
        child = P.cross(a, b, lengths, 100, rng)
        fills = np.bincount(child, lengths)
        assert len(child) == 400 and fills.max() <= 100 and fills.min() > 0
    best = P.evolve(lengths, [], None, 30, 4, 100, rng)[0]
    assert P.cost(best, lengths, 100) <= P.cost(a, lengths, 100)
    assert len(np.bincount(best)) <= lower_bound(lengths, 100) + 2


def lower_bound(lengths, capacity):
    """Martello and Toth's bound: pieces below k may be left out of account, for any k."""
    best = 0
    for k in range(capacity // 2 + 1):
        alone, large = lengths[lengths > capacity - k], lengths[(lengths > capacity // 2) & (lengths <= capacity - k)]
        small = lengths[(lengths >= k) & (lengths <= capacity // 2)]
        rest = small.sum() - (len(large) * capacity - large.sum())
        best = max(best, len(alone) + len(large) + max(0, -(-int(rest) // capacity)))
    return best


def check(docs, capacity, **kw):
    out = P.pack_documents(docs, PATH, capacity, with_ids=True, **kw).collect()
    by_doc, by_seq = {}, {}
    for r in out:
        assert r.length == len(r.ids) and 0 < r.length <= capacity and r.start == r.piece * capacity
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return by_doc, by_seq


def test_documents_come_back_whole(spark):
    texts = {1: None, 2: "", 3: "word " * 300, 4: "a b c", 5: "Thé end, of it. " * 40, 6: "x" * 900}
    rows = [(k, t, "s", 1) for k, t in texts.items()] + [(None, "some null id", "s", 1)]
    by_doc, _ = check(spark.createDataFrame(rows, DOCS), 64)
    for k, t in texts.items():
        pieces = sorted(by_doc[k], key=lambda r: r.piece)
        assert sum((list(r.ids) for r in pieces), []) == library_ids(t or "") + [0]
        assert [r.length for r in pieces[:-1]] == [64] * (len(pieces) - 1)
    assert len(by_doc[None]) == 1


def test_repeated_rows_over_shards_pack_tightly(spark):
    rows = [(7, "a " * (i % 37 + 1), "s", i) for i in range(900)] + [(7, "same text", "s", 0)] * 500
    by_doc, by_seq = check(spark.createDataFrame(rows, DOCS), 50, shard_pieces=300)
    assert len(by_doc[7]) == 1400
    assert len(by_seq) <= sum(r.length for r in by_doc[7]) / 50 + 5 + 5


def test_empty_table(spark):
    assert P.pack_documents(spark.createDataFrame([], DOCS), PATH).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "É", "中", "の", "б", "1", "。", "，", ".", "(", "'s", "'", "<|endoftext|>", "́", "_", " ", "!?"]), max_size=60).map("".join))
def test_runs_parted_at_marks_keep_their_ids(text):
    from claimlens.llm.boundaries import with_blanks

    assert library_ids(with_blanks(text, 3)) == library_ids(text)


def test_a_long_text_without_blanks_is_read_in_parts():
    import resource

    text = "这是没有空格的文字，一句接着一句。" * 300_000  # about 15 MB
    encoder = P.BlankFreeIds(PATH)
    one = library_ids("这是没有空格的文字，一句接着一句。")
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert np.array_equal(np.frombuffer(encoder.encode_long(text)[0], "<u4"), np.tile(np.array(one, "<u4"), 300_000))
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 900
    encoder.held = P.CACHE_BYTES + 1
    encoder.encode(["a b"])
    assert len(encoder.numbers) < 10  # full by bytes: emptied


def test_other_tokenizers_go_to_the_library():
    other = P.BlankFreeIds(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_chunks and P.BlankFreeIds(PATH).by_chunks
    from tokenizers import Tokenizer

    text = "Two  words\n and <|endoftext|> More"
    assert np.frombuffer(other.encode([text])[0], "<u4").tolist() == Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
