import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimlens.llm import token_counts as T

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, n_tokens string, text_to_count int"
PIECES = st.sampled_from(["a", "Bé", " ", "  ", "\n", "\t", "\x85", "\xa0", "\u2003", "1", "23", "'s", "'", "<|endoftext|>", "<|", "中", "😀", "...", "_", "\x1c", "ab cd"])


def whole(text, path=PATH):
    if path.endswith(".model"):
        import sentencepiece

        return len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text))
    from tokenizers import Tokenizer

    return len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=60).map("".join))
def test_split_texts_count_like_whole_ones(text):
    parts = T.split_safely(text, 5)
    assert "".join(parts) == text
    assert sum(T.count_texts(parts, PATH)) == whole(text)


def test_batches_are_bounded_and_counts_whole(monkeypatch):
    monkeypatch.setattr(T, "SPLIT_CHARS", 40)
    monkeypatch.setattr(T, "BATCH_BYTES", 100)
    texts = ["", "one two three " * 50, "x" * 500, "a <|endoftext|> b " * 9]
    assert T.count_texts(texts, PATH) == [whole(t) for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_documents(spark, name):
    path = public_tokenizers.path(name)
    rows = [(1, None, "x", 1), (2, "", "x", 1), (3, "Short é text.", "x", 1), (3, "Short é text.", "x", 1), (None, "no id", None, None),
            (4, "long words and more " * 9000, "x", 1), (5, "<|endoftext|> in a text", "x", 1)]
    got = T.count_tokens(spark.createDataFrame(rows, DOCS), path, limit=10).collect()
    assert got[0].__fields__ == ["doc_id", "text_to_count", "n_bytes", "n_tokens", "over_limit"]
    assert [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got] == [
        (i, len((t or "").encode()), whole(t or "", path), whole(t or "", path) > 10) for i, t, *_ in rows
    ]
    assert T.count_tokens(spark.createDataFrame([], DOCS), path).collect() == []


NO_BLANKS = st.lists(st.sampled_from(["a", "é", "中", "文", "の", "カ", "한", "б", "1", "。", "，", ".", ",", "(", "）", "'s", "'", "<|endoftext|>", "|", "́", "😀", "_", "…", "!?"]), max_size=80).map("".join)


@settings(max_examples=300, deadline=None)
@given(NO_BLANKS)
def test_texts_without_blanks_are_split_between_letters_and_marks(text):
    parts = T.split_safely(text, 4)
    assert "".join(parts) == text and sum(T.count_texts(parts, PATH)) == whole(text)


def test_a_long_text_without_blanks_stays_in_bounded_memory():
    import resource

    text = "这是没有空格的文字，一句接着一句。" * 600_000  # about 30 MB
    T.count_texts([text[:1000]], PATH)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert T.count_texts([text], PATH) == [whole("这是没有空格的文字，一句接着一句。" * 10) * 60_000]
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 700  # MB; whole it took gigabytes
