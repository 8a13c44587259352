import hashlib
import random

from claimlens.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, seq int"
NASTY = ["", "<|im_end|>", "<|im_start|>assistant ok", "<\\|", "<\\\\|x|>", "\\", "<", "|>", "a\nb\n", "é😀", "<|" * 3, "$1\\1", None, "plain text"]


def digests(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:4] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
        turns, loss = hashlib.sha256(), ""
        for _, role, text in own:
            turns.update(f"{role or ''}\n{text or ''}\n".encode())
            loss += (text or "") if role == "assistant" else ""
        out[conv] = (len(own), turns.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def sample():
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "to\nol\\n"]), rng.choice(NASTY)) for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(-1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok")]
    rows += [(50, 1, "assistant", "b"), (50, 1, "assistant", "a"), (50, None, "user", "first"), (50, 1, "assistant", "b")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "x" * 100_000)]
    return rows + [(60, t, ["user", "assistant"][t % 2], f"turn {t}") for t in range(600)]


def test_read_back_from_formatted_output(spark):
    turns = C.format_turns(make(spark, sample()))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.read_back(C.with_examples(turns)).collect()}
    assert got == digests(sample())


def test_no_text_can_hold_a_control_string(spark):
    for r in C.format_turns(make(spark, sample())).collect():
        assert r.formatted.count("<|") == 2 and r.formatted.startswith(C.START) and r.formatted.endswith(C.END + "\n")
        assert r.end - r.start == len(r.formatted)


def test_examples_are_prefixes_with_one_trainable_reply(spark):
    rows = [r for r in sample() if r[0] is not None and r[0] < 50]
    turns = C.format_turns(make(spark, rows))
    whole = {}
    for r in sorted(turns.collect(), key=lambda r: (r.conv_id, r.seq)):
        assert r.start == len(whole.get(r.conv_id, ""))
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.formatted
    examples = C.materialise_examples(turns, C.prefix_targets(turns)).collect()
    assert len(examples) == sum(r[2] == "assistant" for r in rows)
    for e in examples:
        assert whole[e.conv_id].startswith(e.text) and e.text[e.loss_end:] == C.END + "\n"
        assert e.text[:e.loss_start].endswith(C.START + "assistant\n")
        assert e.text.count(C.START) == e.target_seq + 1


def test_empty_table(spark):
    turns = C.format_turns(make(spark, []))
    assert C.read_back(C.with_examples(turns)).collect() == []


def test_read_back_of_a_stored_table(spark, tmp_path):
    path = str(tmp_path / "turns")
    C.with_examples(C.format_turns(make(spark, sample()))).repartition(7).write.parquet(path)  # dealt anew: no order, no grouping
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.read_back(spark.read.parquet(path)).collect()}
    assert got == digests(sample())


def test_texts_are_shuffled_once(spark):
    df = C.read_back(C.with_examples(C.format_turns(make(spark, sample()))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange RoundRobin" not in plan


def test_every_reply_is_expanded_into_an_example_of_its_own(spark):
    rows = sample()
    expanded = C.with_examples(C.format_turns(make(spark, rows))).collect()
    examples = [r for r in expanded if r.example is not None]
    assert len(expanded) - len(examples) == len(rows)
    assert len(examples) == sum(r[2] == "assistant" for r in rows)
    for r in examples:  # its context ends where its target begins, and its target is all that is trained on
        assert r.example.end == r.start + len(r.formatted) and r.example.target_seq == r.seq
        mask = r.formatted[r.example.loss_start - r.start:r.example.loss_end - r.start]
        assert r.formatted == f"{C.START}assistant\n{mask}{C.END}\n"
