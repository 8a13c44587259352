"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are its context and
only its reply is trainable. The examples of a conversation are prefixes of one formatted text,
so that text is stored once, turn by turn with offsets, and an example is the prefix it
ends at and the span of its reply: as many rows as turns, however long a conversation
is. :func:`materialise_examples` writes the prefixes out for those who want flat files.

Template: ``<|im_start|>role``, a line end, the text, ``<|im_end|>``, a line end. Inside roles and texts
``<|`` becomes ``<\\|`` and any ``<\\...\\|`` gets one backslash more, so no text can hold a control
string and every text can be read back. A role's backslashes and line ends are escaped as well.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape_column(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def escape_role_column(role: Column) -> Column:
    return escape_column(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(\\|n)", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def format_turns(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    trainable_role: str = "assistant",
) -> DataFrame:
    """One row per turn of the formatted conversations.

    ``conv_id, seq`` (position from 0), ``role, formatted`` (the turn's part of the text),
    ``start, end`` (its place in the conversation's formatted text), ``text_start, text_end``
    (the escaped text's place), ``trainable``.

    Turns are ordered by turn, ties by role and text; a null turn comes first. Null roles
    and texts are empty ones; rows without a conversation id are one conversation.
    Repeated rows are turns of their own. The running offsets are a window over each
    conversation, which spills and never holds one in memory. An empty table gives no rows.
    """
    role = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(""))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    turns = conversations.select(
        F.col(f"`{id_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"), text.alias("text")
    )
    head = F.concat(F.lit(START), escape_role_column(F.col("role")), F.lit("\n"))
    body, tail = escape_column(F.col("text")), F.lit(END + "\n")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = (  # only lengths are taken before the shuffle: the text travels once, as it came
        turns.withColumn("head_chars", F.length(head).cast("long"))
        .withColumn("body_chars", F.length(body).cast("long"))
        .withColumn("chars", F.col("head_chars") + F.col("body_chars") + F.length(tail))
        .withColumn("seq", F.row_number().over(order) - 1)
        .withColumn("start", F.coalesce(F.sum("chars").over(before), F.lit(0).cast("long")))
    )
    return placed.select(
        "conv_id", "seq", "role", F.concat(head, body, tail).alias("formatted"), "start", (F.col("start") + F.col("chars")).alias("end"),
        (F.col("start") + F.col("head_chars")).alias("text_start"),
        (F.col("start") + F.col("head_chars") + F.col("body_chars")).alias("text_end"),
        (F.col("role") == trainable_role).alias("trainable"),
    )


def with_examples(turns: DataFrame) -> DataFrame:
    """:func:`format_turns` expanded: every turn's row (``example`` null) and a row of its own for each example.

    An example's row repeats its target turn and has ``example``: ``target_seq, end`` (the example is the
    formatted text up to there: all before ``start`` is its context) and ``loss_start, loss_end`` (the escaped
    reply, the only trainable characters). Rows are added where the target turn lies, so expanding shuffles no text.
    """
    example = F.struct(F.col("seq").alias("target_seq"), "end", F.col("text_start").alias("loss_start"), F.col("text_end").alias("loss_end"))
    own = F.lit(None).cast("struct<target_seq: int, end: bigint, loss_start: bigint, loss_end: bigint>")
    return turns.withColumn("example", F.explode(F.when(F.col("trainable"), F.array(own, example)).otherwise(F.array(own))))


def prefix_targets(turns: DataFrame) -> DataFrame:
    """One example per trainable turn of :func:`format_turns`: ``conv_id, target_seq, end, loss_start, loss_end``."""
    return with_examples(turns).where(F.col("example").isNotNull()).select("conv_id", "example.*")


def materialise_examples(turns: DataFrame, examples: DataFrame) -> DataFrame:
    """``conv_id, target_seq, text, loss_start, loss_end`` with each example's text written out.

    The output is as large as all prefixes together, which for long conversations grows
    with the square of their turns: meant for conversations of ordinary length.
    """
    e = examples.withColumnRenamed("end", "example_end")
    same = e["conv_id"].eqNullSafe(turns["conv_id"]) & (turns["start"] < e["example_end"])
    return (
        e.join(turns, same)
        .groupBy(e["conv_id"], "target_seq", "loss_start", "loss_end")
        .agg(F.sort_array(F.collect_list(F.struct("seq", "formatted"))).alias("parts"))
        .select("conv_id", "target_seq", F.array_join("parts.formatted", "").alias("text"), "loss_start", "loss_end")
    )


def _parse_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of one formatted turn."""
    role, body = formatted[len(START):].split("\n", 1)
    return unescape_role(role), unescape(body[: -len(END) - 1])


def read_back(turns: DataFrame) -> DataFrame:
    """Per conversation, what the formatted output says: turns, trainable text and sizes.

    ``turns``: :func:`with_examples`. Gives ``conv_id, n_turns, turns_sha256, n_examples, loss_chars,
    loss_sha256, formatted_chars, example_chars``. Turns are parsed and unescaped from the formatted
    text of their own rows; the loss text is cut by the masks from the examples' rows. A conversation streams through its task turn by
    turn (the digests run along), so none is ever held whole. The window that marks a
    conversation's last turn brings its turns together; after :func:`format_turns` they are already.
    """
    own_turns = Window.partitionBy("conv_id").orderBy("seq", "loss_start")
    rows = turns.select(
        "conv_id", "seq", "formatted", "start", F.col("example.end").alias("example_end"), "example.loss_start", "example.loss_end",
    ).withColumn("last", F.lead("seq").over(own_turns).isNull()).sortWithinPartitions("conv_id", "seq", "loss_start")  # a turn, then its example
    kind = turns.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "n_examples", "loss_chars", "loss_sha256", "formatted_chars", "example_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            columns = [pa.array([r[i] for r in done], id_type if i == 0 else None) for i in range(len(names))]
            return pa.RecordBatch.from_arrays(columns, names=names)

        done, state, id_type = [], None, None
        for batch in batches:
            id_type = batch.column(0).type
            for conv, _, formatted, start, example_end, loss_start, loss_end, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None:
                    state = [hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0, 0]
                if loss_start is None:
                    role, text = _parse_turn(formatted)
                    state[0].update(f"{role}\n{text}\n".encode())
                    state[2] += 1
                    state[5] += len(formatted)
                else:
                    reply = unescape(formatted[loss_start - start:loss_end - start])
                    state[1].update(reply.encode())
                    state[3] += 1
                    state[4] += len(reply)
                    state[6] += example_end
                if last:
                    turns_hash, loss_hash, n, examples, loss, chars, example_chars = state
                    done.append((conv, n, turns_hash.hexdigest(), examples, loss, loss_hash.hexdigest(), chars, example_chars))
                    state = None
            if len(done) >= 10_000:
                yield flush()
                done = []
        if done:
            yield flush()

    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, n_examples long, loss_chars long, loss_sha256 string, formatted_chars long, example_chars long"
    return rows.mapInArrow(run, schema)
