"""Keyed streaming state (T1): the current version of each claim, and what changed.

A stateful operator holds the current row per key. Every delivered row becomes one row of a change
feed: ``insert``, ``update`` (with the row before), ``late`` (older than the current one) or ``repeat``.
Keys are dealt by hash into cells, and Python is called once per cell and micro-batch, not per key: the
state of a cell is the current rows of its keys, and all of them advance in a few array operations.
State of a key that has been idle is dropped by a timer; a row for a forgotten key comes as an ``insert``
without a row before. No watermark drops rows. Inserts and updates are brought into a table by key bucket that
compares versions itself, so neither a dropped state nor a repeated micro-batch changes what it holds.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..schemas import CLAIM, CORRUPT_COLUMN
from ..session import session_conf
from ..sinks.buckets import BucketTable
from .incremental import claim_stream

CHANGES = ("insert", "update", "late", "repeat")


CELLS = 1024  # for up to some hundred million keys: a cell's rows are one state value and one call
_SEEN = "_seen_ms"  # when a held key was last delivered
_ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def _packed(held: pd.DataFrame) -> bytes:
    """Rows as one state value."""
    table = pa.Table.from_pandas(held, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(value: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(value).read_all().to_pandas()


def _wire_type(kind: T.DataType) -> T.DataType:
    """Whole numbers travel as decimals: pandas would make doubles of those of a cell that holds a null."""
    return T.DecimalType(20, 0) if isinstance(kind, T.IntegralType) else kind


def advance_cell(delivered: pd.DataFrame, held: pd.DataFrame | None, key: str, order: Sequence[str], now_ms: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """(feed, held rows after) of the rows that a micro-batch has for a cell's keys.

    Per key, the held row and the delivered ones are laid in the order of their versions (columns ``order``, null
    least; the held row first among equals). Rows before the held one are late; of the others, one equal to the
    row before it is a repeat and one greater an update of it.
    """
    names, n_held = list(delivered.columns), 0 if held is None else len(held)
    both = pd.concat([held[names], delivered], ignore_index=True) if n_held else delivered.reset_index(drop=True)
    ranks = {c: pd.factorize(both[c], sort=True)[0] for c in [key, *order]}  # null is -1
    came = np.arange(len(both)) >= n_held
    line = np.lexsort((came, *(ranks[c] for c in reversed(order)), ranks[key]))
    came, keys = came[line], ranks[key][line]
    first = np.append(True, keys[1:] != keys[:-1])
    same = ~first
    for c in order:
        same[1:] &= ranks[c][line][1:] == ranks[c][line][:-1]
    group, place = np.cumsum(first) - 1, np.arange(len(line))
    held_at, seen = np.full(group[-1] + 1, -1), np.full(group[-1] + 1, now_ms, dtype="int64")
    held_at[group[~came]] = place[~came]
    late = came & (held_at[group] > place)
    follows = late | ~first
    before = np.where(follows, line[np.where(late, held_at[group], place - 1)], -1)
    change = np.where(late, "late", np.where(~follows, "insert", np.where(same, "repeat", "update")))
    feed = both.iloc[line[came]].reset_index(drop=True)
    feed.insert(0, "change", change[came])
    old = both.reindex(before[came]).reset_index(drop=True)  # -1 is no row: all null
    silent = np.setdiff1d(group[~came], group[came])
    seen[silent] = held[_SEEN].to_numpy()[line[held_at[silent]]] if len(silent) else 0
    after = both.iloc[line[np.append(first[1:], True)]].reset_index(drop=True)
    return pd.concat([feed, old.add_prefix("old_")], axis=1), after.assign(**{_SEEN: seen})


def change_schema(schema: T.StructType) -> T.StructType:
    """``change``, the row delivered, and the current row before it as ``old_*``."""
    fields = [T.StructField(f.name, f.dataType) for f in schema.fields]
    return T.StructType([T.StructField("change", T.StringType()), *fields, *[T.StructField(f"old_{f.name}", f.dataType) for f in schema.fields]])


def change_feed(
    rows: DataFrame, schema: T.StructType = CLAIM, key: str = "claim_id", order_by: Sequence[str] = ("updated_at",), idle_ms: int = 7 * 24 * 3600 * 1000,
    cells: int = CELLS,
) -> DataFrame:
    """The change feed of a stream of rows with a key, one row per row delivered.

    Versions are ordered as by ``latest_version``: ``order_by``, then the other columns, null least. The rows that a
    micro-batch has for a key are taken in that order, so the feed does not depend on how files are dealt
    to tasks. A key's state is one row; it goes ``idle_ms`` after its last delivery. ``cells`` is fixed for
    a checkpoint: a task holds one cell's rows at a time, so choose it for at most some hundred thousand keys in each.
    """
    names = schema.fieldNames()
    ordered = [*order_by, *(c for c in names if c != key and c not in order_by)]
    wire = T.StructType([T.StructField(f.name, _wire_type(f.dataType)) for f in schema.fields])

    def advance(_, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        warnings.filterwarnings("ignore", message="The behavior of DataFrame concatenation")  # of columns that a batch has no value for
        now = state.getCurrentProcessingTimeMs()
        held = _unpacked(state.get[0]) if state.exists else None
        delivered = [part[names] for part in parts if len(part)]
        feed = None
        if delivered:
            feed, held = advance_cell(pd.concat(delivered, ignore_index=True), held, key, ordered, now)
        kept = held[held[_SEEN] + idle_ms >= now]
        if len(kept):
            state.update((_packed(kept),))
            state.setTimeoutDuration(max(1, int(kept[_SEEN].min()) + idle_ms - now))
        else:
            state.remove()
        if feed is not None:
            yield feed

    typed = rows.select(F.pmod(F.xxhash64(key), F.lit(cells)).alias("_cell"), *[F.col(f.name).cast(f.dataType) for f in wire.fields])
    feed = typed.groupBy("_cell").applyInPandasWithState(
        advance, change_schema(wire), T.StructType([T.StructField("held", T.BinaryType())]), "append", GroupStateTimeout.ProcessingTimeTimeout
    )
    return feed.select(*[F.col(f.name).cast(f.dataType) for f in change_schema(schema).fields])


def follow_claims(
    spark: SparkSession, source_dir: str, target_dir: str, checkpoint_dir: str, schema: T.StructType = CLAIM, fmt: str = "csv", key: str = "claim_id",
    order_by: Sequence[str] = ("updated_at",), buckets: int = 64, idle_ms: int = 7 * 24 * 3600 * 1000,
    cells: int = CELLS,
) -> dict:
    """Process every file not yet seen, then stop; returns rows by kind of change.

    ``<target>/current`` is the table by key bucket, ``<target>/changes/batch=<n>`` the inserts and updates,
    ``<target>/history/batch=<n>`` the late rows and ``<target>/unread/batch=<n>`` the rows without a
    key or that did not parse. A micro-batch that is repeated replaces its own folders. The state lies in
    RocksDB on the executors' disks, not in their heaps, unless the session names another store.
    """
    table = BucketTable(spark, f"{target_dir}/current", schema, key, order_by, buckets)
    names = schema.fieldNames()
    totals = dict.fromkeys([*CHANGES, "unread"], 0)

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = lambda kind: f"{target_dir}/{kind}/batch={batch_id}"
        batch.write.mode("overwrite").option("compression", "zstd").parquet(folder("feed"))  # the state advances once; what follows reads what it gave
        feed = spark.read.schema(batch.schema).parquet(folder("feed"))
        current = feed.filter(F.col("change").isin("insert", "update"))
        current.write.mode("overwrite").option("compression", "zstd").parquet(folder("changes"))
        feed.filter("change = 'late'").select(*names).write.mode("overwrite").option("compression", "zstd").parquet(folder("history"))
        table.upsert(current.select(*names))
        for kind, n in feed.groupBy("change").count().collect():
            totals[kind] += n

    stream = claim_stream(spark, source_dir, schema, fmt)
    bad = F.col(key).isNull()
    if CORRUPT_COLUMN in stream.columns:
        bad = bad | F.col(CORRUPT_COLUMN).isNotNull()
    # timers run with the next delivery: processing-time timers would ask for empty batches for ever
    store = {k: spark.conf.get(k, None) or v for k, v in _ROCKSDB.items()}
    with session_conf(spark, {"spark.sql.streaming.noDataMicroBatches.enabled": "false"} | store):
        query = (
            change_feed(stream.filter(~bad).select(*names), schema, key, order_by, idle_ms, cells)
            .writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint_dir}/feed").trigger(availableNow=True).start()
        )
        query.awaitTermination()

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{target_dir}/unread/batch={batch_id}")
        totals["unread"] += spark.read.schema(batch.schema).parquet(f"{target_dir}/unread/batch={batch_id}").count()

    claim_stream(spark, source_dir, schema, fmt).filter(bad).writeStream.foreachBatch(keep).option(
        "checkpointLocation", f"{checkpoint_dir}/unread"
    ).trigger(availableNow=True).start().awaitTermination()
    return totals


def current_claims(spark: SparkSession, target_dir: str, schema: T.StructType = CLAIM, key: str = "claim_id", order_by: Sequence[str] = ("updated_at",), buckets: int = 64) -> DataFrame:
    """The current row of every claim that :func:`follow_claims` has seen."""
    return BucketTable(spark, f"{target_dir}/current", schema, key, order_by, buckets).current()
