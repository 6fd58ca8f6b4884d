"""Lost messages in a stream: gaps within ledgers, found with the last position of each as keyed state, and wrong first messages.

The state of a topic-partition's ledger is one position, however many messages it has, and goes when the watermark has
passed its last message by ``idle``.  Messages at or before the last position have been read already (a source may
deliver again) and aren't looked at.  Within a micro-batch, order doesn't matter; from batch to batch, a ledger's
messages have to come in its order, as a log is read.

Defined results: a ledger's first message has none before it; messages without a position are left out; after a ledger's
state has gone, its next message counts as a first one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewater.functions.envelope import POSITION, position
from tidewater.operators import loss

GAPS = "__topic string, ledger long, prev_entry long, prev_batch_index long, entry long, batch_index long"
LAST = "entry long, batch_index long, batch_size long"


def gaps(messages: DataFrame, delay: str = "1 hour", idle_ms: int = 86_400_000) -> DataFrame:
    """operators.loss.gaps() of a stream of messages, each gap once, in the batch in which the message after it is read."""

    def run(key: tuple[Any, ...], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        # Of each message four numbers; a ledger is bounded.
        rows = pd.concat(list(parts)).sort_values(["entry", "batch_index"])
        at = rows[["entry", "batch_index", "batch_size"]].to_numpy(np.int64)
        if state.exists:
            last = np.array(state.get, np.int64)
            at = at[(at[:, 0] > last[0]) | (at[:, 0] == last[0]) & (at[:, 1] > last[1])]
            at = np.concatenate([last[None], at])
        before, now = at[:-1], at[1:]
        again = (before[:, :2] == now[:, :2]).all(axis=1)
        inside = (now[:, 0] == before[:, 0]) & (now[:, 1] == before[:, 1] + 1)
        after = (now[:, 0] == before[:, 0] + 1) & (now[:, 1] == 0) & (before[:, 1] == before[:, 2] - 1)
        bad = np.flatnonzero(~(inside | after | again))
        state.update(tuple(int(x) for x in at[-1]))
        seen = rows["published_ms"].max()
        now_ms = state.getCurrentWatermarkMs()
        state.setTimeoutTimestamp(max(now_ms, 0 if pd.isna(seen) else int(seen)) + idle_ms)
        if len(bad):
            yield pd.DataFrame({"__topic": key[0], "ledger": key[1], "prev_entry": before[bad, 0], "prev_batch_index": before[bad, 1], "entry": now[bad, 0], "batch_index": now[bad, 1]})

    placed = messages.filter(F.col("__topic").isNotNull() & F.col("ledger").isNotNull() & F.col("entry").isNotNull() & F.col("batch_index").isNotNull())
    placed = placed.select("__topic", *POSITION, "batch_size", "__publishTime").withWatermark("__publishTime", delay)
    placed = placed.withColumn("published_ms", F.unix_millis("__publishTime"))
    return placed.groupBy("__topic", "ledger").applyInPandasWithState(run, GAPS, LAST, "append", GroupStateTimeout.EventTimeTimeout)


def starts(messages: DataFrame) -> DataFrame:
    """The first position of each topic-partition so far, by batch; for update mode.  Minima are taken before rows are shuffled."""
    first = messages.groupBy("__topic").agg(F.min(position()).alias("first"))
    return first.select("__topic", *[F.col(f"first.{c}").alias(c) for c in POSITION])


def wrong_starts(firsts: DataFrame, asked: DataFrame) -> DataFrame:
    """Topic-partitions whose first position, the least that starts() has given, isn't in the entry that was asked for."""
    return loss.wrong_starts(firsts, asked)


def watched(path: str, fail: bool) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that keeps gaps at ``path`` and then raises or warns, as failOnDataLoss says."""

    def run(rows: DataFrame, batch: int) -> None:
        at = f"{path}/batch={batch}"
        rows.write.mode("overwrite").parquet(at)
        n = rows.sparkSession.read.schema(rows.schema).parquet(at).count()
        if n:
            loss.report(f"{n} messages of batch {batch} don't follow the ones before them", fail)

    return run
