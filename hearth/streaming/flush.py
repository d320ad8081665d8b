"""Buffers a source: a flush whenever rows, bytes or time reach their limit, each with its reason, kept across micro-batches.

State is three numbers a source, whatever it holds; rows are not kept.  A micro-batch is bounded by the reader (``ingest.read_*``), which
holds back what the query cannot take yet, and a source's rows of a batch are counted frame by frame.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

FLUSHES = "source string, number long, reason string, n long, bytes long"


def flushes(rows: DataFrame, source: str, size: str, time: str, most_rows: int, most_bytes: int, seconds: int, late: str = "0 seconds") -> DataFrame:
    """One row for each flush: ``source, number`` (from 0), ``reason`` (rows, bytes or time), ``n`` rows and their ``bytes``.

    ``time`` is event time: a buffer is flushed when the watermark is ``seconds`` past the first row that it holds.  Where a row reaches the limits of
    rows and bytes at once, rows are the reason.  A null source is one of its own (an empty name), a null size counts nothing.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, n, held, since = state.get if state.exists else (0, 0, 0, -1)
        out = []
        if state.hasTimedOut and n:
            out.append((key[0], number, "time", n, held))
            number, n, held, since = number + 1, 0, 0, -1
        for frame in frames:
            for bytes_, at in zip(frame["size"].tolist(), frame["ms"].tolist(), strict=True):
                since = at if since < 0 else min(since, at)
                n, held = n + 1, held + bytes_
                reason = "rows" if n >= most_rows else "bytes" if held >= most_bytes else None
                if reason:
                    out.append((key[0], number, reason, n, held))
                    number, n, held, since = number + 1, 0, 0, -1
        state.update((number, n, held, since))
        if n:
            state.setTimeoutTimestamp(max(since + 1000 * seconds, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["source", "number", "reason", "n", "bytes"]).astype({"number": "int64", "n": "int64", "bytes": "int64"})

    taken = rows.withWatermark(time, late).select(
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size"), F.unix_millis(time).alias("ms"), time
    )
    return taken.groupBy("source").applyInPandasWithState(run, FLUSHES, "number long, n long, held long, since long", "append", GroupStateTimeout.EventTimeTimeout)
