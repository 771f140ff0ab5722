"""S12 + W02 as a stream: the state of statements while their state events arrive.

The executors poll a statement until its state is terminal. Here its state events
are a stream, in any order. What is kept of a statement is its first terminal event
(by time, then sequence), the number of its events and the latest event time: a few
numbers, however many events it has. A statement is forgotten when nothing has been
heard of it for ``timeout`` of event time, so the state holds the running statements
only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from arrivalgate.operators import runs as R

# A row of the state's output; an empty name and -1 stand for "none yet".
OUT = "statement_id string, part int, final_state string, at_us long, seq long, n_events long, closed boolean"
STATE = "at_us long, seq long, state string, n_events long, last_us long"


def statement_states_stream(events: DataFrame, id_col: str = "statement_id", poll_error_fails: bool = False,
                            aliases: dict[str, str] | None = None, timeout_ms: int = 86_400_000,
                            watermark: str = "1 hour", parts: int = 8) -> DataFrame:
    """What a micro-batch adds to the state of statements, in update mode: (id, ``part``,
    ``final_state``, ``terminal_at``, ``terminal_seq``, ``n_events``, ``closed``).

    The events of a statement are dealt over ``parts``, so that one with a third of all
    events is no single task's; each part has its own state, and ``newest_states`` adds
    the parts up. A last row with ``closed`` follows when nothing came to a part for
    ``timeout_ms`` of event time: with its first terminal state, or without one. A
    statement without one in any part timed out. Events later than the watermark are not
    taken in; events after the close begin anew.
    """
    st = F.col("state")
    for k, v in (aliases or {}).items():
        st = F.when(st == k, v).otherwise(st)
    if poll_error_fails:
        st = F.when(st == "POLL_ERROR", R.FAILED_ST).otherwise(st)
    part = F.pmod(F.xxhash64("started", "seq"), F.lit(parts)).cast("int")
    rows = (events.select(F.col(id_col).cast("string").alias("statement_id"), part.alias("part"),
                          F.col("started").cast("timestamp").alias("started"), F.col("seq").cast("long").alias("seq"), st.alias("state"))
            .where("statement_id is not null and started is not null").withWatermark("started", watermark))
    terminal = list(R.TERMINAL)

    def take_in(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, seq, name, n, last = state.get if state.exists else (-1, -1, "", 0, 0)
        closed = state.hasTimedOut
        for pdf in batches:
            if not len(pdf):        # a timeout comes without rows
                continue
            us = pdf["started"].astype("datetime64[us]").astype("int64")
            n, last = n + len(pdf), max(last, int(us.max()))
            done = pdf.assign(us=us)[pdf["state"].isin(terminal)]
            if len(done):
                first = done.sort_values(["us", "seq"]).iloc[0]
                if not name or (int(first["us"]), int(first["seq"])) < (at, seq):
                    at, seq, name = int(first["us"]), int(first["seq"]), first["state"]
        if closed:
            state.remove()
        else:
            state.update((at, seq, name, n, last))
            state.setTimeoutTimestamp(max(last // 1000 + timeout_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"statement_id": [key[0]], "part": [key[1]], "final_state": [name], "at_us": [at], "seq": [seq],
                            "n_events": [n], "closed": [closed]})

    got = rows.groupBy("statement_id", "part").applyInPandasWithState(take_in, OUT, STATE, "update", GroupStateTimeout.EventTimeTimeout)
    known = F.col("final_state") != ""
    return got.select(F.col("statement_id").alias(id_col), "part", F.when(known, F.col("final_state")).alias("final_state"),
                      F.when(known, F.timestamp_micros("at_us").cast("timestamp_ntz")).alias("terminal_at"),
                      F.when(known, F.col("seq")).alias("terminal_seq"), "n_events", "closed")


def newest_states(updates: DataFrame, id_col: str = "statement_id") -> DataFrame:
    """The statements as the updates written so far leave them: ``runs.statement_states``
    over their events, and ``closed`` once every part is (statements that resumed after
    their close count as they were before)."""
    cols = ["final_state", "terminal_at", "terminal_seq", "n_events", "closed"]
    part = updates.groupBy(id_col, "part").agg(F.max_by(F.struct(*cols), F.struct("n_events", "closed")).alias("_n"))
    part = part.select(id_col, *[f"_n.{c}" for c in cols])
    first = F.min(F.when(F.col("final_state").isNotNull(), F.struct("terminal_at", "terminal_seq", "final_state")))
    return (part.groupBy(id_col).agg(first.alias("_t"), F.sum("n_events").alias("n_events"), F.bool_and("closed").alias("closed"))
            .select(id_col, F.col("_t.final_state").alias("final_state"), F.col("_t.terminal_at").alias("terminal_at"), "n_events", "closed"))
