"""State per key over a stream: repeats within a time dropped, and visits summed up when they are over."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

MICRO = 1_000_000


def _in_order(parts: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[tuple]:
    """A key's rows of one batch by time and id; they come in parts that are not ordered among themselves."""
    rows = [tuple(r) for part in parts for r in part[columns].itertuples(index=False)]
    return iter(sorted(rows, key=lambda r: r[:2]))


def drop_repeats(stream: DataFrame, key: str, time: str, ident: str, seconds: int, late: str) -> DataFrame:
    """``key, ident, moment`` of rows that come at least ``seconds`` after the row of their key that was kept last.

    State is the time of that row, and goes when the watermark is past it by ``seconds``. Within a batch rows are taken in
    order of time and id; rows later than the watermark are dropped, null keys and times too.
    """
    schema = f"{key} {dict(stream.dtypes)[key]}, {ident} {dict(stream.dtypes)[ident]}, moment bigint"

    def kept(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last, out = state.get[0] if state.exists else None, []
        for at, number in _in_order(parts, ["_at", "_ident"]):
            if last is None or at - last >= seconds * MICRO:
                last = at
                out.append((group[0], number, at))
        state.update((last,))
        state.setTimeoutTimestamp(max(last // 1000 + seconds * 1000, state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame(out, columns=[key, ident, "moment"])

    known = stream.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withWatermark(time, late)
    known = known.select(key, time, F.unix_micros(time).alias("_at"), F.col(ident).alias("_ident"))
    return known.groupBy(key).applyInPandasWithState(kept, schema, "last bigint", "append", GroupStateTimeout.EventTimeTimeout)


def visits(stream: DataFrame, key: str, time: str, ident: str, kind: str, value: str, seconds: int, late: str) -> DataFrame:
    """One row per finished visit of a key: ``key, begin, last, n, total, last_kind, n_switches``.

    A visit ends when nothing came for more than ``seconds``; it is handed on by the next row of the key, or by a timer once the
    watermark is that far. ``n_switches`` counts how often ``kind`` differs from the row before, which an aggregate without
    order cannot say. What is still open stays in the state for the next run. Null keys and times are left out; a null value adds nothing.
    """
    schema = f"{key} {dict(stream.dtypes)[key]}, begin bigint, last bigint, n bigint, total double, last_kind string, n_switches bigint"
    names = [key, "begin", "last", "n", "total", "last_kind", "n_switches"]

    def followed(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get if state.exists else None
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([(group[0], *now)], columns=names)
            return
        done = []
        for at, _, what, amount in _in_order(parts, ["_at", "_ident", "_kind", "_value"]):
            what, amount = None if pd.isna(what) else what, 0.0 if pd.isna(amount) else float(amount)
            if now is not None and at - now[1] > seconds * MICRO:
                done.append((group[0], *now))
                now = None
            if now is None:
                now = (at, at, 1, amount, what, 0)
            else:
                now = (now[0], max(now[1], at), now[2] + 1, now[3] + amount, what, now[5] + (what != now[4]))
        state.update(now)
        state.setTimeoutTimestamp(max(now[1] // 1000 + seconds * 1000 + 1, state.getCurrentWatermarkMs() + 1))
        if done:
            yield pd.DataFrame(done, columns=names)

    known = stream.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withWatermark(time, late)
    known = known.select(key, time, F.unix_micros(time).alias("_at"), F.col(ident).alias("_ident"), F.col(kind).alias("_kind"), F.col(value).alias("_value"))
    state = "begin bigint, last bigint, n bigint, total double, last_kind string, n_switches bigint"
    return known.groupBy(key).applyInPandasWithState(followed, schema, state, "append", GroupStateTimeout.EventTimeTimeout)
