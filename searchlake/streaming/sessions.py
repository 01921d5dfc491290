"""Running session totals and compaction points on a stream of turns.

Turns of a conversation are numbered 0, 1, 2, ... and may arrive in any order
and cut into any micro-batches. The state of a conversation is the next
position, its running totals and the turns that wait for an earlier one; a
row is emitted as soon as every earlier turn has come, so the stream's rows
are those of the batch operators for any cut. Arrow batches are folded one at
a time with array arithmetic, never a loop over turns. Conversations of one of
``SESSION_GROUPS`` hash groups share a call and a stored state.

Late turns: a gap is waited for until the watermark passes the event time of
the oldest waiting turn plus ``wait``; then the waiting turns are emitted
without the missing ones. A turn whose position was passed already (it
came after that, or a second time) changes no total and comes out with ``late``
true and null totals. A turn without a position is late as well.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from searchlake.session import ship_package

# three running numbers: I5 input tokens, output tokens, messages; I6 sends, tokens, first send at the token limit (0: none)
SESSION_STATE = T.StructType([
    T.StructField("next_pos", T.LongType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
    T.StructField("c", T.LongType()), T.StructField("waiting", T.BinaryType())])
_FIELDS = ("pos", "input", "output", "send", "ms")
#: What a call of the fold costs is paid once a hash group of conversations, not once a conversation.
SESSION_GROUPS = 1024
GROUP_STATE = T.StructType([T.StructField("sessions", T.BinaryType())])
# a conversation within a group's state; timer (ms) is 0 where nothing waits
_HELD = pa.schema([("key", pa.string()), ("next_pos", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()),
                   ("waiting", pa.binary()), ("timer", pa.int64())])


def _totals(rows: np.ndarray, run: list[int]):
    """I5 of consecutive turns: columns and the new running numbers."""
    sums = np.cumsum(np.column_stack([rows[:, 1], rows[:, 2], np.ones(len(rows), np.int64)]), axis=0) + np.array(run)
    cols = {"total_input_tokens": sums[:, 0], "total_output_tokens": sums[:, 1], "message_count": sums[:, 2]}
    return rows[:, 0], cols, [int(v) for v in sums[-1]]


def _compaction(tokens: int | None, messages: int | None):
    """I6 of consecutive turns, of which only sends count; the closed form of ``usage.compaction_points``."""
    k1 = None if messages is None else max(-(-messages // 2), 2)
    every = None if messages is None else max(-(-(messages - 1) // 2), 1)

    def step(rows: np.ndarray, run: list[int]):
        rows = rows[rows[:, 3] != 0]
        sent, spent, first = run
        if not len(rows):
            return rows[:, 0], {"send_no": [], "cum_tokens": [], "fired": [], "messages_left": []}, run
        k = sent + 1 + np.arange(len(rows), dtype=np.int64)
        cum = spent + np.cumsum(rows[:, 1] + rows[:, 2])
        if not first and tokens is not None and (cum >= tokens).any():
            first = int(k[(cum >= tokens).argmax()])
        end = first or np.iinfo(np.int64).max
        fired, last = np.zeros(len(k), bool), np.zeros(len(k), np.int64)
        if messages is not None:
            fired |= (k < end) & (k >= k1) & ((k - k1) % every == 0)
            upto = np.minimum(k - 1, end - 1)
            last = np.where(upto >= k1, k1 + (upto - k1) // every * every, last)
        if first:
            start = max(first, 2)
            fired |= k >= start
            last = np.where(k - 1 >= start, np.maximum(last, k - 1), last)
        left = np.where(fired, 1, np.where(last == 0, 2 * k, 1 + 2 * (k - last)))
        cols = {"send_no": k, "cum_tokens": cum, "fired": fired, "messages_left": left}
        return rows[:, 0], cols, [int(k[-1]), int(cum[-1]), first]
    return step


def _waiting(held: bytes) -> np.ndarray:
    return np.frombuffer(bytes(held), np.int64).reshape(-1, len(_FIELDS))


def _advance(step, sends_only: bool, at: int, run: list[int], waiting: np.ndarray, new: np.ndarray):
    """One conversation and its new turns, sorted by position: next position, running
    numbers and waiting turns after them, the positions of late turns, what came out of ``step`` or None."""
    again = np.r_[False, new[1:, 0] == new[:-1, 0]] if len(new) else np.empty(0, bool)
    late = (new[:, 0] < at) | again
    if len(waiting):
        late |= np.isin(new[:, 0], waiting[:, 0])
    told = late & (new[:, 3] != 0) if sends_only else late
    rows = np.concatenate([waiting, new[~late]])
    rows = rows[np.argsort(rows[:, 0], kind="stable")]
    n = int((rows[:, 0] == at + np.arange(len(rows))).sum())  # sorted and distinct: true on a prefix only
    came = None
    if n:
        pos, cols, run = step(rows[:n], run)
        at, came = at + n, (pos, cols)
    return at, run, rows[n:], new[told, 0], came


def _fold(step, key_name: str, pos_name: str, outputs: list[str], wait_ms: int, sends_only: bool):
    def out(key, pos, cols, late):
        frame = pd.DataFrame({pos_name: pd.array(pos, dtype="Int64"), **cols})
        frame.insert(0, key_name, [key] * len(frame))
        frame["late"] = late
        return frame

    def fn(key, pdfs, state):
        (key,) = key
        at, run, waiting = 0, [0, 0, 0], _waiting(b"")
        if state.exists:
            at, *run, held = state.get
            waiting = _waiting(held)
        if state.hasTimedOut and len(waiting):
            pos, cols, run = step(waiting, run)
            at, waiting = int(waiting[-1, 0]) + 1, waiting[:0]
            yield out(key, pos, cols, False)
        else:
            for pdf in pdfs:
                new = pdf[list(_FIELDS)].to_numpy(np.int64)
                new = new[np.argsort(new[:, 0], kind="stable")]
                at, run, waiting, late, came = _advance(step, sends_only, at, run, waiting, new)
                if len(late):
                    yield out(key, late, {c: None for c in outputs}, True)
                if came:
                    yield out(key, *came, False)
        state.update((at, *run, waiting.tobytes()))
        if len(waiting):
            state.setTimeoutTimestamp(max(int(waiting[:, 4].min()) + wait_ms, state.getCurrentWatermarkMs() + 1))
    return fn


def _fold_group(step, key_name: str, pos_name: str, outputs: list[str], wait_ms: int, sends_only: bool):
    """:func:`_fold` of all conversations of a hash group in one call; keys are text."""
    def out(parts, late):
        parts = [p for p in parts if len(p[1])]
        if not parts:
            return
        frame = pd.DataFrame({key_name: np.repeat(np.array([k for k, _, _ in parts], object), [len(pos) for _, pos, _ in parts]),
                              pos_name: np.concatenate([pos for _, pos, _ in parts])})
        for c in outputs:
            frame[c] = None if late else np.concatenate([cols[c] for _, _, cols in parts])
        frame["late"] = late
        yield frame

    def fn(group, pdfs, state):
        held = {}
        if state.exists:
            kept = pa.ipc.open_stream(bytes(state.get[0])).read_all().to_pydict()
            for key, at, a, b, c, waiting, timer in zip(*(kept[f.name] for f in _HELD)):
                held[key] = at, [a, b, c], _waiting(waiting), timer
        now, touched = state.getCurrentWatermarkMs(), set()
        for pdf in () if state.hasTimedOut else pdfs:
            number, keys = pd.factorize(pdf["_key"], use_na_sentinel=False)
            rows = pdf[list(_FIELDS)].to_numpy(np.int64)
            order = np.lexsort((rows[:, 0], number))  # stable, as the order of equal positions counts
            rows, number = rows[order], number[order]
            cuts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if len(rows) else []
            came, late = [], []
            for k, new in zip((keys[i] for i in number[cuts]), np.split(rows, cuts[1:])) if len(rows) else ():
                key = None if pd.isna(k) else k
                at, run, waiting, _ = held.get(key) or (0, [0, 0, 0], _waiting(b""), 0)
                at, run, waiting, again, done = _advance(step, sends_only, at, run, waiting, new)
                late.append((key, again, None))
                if done:
                    came.append((key, *done))
                timer = max(int(waiting[:, 4].min()) + wait_ms, now + 1) if len(waiting) else 0
                held[key] = at, run, waiting, timer
                touched.add(key)
            yield from out(late, True)
            yield from out(came, False)
        came = []
        for key, (at, run, waiting, timer) in held.items():
            if timer and timer < now and key not in touched:
                pos, cols, run = step(waiting, run)
                came.append((key, pos, cols))
                held[key] = int(waiting[-1, 0]) + 1, run, waiting[:0], 0
        yield from out(came, False)
        cols = [list(held), *zip(*((at, *run, waiting.tobytes(), timer) for at, run, waiting, timer in held.values()))]
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _HELD) as stream:
            stream.write_batch(pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, _HELD)], schema=_HELD))
        state.update((sink.getvalue().to_pybytes(),))
        timers = [h[3] for h in held.values() if h[3]]
        if timers:
            state.setTimeoutTimestamp(max(min(timers), now + 1))
    return fn


def _stream(turns: DataFrame, step, outputs: list[T.StructField], key: str, pos: str, ts: str, send, watermark: str, wait: str,
            groups: int | None):
    ship_package(turns.sparkSession)
    count = [F.coalesce(F.col(c).cast("bigint"), F.lit(0)) for c in ("input_tokens", "output_tokens")]
    src = turns.withWatermark(ts, watermark).select(
        F.col(key).alias("_key"), ts, F.coalesce(F.col(pos).cast("bigint"), F.lit(-1)).alias("pos"),
        count[0].alias("input"), count[1].alias("output"), F.coalesce(send.cast("bigint"), F.lit(0)).alias("send"),
        F.coalesce(F.unix_millis(F.col(ts)), F.lit(0)).alias("ms"))
    kind = turns.schema[key].dataType
    rest = [T.StructField(pos, T.LongType()), *outputs, T.StructField("late", T.BooleanType())]
    fold = _fold if groups is None else _fold_group
    fn = fold(step, key, pos, [f.name for f in outputs], int(pd.Timedelta(wait).total_seconds() * 1000), step is not _totals)
    if groups is None:
        return src.groupBy("_key").applyInPandasWithState(fn, T.StructType([T.StructField(key, kind), *rest]), SESSION_STATE,
                                                          "append", GroupStateTimeout.EventTimeTimeout)
    # keys as text, so that none changes in pandas (a long beside a null)
    src = src.withColumns({"_group": F.pmod(F.xxhash64("_key"), F.lit(groups)), "_key": F.col("_key").cast("string")})
    told = src.groupBy("_group").applyInPandasWithState(fn, T.StructType([T.StructField(key, T.StringType()), *rest]), GROUP_STATE,
                                                        "append", GroupStateTimeout.EventTimeTimeout)
    return told.withColumn(key, F.col(key).cast(kind))


def stream_totals(turns: DataFrame, key: str = "conv_id", pos: str = "turn", ts: str = "ts",
                  watermark: str = "10 minutes", wait: str = "1 hour", groups: int | None = SESSION_GROUPS) -> DataFrame:
    """I5 on a stream: running input and output tokens and message count after
    each turn. Null token counts are 0. ``groups``: hash groups of conversations that
    share a call; None: one state a conversation, for batches that touch few of very many."""
    longs = [T.StructField(n, T.LongType()) for n in ("total_input_tokens", "total_output_tokens", "message_count")]
    return _stream(turns, _totals, longs, key, pos, ts, F.lit(True), watermark, wait, groups)


def stream_compaction(turns: DataFrame, tokens: int | None = None, messages: int | None = None, key: str = "conv_id",
                      pos: str = "turn", ts: str = "ts", send=None, watermark: str = "10 minutes", wait: str = "1 hour",
                      groups: int | None = SESSION_GROUPS) -> DataFrame:
    """I6 on a stream: one row a send, with its number, the tokens so far,
    whether a summary follows and the messages left; late turns only where they
    are sends. ``turns`` are all turns of a conversation (positions must have no gap); ``send`` says which of them are
    sends (default: all); ``groups`` as in :func:`stream_totals`."""
    fields = [T.StructField("send_no", T.LongType()), T.StructField("cum_tokens", T.LongType()),
              T.StructField("fired", T.BooleanType()), T.StructField("messages_left", T.LongType())]
    return _stream(turns, _compaction(tokens, messages), fields, key, pos, ts, F.lit(True) if send is None else send, watermark, wait, groups)
