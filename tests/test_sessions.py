"""Session totals and compaction points on a stream (I5, I6) against their batch forms."""

import random

import numpy as np
import pandas as pd
import pytest

from searchlake.streaming import sessions as Z


class State:
    """What the fold uses of a group state."""

    def __init__(self):
        self.value, self.timeout, self.hasTimedOut, self.watermark = None, None, False, 0

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def setTimeoutTimestamp(self, ms):
        self.timeout = ms

    def getCurrentWatermarkMs(self):
        return self.watermark


def _frame(rows):
    return pd.DataFrame(rows, columns=list(Z._FIELDS))


def _run(fn, state, *frames):
    parts = [p for p in fn(("c",), iter([_frame(f) for f in frames]), state)]
    return pd.concat([p.astype(object) for p in parts]) if parts else pd.DataFrame()


def _naive(rows, tokens, messages):
    out, cum, msgs, k = [], 0, 0, 0
    for pos, i, o, send, _ in sorted(rows):
        if not send:
            continue
        k, cum, msgs = k + 1, cum + i + o, msgs + 2
        fired = ((tokens is not None and cum >= tokens) or (messages is not None and msgs >= messages)) and msgs > 2
        msgs = 1 if fired else msgs
        out.append((pos, k, cum, fired, msgs))
    return out


@pytest.mark.parametrize("tokens,messages", [(None, None), (100, None), (None, 2), (None, 5), (120, 4), (1, 1)])
def test_compaction_is_the_fold_for_any_cut(tokens, messages):
    rng = random.Random(7)
    for _ in range(30):
        rows = [(p, rng.randrange(12), rng.randrange(12), int(rng.random() < 0.6), 0) for p in range(rng.randrange(1, 40))]
        mixed = rng.sample(rows, len(rows))
        fn, state, got = Z._fold(Z._compaction(tokens, messages), "k", "pos", ["send_no", "cum_tokens", "fired", "messages_left"], 1000, True), State(), []
        while mixed:
            n = rng.randrange(1, 9)
            part, mixed = mixed[:n], mixed[n:]
            out = _run(fn, state, part[: n // 2], part[n // 2:])
            if len(out):
                got += out[["pos", "send_no", "cum_tokens", "fired", "messages_left"]].values.tolist()
        assert [tuple(r) for r in got] == _naive(rows, tokens, messages)
        assert state.value[0] == len(rows) and not state.value[4]


def test_totals_wait_for_a_gap_and_go_on_without_it_at_the_timeout():
    fn, state = Z._fold(Z._totals, "k", "pos", ["total_input_tokens", "total_output_tokens", "message_count"], 1000, False), State()
    first = _run(fn, state, [(0, 1, 2, 1, 50), (2, 3, 4, 1, 70), (3, 5, 6, 1, 60)])
    assert first["pos"].tolist() == [0] and state.timeout == 1060
    state.hasTimedOut = True
    rest = _run(fn, state)
    assert rest[["pos", "total_input_tokens", "total_output_tokens", "message_count"]].values.tolist() == [[2, 4, 6, 2], [3, 9, 12, 3]]
    state.hasTimedOut = False
    late = _run(fn, state, [(1, 9, 9, 1, 55), (-1, 1, 1, 1, 0), (4, 1, 1, 1, 80), (4, 8, 8, 1, 80)])
    assert sorted(late[late["late"].astype(bool)]["pos"].tolist()) == [-1, 1, 4]
    ok = late[~late["late"].astype(bool)]
    assert ok[["pos", "total_input_tokens", "message_count"]].values.tolist() == [[4, 10, 4]]


def test_a_turn_that_comes_twice_while_it_waits_counts_once():
    fn, state = Z._fold(Z._totals, "k", "pos", ["total_input_tokens", "total_output_tokens", "message_count"], 1000, False), State()
    assert not len(_run(fn, state, [(1, 5, 5, 1, 0)]))
    twice = _run(fn, state, [(1, 7, 7, 1, 0)])
    assert twice["late"].tolist() == [True]
    done = _run(fn, state, [(0, 1, 1, 1, 0)])
    assert done["total_input_tokens"].tolist() == [1, 6]
    assert np.frombuffer(state.value[4], np.int64).size == 0


@pytest.mark.parametrize("seed", range(4))
def test_a_group_of_conversations_is_folded_as_each_alone(seed):
    """One call a hash group emits what a call a conversation does: gaps, late and double turns, timeouts, a null key."""
    rng = random.Random(seed)
    for step, outputs, sends in ((Z._totals, ["total_input_tokens", "total_output_tokens", "message_count"], False),
                                 (Z._compaction(60, 4), ["send_no", "cum_tokens", "fired", "messages_left"], True)):
        args = (step, "k", "pos", outputs, 1000, sends)
        keys = [None, "9007199254740993", "b", "c"]
        turns = [(k, p, rng.randrange(12), rng.randrange(12), int(rng.random() < 0.6), rng.randrange(900))
                 for k in keys for p in range(-1, 25) if rng.random() < 0.9]
        turns += rng.sample(turns, 8)
        rng.shuffle(turns)
        alone, grouped, states, group = [], [], {k: State() for k in keys}, State()
        each, together = Z._fold(*args), Z._fold_group(*args)
        batches = [turns[i:i + 15] for i in range(0, len(turns), 15)] + [[]]
        for now, batch in enumerate(batches):
            now = 400 * now if batch else 1_000_000
            for k in keys:
                mine, state = [t[1:] for t in batch if t[0] == k], states[k]
                state.watermark, state.hasTimedOut = now, not mine and state.timeout is not None and state.timeout < now
                if mine or state.hasTimedOut:
                    state.timeout = None
                    for f in each((k,), iter([_frame(mine)]), state):
                        alone += f.astype(object).where(f.notna(), None).values.tolist()
            group.watermark, group.hasTimedOut = now, not batch
            frame = pd.DataFrame(batch, columns=["_key", *Z._FIELDS])
            for f in together((0,), iter([frame]), group):
                grouped += f.astype(object).where(f.notna(), None).values.tolist()
        assert sorted(map(str, grouped)) == sorted(map(str, alone)) and len(alone) > 40


def test_calls_follow_groups_not_conversations(spark):
    from pyspark.sql import functions as F
    turns = spark.readStream.format("rate").load().select(F.col("value").alias("conv_id"), F.col("value").alias("turn"),
                                                          F.col("value").alias("input_tokens"), F.col("value").alias("output_tokens"),
                                                          F.col("timestamp").alias("ts"))
    for stream in (Z.stream_totals(turns), Z.stream_compaction(turns, 10, 4)):
        plan = stream._jdf.queryExecution().analyzed().toString()
        assert "pmod(xxhash64(_key" in plan and stream.schema["conv_id"].dataType.simpleString() == "bigint"
