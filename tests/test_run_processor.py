"""The run and cap processors driven with stand-in state: any n, and bounded buffers."""

import datetime as dt
from types import SimpleNamespace

import pytest

from eventide.streaming.processors import CapProcessor, ConsecutiveRunProcessor


class State:
    def __init__(self):
        self.v = None

    def exists(self):
        return bool(self.v)

    def get(self):
        return iter(self.v) if isinstance(self.v, list) else self.v

    def put(self, v):
        self.v = list(v)

    def appendValue(self, v):
        self.v = [*(self.v or []), v]

    def appendList(self, v):
        self.v = [*(self.v or []), *v]

    def update(self, v):
        self.v = v

    def clear(self):
        self.v = None


class Handle:
    def __init__(self):
        self.timers = set()

    def getListState(self, name, schema):
        return State()

    getValueState = getListState

    def registerTimer(self, t):
        self.timers.add(t)

    def deleteTimer(self, t):
        self.timers.discard(t)


def at(i):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)


def micros(t):
    return int((t - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000


def times(wm):
    return SimpleNamespace(getCurrentWatermarkInMs=lambda: wm)


@pytest.mark.parametrize("n", range(1, 11))
def test_runs_of_any_length_one_row_at_a_time(n):
    states = ["fail"] * 20 + ["success"] + ["fail"] * 9
    p = ConsecutiveRunProcessor(n)
    p.init(Handle())
    out = []
    for i, s in enumerate(states):
        p.handleInputRows((1,), [SimpleRow(at(i), i, s)], times(0))
        out += p.handleExpiredTimer((1,), times(10 ** 15), None)
    want = sum(states[i - n + 1:i + 1] == ["fail"] * n for i in range(n - 1, len(states)))
    assert len(out) == want
    assert all((r.last_fail_ts - r.first_fail_ts).total_seconds() == n - 1 for r in out)


class SimpleRow:
    def __init__(self, ts, seq, login_state):
        self.t, self.seq, self.login_state = micros(ts), seq, login_state

    def __getitem__(self, k):
        return getattr(self, k)


def test_cap_state_stays_bounded():
    p = CapProcessor(cap=5)
    p.init(Handle())
    click = [SimpleNamespace(t=micros(at(i)), seq=i, province="p", city="c") for i in range(1000)]
    p.handleInputRows((1, 2, dt.date(2024, 1, 1)), click[::-1], times(0))
    assert len(p.buf.v) == 6 and [x[1] for x in sorted(p.buf.v)] == list(range(6))
    expired = SimpleNamespace(getExpiryTimeInMs=lambda: 0)
    out = list(p.handleExpiredTimer((1, 2, dt.date(2024, 1, 1)), times(10 ** 15), expired))
    assert [r.channel for r in out] == ["main"] * 5 + ["blacklist"]
    p.handleInputRows((1, 2, dt.date(2024, 1, 1)), click[10:], times(0))
    assert not p.buf.exists()


def test_work_per_event_does_not_grow_with_the_buffer():
    """10,000 events of one key: one timer, the buffer read once per watermark step."""
    class Counting(State):
        reads = 0

        def get(self):
            Counting.reads += len(self.v) if isinstance(self.v, list) else 0
            return super().get()

    class CountingHandle(Handle):
        def getListState(self, name, schema):
            return Counting()

    h = CountingHandle()
    p = ConsecutiveRunProcessor(2)
    p.init(h)
    class R(dict):
        __getattr__ = dict.__getitem__

    rows = [R(t=micros(at(i)), seq=i, login_state="fail") for i in range(10_000)]
    list(p.handleInputRows((1,), iter(rows), times(0)))
    assert len(h.timers) == 1
    out = []
    while h.timers and (due := min(h.timers)) <= 2 * 10 ** 12:
        h.timers.discard(due)
        out += list(p.handleExpiredTimer((1,), times(2 * 10 ** 12), SimpleNamespace(getExpiryTimeInMs=lambda: due)))
    assert len(out) == 9_999 and Counting.reads <= 10_000
