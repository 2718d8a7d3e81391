"""The stream processors' release logic against the plain state machine,
driven directly (no Spark) with a minimal in-memory state handle."""

import os

from hypothesis import given, settings
from hypothesis import strategies as st

from flowstat.streaming.stateful import BurstProcessor

SETTINGS = settings(max_examples=400 if os.environ.get("FLOWSTAT_EXPLORE") else 150, deadline=None,
                    derandomize=not os.environ.get("FLOWSTAT_EXPLORE"))


class _Value:
    def __init__(self):
        self.v = None

    def exists(self):
        return self.v is not None

    def get(self):
        return self.v

    def update(self, v):
        self.v = tuple(v)

    def clear(self):
        self.v = None


class _Handle:
    def getValueState(self, name, schema):
        return _Value()

    def registerTimer(self, ms):
        pass


def _machine(rows, w, min_count):
    out, cur = [], None
    for t, _, fail, reset in rows:
        if cur and t > cur[0] + w:
            if cur[1] >= min_count:
                out.append((cur[0], cur[2], cur[1]))
            cur = None
        if fail:
            cur = (t, 1, t) if cur is None else (cur[0], cur[1] + 1, t)
        elif reset:
            cur = None
    if cur and cur[1] >= min_count:
        out.append((cur[0], cur[2], cur[1]))
    return out


@SETTINGS
@given(events=st.lists(st.tuples(st.integers(0, 40), st.sampled_from(["f", "r", "x"])), max_size=40),
       w=st.integers(0, 8), min_count=st.integers(1, 3), cuts=st.lists(st.integers(0, 40), max_size=4))
def test_burst_release_matches_state_machine(events, w, min_count, cuts):
    rows = sorted((t * 1000, i, e == "f", e == "r") for i, (t, e) in enumerate(events))
    proc = BurstProcessor(w * 1000, min_count)
    proc.init_carry(_Handle())
    proc.handle = _Handle()
    got, start = [], 0
    for c in sorted(set(min(c, len(rows)) for c in cuts)) + [len(rows)]:
        # release in pieces, as successive timer firings would; the watermark is below later rows
        wm = rows[c][0] if c < len(rows) else 10 ** 12
        got += [(a, b, n) for _, a, b, n in proc.release((7,), rows[start:c], wm)]
        start = c
    assert got == _machine(rows, w * 1000, min_count)
