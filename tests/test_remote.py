"""Calls to a remote service: order, width, look-ahead, retries, errors."""

import asyncio
import threading
import time

import pytest

from tapeloom.schema import Settings
from tapeloom.sources import adapters
from tapeloom.sources.pool import Calls, Transient, ordered


class Service:
    """Counts calls under way; later items answer sooner."""

    def __init__(self, fails=()):
        self.lock, self.now, self.most, self.tries, self.fails = threading.Lock(), 0, 0, {}, dict(fails)

    def enter(self, x):
        with self.lock:
            self.now += 1
            self.most = max(self.most, self.now)
            self.tries[x] = self.tries.get(x, 0) + 1

    def leave(self, x):
        with self.lock:
            self.now -= 1
        if self.tries[x] <= self.fails.get(x, (0, None))[0]:
            raise self.fails[x][1]
        return x * 10

    def __call__(self, x):
        self.enter(x)
        time.sleep(0.002 * (20 - x % 20) / 4)
        return self.leave(x)

    async def later(self, x):
        self.enter(x)
        await asyncio.sleep(0.002 * (20 - x % 20) / 4)
        return self.leave(x)


FAILS = {3: (1, Transient("busy")), 5: (9, ConnectionError("gone")), 7: (9, KeyError("k")), 11: (2, TimeoutError("slow"))}


@pytest.mark.parametrize("width", [1, 4])
@pytest.mark.parametrize("kind", ["plain", "coroutine"])
def test_same_rows_at_any_width(width, kind):
    s = Service(FAILS)
    got = list(ordered(s if kind == "plain" else s.later, ((i, i) for i in range(30)), Calls(width=width, retries=2, pause=0.001)))
    assert [g[0] for g in got] == list(range(30))
    assert {g[0]: g[2] for g in got if g[2]} == {5: "ConnectionError: gone", 7: "KeyError: 'k'"}
    assert [g[1] for g in got] == [None if i in (5, 7) else i * 10 for i in range(30)]
    assert s.most == width
    assert {k: s.tries[k] for k in (3, 5, 7, 11, 12)} == {3: 2, 5: 3, 7: 1, 11: 3, 12: 1}


def test_look_ahead_is_bounded():
    taken = []

    def items():
        for i in range(50):
            taken.append(i)
            yield i, i

    results = ordered(Service(), items(), Calls(width=2, ahead=5))
    for n in range(10):
        next(results)
        assert len(taken) <= n + 5
    results.close()
    assert len(taken) < 20


def test_pauses_and_limits():
    how = Calls(pause=0.5, longest_pause=3)
    assert all(0.25 * 2**k <= how.wait(k, Transient()) <= 0.5 * 2**k for k in range(3))
    assert how.wait(20, Transient()) <= 3 and how.wait(0, Transient("busy", after=7)) == 7

    async def slow(x):
        await asyncio.sleep(x)
        return x

    got = list(ordered(slow, iter([("a", 0.0), ("b", 5.0)]), Calls(timeout=0.05, retries=1, pause=0.001)))
    assert got[0] == ("a", 0.0, None) and got[1][2].startswith("TimeoutError")
    for wrong in ({"width": 0}, {"width": 4, "ahead": 3}, {"retries": -1}):
        with pytest.raises(ValueError):
            Calls(**wrong)


BODIES = {1: '{"text": "t", "segments": [{"text": "a"}]}', 2: '{"text": "t", "segm', 3: "[]", 4: '{"segments": null}', 5: '{"segments": [1]}', 6: '{"text": "no segments"}', 7: ""}


def test_answers_that_cannot_be_read(spark):
    rows = spark.createDataFrame([(i, bytearray(b.encode())) for i, b in BODIES.items()], "transcript_id long, content binary").coalesce(1)

    def make():
        async def client(content):
            await asyncio.sleep(0.01 * (content[:1] == b"{"))
            return content.decode()

        return client

    for width in (1, 4):
        got = adapters.responses(rows, make, Settings(calls=Calls(width=width))).collect()
        assert [r.transcript_id for r in got] == list(BODIES)
        assert {r.transcript_id: r.body for r in got if r.body is not None} == {i: BODIES[i] for i in (1, 6)}
        errors = {r.transcript_id: r.error for r in got if r.error}
        assert {i: e.split(":")[0] for i, e in errors.items()} == {2: "JSONDecodeError", 3: "ValueError", 4: "ValueError", 5: "ValueError", 7: "JSONDecodeError"}


def test_contents_become_objects_one_at_a_time(spark):
    """Not a whole batch at once; so a null one is the error of its item alone."""
    rows = spark.createDataFrame([(1, bytearray(b"a\nb")), (2, None), (3, bytearray(b"c"))], "transcript_id long, content binary").coalesce(1)
    got = {r.transcript_id: (r.body is None, r.error) for r in adapters.responses(rows, adapters.line_client, Settings(use_remote=True)).collect()}
    assert got[1] == got[3] == (False, None) and got[2][0] and got[2][1].startswith("AttributeError")
