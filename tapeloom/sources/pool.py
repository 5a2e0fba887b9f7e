"""Calls to a remote service from one task: several under way at once, results in order, retries with back-off.

``ordered`` takes items one by one, never more than ``ahead`` before the result that is next, so that a task
holds a bounded number of contents; never more than ``width`` calls are under way. A call may be a plain
function, which then runs in a thread, or a coroutine function, which runs on the event loop. Calls that fail
in a way that may pass are tried again after a pause that doubles each time; a pause holds no place among the
``width``. What fails for good is the item's own error.
"""

from __future__ import annotations

import asyncio
import inspect
import random
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from tapeloom.shipping import ship

ship(__name__)


class Transient(Exception):
    """A failure that may pass, such as a limit of rates or a server that is busy. ``after``: seconds to wait at least, if the service tells."""

    def __init__(self, message: str = "", after: float | None = None):
        super().__init__(message)
        self.after = after


@dataclass(frozen=True)
class Calls:
    """How calls are made."""

    width: int = 4
    #: Items taken before the result that is next; None: twice the width.
    ahead: int | None = None
    #: Tries after the first.
    retries: int = 3
    #: Seconds before the second try; then twice as long each time, up to ``longest_pause``.
    pause: float = 0.5
    longest_pause: float = 30.0
    #: Seconds for one try; None: no limit.
    timeout: float | None = None
    transient: tuple[type[Exception], ...] = (Transient, ConnectionError, TimeoutError)

    def __post_init__(self):
        if self.width < 1 or (self.ahead is not None and self.ahead < self.width) or self.retries < 0:
            raise ValueError(f"calls can't be made so: {self}")

    def wait(self, tried: int, error: Exception) -> float:
        """Seconds before the next try: half fixed, half by chance, so that tasks do not come back together."""
        pause = min(self.longest_pause, self.pause * 2**tried)
        return max(pause / 2 + random.random() * pause / 2, getattr(error, "after", None) or 0)


def described(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"


def ordered(call: Callable, items: Iterator[tuple[Any, Any]], how: Calls = Calls()) -> Iterator[tuple[Any, Any, str | None]]:
    """(key, result, error) of each (key, argument), in the order of ``items``."""
    loop = asyncio.new_event_loop()
    threads = ThreadPoolExecutor(how.width)
    gate = asyncio.Semaphore(how.width)
    is_async = inspect.iscoroutinefunction(call) or inspect.iscoroutinefunction(getattr(call, "__call__", None))

    async def once(argument):
        work = call(argument) if is_async else loop.run_in_executor(threads, call, argument)
        return await (work if how.timeout is None else asyncio.wait_for(work, how.timeout))

    async def one(key, argument):
        for tried in range(how.retries + 1):
            try:
                async with gate:
                    return key, await once(argument), None
            except how.transient as e:
                if tried == how.retries:
                    return key, None, described(e)
                pause = how.wait(tried, e)
            except Exception as e:  # an item's failure is its own
                return key, None, described(e)
            await asyncio.sleep(pause)

    pending: deque = deque()
    most = how.ahead or 2 * how.width
    try:
        for key, argument in items:
            pending.append(loop.create_task(one(key, argument)))
            if len(pending) >= most:
                yield loop.run_until_complete(pending.popleft())
        while pending:
            yield loop.run_until_complete(pending.popleft())
    finally:  # also where the reader of the results stops early
        for task in pending:
            task.cancel()
        if pending:
            loop.run_until_complete(asyncio.gather(*pending, return_exceptions=True))
        threads.shutdown(wait=True, cancel_futures=True)
        loop.close()
