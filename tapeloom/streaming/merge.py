"""ST2: M1 over a stream of segments, in any order, over as many micro-batches as they take.

Each transcript has two pieces of typed state: a value with what M1 carries (text, offset, first start, sum
and number of log probabilities, and the ``seq`` that comes next), and a map from ``seq`` to the segments that
came before their turn. A segment is folded as soon as all before it are. With ``patience_s`` a transcript
that waits for a segment sets a timer; if nothing of it is folded for so long, it goes on with the first
segment that is there, and leaves the gap. Timers of processing time keep a query going, so ``patience_s`` is
for streams that run on; one with ``availableNow`` would never end, and holds early segments in its state.
A segment whose place was passed, because a gap was left or because it came twice, is given out as it came,
with ``late``, and is not folded: what was given out stays.

Confidence needs a transcript's whole range, so the stream gives running means; ``with_confidence``
normalises when a transcript is complete. State lives in RocksDB, which ``merge_stream`` asks the session for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tapeloom.functions import numbers, text
from tapeloom.operators.segments import logprob_range
from tapeloom.shipping import ship

ship(__name__)

OUT = "transcript_id long, seq long, pos int, sentence string, start_char_count long, end_char_count long, time_start double, time_end double, running_logprob double, late boolean"
NAMES = [f.split()[0] for f in OUT.split(", ")]
#: ``waiting``: how many segments the map holds, so that it is not asked in vain.
CARRIED = "carry string, upto long, time_start double, total double, n long, next long, waiting long"
EARLY = "start double, end double, text string, avg_logprob double"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Fixed values, as in functions.text.
_HYPHEN = re.compile(r"-\n(?=[a-z])")
_LINE = re.compile(r"(?<=[^\W\d])\n(?![\nA-Z])")
_END = re.compile(r"\.(?!\s*(?:com|net|org|io)\s)(?![0-9])|[.!?]\s+")
_MARK, _ESCAPES = text.MARK, text.ESCAPES


def split_sentences(t: str) -> list[str]:
    """T3 in Python, for stateful code."""
    if escaped := _MARK in t:
        for char, instead in _ESCAPES.items():
            t = t.replace(char, instead)
    parts = _END.sub(_MARK, _LINE.sub(" ", _HYPHEN.sub("", t))).split('"')
    parts[1::2] = [p.replace(_MARK, "") for p in parts[1::2]]
    found = [s for p in '"'.join(parts).split(_MARK) if (s := p.strip())]
    if escaped:
        for char, instead in reversed(_ESCAPES.items()):
            found = [s.replace(instead, char) for s in found]
    return found


class Merge(StatefulProcessor):
    """Folds a transcript's segments in order of ``seq``, from ``first_seq`` on."""

    def __init__(self, first_seq: int, patience_ms: int | None):
        self.first_seq, self.patience_ms = first_seq, patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.carried = handle.getValueState("carried", CARRIED)
        self.early = handle.getMapState("early", "seq long", EARLY)

    def _fold(self, i: int, state: list, seq: int, segment: tuple, out: list) -> None:
        carry, upto, first, total, n, _, waiting = state
        start, end, words, logprob = segment
        first = start if n == 0 else first
        total, n = total + logprob, n + 1
        buffer = carry + words + " "
        found = split_sentences(buffer)
        for pos, sentence in enumerate(found):
            upto += len(sentence) + 1
            out.append((i, seq, pos, sentence, upto - len(sentence) - 1, upto - 2, first, end, total / n, False))
        if found:
            carry = found[-1] if len(found) % 2 else ""
        else:
            carry = buffer
        state[:] = carry, upto, first, total, n, seq + 1, waiting

    def _state(self) -> list:
        return list(self.carried.get() or ("", 0, None, 0.0, 0, self.first_seq, 0))

    def _drain(self, i: int, state: list, held: dict, out: list) -> None:
        """Folds the segments whose turn it is, from those of this batch or the map."""
        while True:
            key = (state[5],)
            if state[5] in held:
                self._fold(i, state, state[5], held.pop(state[5]), out)
            elif state[6] and self.early.containsKey(key):
                segment = tuple(self.early.getValue(key))
                self.early.removeKey(key)
                state[6] -= 1
                self._fold(i, state, key[0], segment, out)
            else:
                return

    def _wait(self, folded: bool, waits: bool, timer_values) -> None:
        if self.patience_ms is None:
            return
        timers = list(self.handle.listTimers())
        if folded or not waits:
            for t in timers:
                self.handle.deleteTimer(t)
            timers = []
        if waits and not timers:
            self.handle.registerTimer(timer_values.getCurrentProcessingTimeInMs() + self.patience_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        i, state, out = key[0], self._state(), []
        held: dict[int, tuple] = {}
        before = state[5]
        for frame in rows:
            for s in frame.itertuples(index=False):
                seq, segment = int(s.seq), (s.start, s.end, s.text, s.avg_logprob)
                if seq < before or seq in held or (state[6] and self.early.containsKey((seq,))):
                    out.append((i, seq, None, s.text, None, None, s.start, s.end, s.avg_logprob, True))
                else:
                    held[seq] = segment
        self._drain(i, state, held, out)
        for seq, segment in held.items():
            self.early.updateValue((seq,), segment)
        state[6] += len(held)
        self.carried.update(tuple(state))
        self._wait(state[5] != before, state[6] > 0, timerValues)
        yield pd.DataFrame(out, columns=NAMES).astype({"pos": "Int32", "start_char_count": "Int64", "end_char_count": "Int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state, out = self._state(), []
        waiting = sorted(k[0] for k in self.early.keys())
        if waiting:
            state[5] = waiting[0]
            self._drain(key[0], state, {}, out)
            self.carried.update(tuple(state))
            self._wait(False, state[6] > 0, timerValues)
        yield pd.DataFrame(out, columns=NAMES).astype({"pos": "Int32", "start_char_count": "Int64", "end_char_count": "Int64"})

    def close(self) -> None:
        pass


def merge_stream(segments: DataFrame, first_seq: int = 0, patience_s: float | None = None) -> DataFrame:
    """Sentences of a stream of segments, as M1 but with running_logprob in place of confidence, and ``late`` segments as they came."""
    segments.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return segments.groupBy("transcript_id").transformWithStateInPandas(
        Merge(first_seq, None if patience_s is None else int(patience_s * 1000)), OUT, "Append", "None" if patience_s is None else "ProcessingTime"
    )


def with_confidence(merged: DataFrame, segments: DataFrame) -> DataFrame:
    """The confidence of complete transcripts, as a batch, of the rows that are not late."""
    rows = merged.where("not late").drop("late").join(logprob_range(segments), "transcript_id")
    score = numbers.confidence(F.col("running_logprob"), F.col("min_logprob"), F.col("max_logprob"))
    return rows.withColumn("model_confidence_score", score).drop("running_logprob", "min_logprob", "max_logprob")
