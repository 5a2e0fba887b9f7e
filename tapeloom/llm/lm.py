"""Operator 6, language-model scoring: a log-frequency Bloom filter of quantised n-gram counts.

Words and pairs of words are counted over the training texts. A count c has level 1 + floor(log2 c);
the filter holds (n-gram, 1), ..., (n-gram, level), so probing levels 1, 2, ... until one is missing
gives the level back, never too low. The model interpolates pair counts with smoothed word counts,
all from the filter.

The filter has one byte for each training token, in blocks of ``BLOCK`` bytes that are filled by the
tasks that the block's n-grams are dealt to. It is broadcast if it has at most ``BROADCAST`` bytes. A larger
one stays where it is: runs of texts deal their distinct n-grams to the parts of the filter, and the
levels come back to the runs, so the work stays linear in the input and no task holds more than a part.

The base score needs exact counts: words that make up at least one in ``FREQUENT`` training tokens,
hence at most as many words, are broadcast with their counts; the others are joined to theirs.

Defined results: null and empty texts have one token, the end; a null id is training; ids, null or
repeated, are carried as they are and each row is scored; with no training text both counts N and V
are zero; an empty table gives no rows; columns other than the id and the text are not looked at.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import ASCII_LOWER, ship, written

ship(__name__)

FOLDS, HELD_OUT = 5, 1
FREQUENT = 131_072
BLOCK = 1 << 16
#: A filter of more bytes is not broadcast but probed in parts of about ``PART`` bytes.
BROADCAST = 1 << 27
PART = 1 << 22
PROBES = 3
PRIOR = 10.0
SEED = 7
#: The end token, as a word that no text has.
END = b""
#: n-grams, or tokens, that a task holds at once.
HELD = 1_500_000
CHUNK = 400_000
#: Training tokens for each run of texts that asks parts of the filter: long runs ask for a frequent n-gram less often.
RUN = 1_200_000
#: Words of more bytes are hashed one by one.
LONG = 128

#: The bits of an n-gram and level lie in one line of memory: probing costs one access.
_LINE = 512
_LINES = np.uint64(BLOCK * 8 // _LINE)
_LOW = np.uint64((1 << 40) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(before * np.uint64(0x9E3779B97F4A7C15) + mix(word))


def tokens_of(text: str | None) -> list[bytes]:
    return [*(text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split(), END]


def block_of(keys: np.ndarray, n_blocks: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(n_blocks)) >> np.uint64(32)


def hash_of(low: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(low + np.uint64(level) * np.uint64(0xD1342543DE82EF95))


def bit_at(h: np.ndarray, probe: int) -> np.ndarray:
    """Bit position of a probe in the block."""
    return (((h >> np.uint64(32)) * _LINES >> np.uint64(32)) * np.uint64(_LINE) + ((h >> np.uint64(9 * probe)) & np.uint64(_LINE - 1))).astype(np.int64)


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(float))[1]


#: The count that a level stands for; level 0 is none.
COUNT_OF = np.array([0.0, 1.0, *[1.5 * 2.0 ** (q - 1) for q in range(2, 64)]])


class Filter:
    """Some consecutive blocks of the filter."""

    def __init__(self, first: int, data: np.ndarray, n_blocks: int):
        self.first, self.data, self.n_blocks = first, data, n_blocks

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each key; all of them must belong to these blocks."""
        return self.probe(block_of(keys, self.n_blocks).astype(np.int64) - self.first, keys & _LOW)

    def probe(self, block: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Level of each key by its block, counted from the first one here, and its low bits."""
        out = np.zeros(len(low), np.uint8)
        alive, base = np.arange(len(low)), block * BLOCK
        level = 0
        while len(alive):
            level += 1
            h = hash_of(low, level)
            for i in range(PROBES):  # most absent keys fail at the first probe
                p = bit_at(h, i)
                byte = self.data[base + (p >> 3)]
                held = np.flatnonzero((byte >> (p & 7).astype(np.uint8)) & np.uint8(1))
                alive, base, low, h = alive[held], base[held], low[held], h[held]
            out[alive] = level
        return out


def fill_block(low: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bytes of a block, from the low bits of its keys and their counts."""
    low, at = np.unique(low, return_inverse=True)
    level = level_of(np.bincount(at, counts, minlength=len(low)))
    bits = np.zeros(BLOCK * 8, bool)
    for q in range(1, int(level.max(initial=0)) + 1):
        h = hash_of(low[level >= q], q)
        for i in range(PROBES):
            bits[bit_at(h, i)] = True
    return np.packbits(bits, bitorder="little")


def _word_counts(batches):
    def rows(n):
        return pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for w in n], pa.string()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    n: Counter = Counter()
    for b in batches:
        for t in b.column(0).to_pylist():
            n.update(tokens_of(t))
            if len(n) >= CHUNK:
                yield rows(n)
                n = Counter()
    if n:
        yield rows(n)


_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
#: Keeps the first bytes of eight.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of pieces of ``data``, eight bytes of all of them at a time."""
    import xxhash

    size = ends - starts
    eights = np.ndarray(len(data) + 1, "<u8", data + bytes(8), strides=(1,))
    out = mix(size.astype(np.uint64) + np.uint64(SEED))
    alive, at = np.flatnonzero((size > 0) & (size <= LONG)), 0
    while len(alive):
        left = size[alive] - at
        with np.errstate(over="ignore"):
            part = eights[starts[alive] + at] & _FIRST[np.minimum(left, 8)]
            out[alive] = mix(out[alive] * np.uint64(0x9E3779B97F4A7C15) + part)
        alive, at = alive[left > 8], at + 8
    for i in np.flatnonzero(size > LONG):
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]], SEED)
    return out


def word_hashes(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    return _hashes(b"".join(words), np.append(0, ends)[:-1], ends)


_END_HASH = word_hashes([END])[0]


def shifted(x: np.ndarray) -> np.ndarray:
    """What stands before each token. Every text ends with the end token, so each one has it before its first; the run's last one stands in for the first text's."""
    return np.concatenate([x[-1:], x[:-1]])


def distinct(x: np.ndarray) -> np.ndarray:
    """In order; a plain sort takes a tenth of the time of ``np.unique``."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])[: len(x)]]


class Run:
    """Tokens of some texts, as bytes, one after the other, and their hashes; no token is an object of its own."""

    def __init__(self, texts: list[bytes]):
        self.data = b"\n".join([b"", *texts, b""]).translate(ASCII_LOWER)
        space = _SPACE[np.frombuffer(self.data, np.uint8)]
        turns = np.flatnonzero(space[1:] != space[:-1]) + 1
        self.begin, self.end = turns[::2], turns[1::2]
        after = np.searchsorted(self.begin, np.cumsum([len(t) + 1 for t in texts]))  # words up to each text's end
        self.sizes = np.diff(after, prepend=0) + 1
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.hashes = np.insert(_hashes(self.data, self.begin, self.end), after, _END_HASH)

    def pairs(self) -> np.ndarray:
        return pair_keys(shifted(self.hashes), self.hashes)

    def words(self, tokens: np.ndarray, texts: np.ndarray) -> list[str]:
        """The given tokens of the given texts; the end is the empty word."""
        is_end = tokens == self.starts[texts] + self.sizes[texts] - 1
        at = tokens - texts  # each text before has one end
        begin, end = (np.where(is_end, 0, np.append(x, 0)[at]).tolist() for x in (self.begin, self.end))
        return [self.data[b:e].decode("utf-8", "replace") for b, e in zip(begin, end)]


def _bytes(texts: pa.Array) -> list[bytes]:
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def _runs(texts: list[bytes], most: int = 6 * CHUNK):
    """Runs of up to about ``most`` bytes."""
    held, n = [], 0
    for t in texts:
        held.append(t)
        n += len(t) + 1
        if n >= most:
            yield Run(held)
            held, n = [], 0
    if held:
        yield Run(held)


def _blobs(rows: np.ndarray, begin: np.ndarray) -> pa.Array:
    """The bytes of consecutive rows, cut where ``begin`` says."""
    size = rows.nbytes // max(len(rows), 1)
    offsets = pa.array(np.append(begin, len(rows)) * size, pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(begin), [None, offsets.buffers()[1], pa.py_buffer(rows.tobytes())])


def _packed(keys: np.ndarray, n: np.ndarray, n_blocks: int) -> pa.RecordBatch:
    """Sorted keys and their counts as (block, 6 bytes for each: low bits of the key, count)."""
    times = -(-n // 255)  # a byte holds counts to 255, larger ones take several rows
    last = n - 255 * (times - 1)
    at = np.repeat(np.arange(len(keys)), times)
    count = np.full(len(at), 255)
    count[np.cumsum(times) - 1] = last
    keys = keys[at]
    block = block_of(keys, n_blocks).astype(np.int64)
    packed = np.empty((len(keys), 6), np.uint8)
    packed[:, :5] = (keys & _LOW).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    packed[:, 5] = count
    begin = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    return pa.RecordBatch.from_arrays([pa.array(block[begin]), _blobs(packed, begin)], names=["block", "grams"])


def _pack_words(n_blocks: int):
    """Words with their counts, packed."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            keys = mix(word_hashes([w.encode() for w in b.column(0).to_pylist()]))
            order = np.argsort(keys)
            yield _packed(keys[order], b.column(1).to_numpy()[order], n_blocks)

    return run


def _pack_pairs(n_blocks: int):
    """Pairs of a task's texts, counted and packed."""

    def run(batches):
        held, n = [], 0
        for b in batches:
            for x in _runs(_bytes(b.column(0))):
                held.append(x.pairs())
                n += len(held[-1])
                if n >= HELD:
                    yield _packed(*np.unique(np.concatenate(held), return_counts=True), n_blocks)
                    held, n = [], 0
        if held:
            yield _packed(*np.unique(np.concatenate(held), return_counts=True), n_blocks)

    return run


def _fill(batches):
    def block(number, blobs):
        rows = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 6)
        low = np.zeros((len(rows), 8), np.uint8)
        low[:, :5] = rows[:, :5]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([fill_block(low.view("<u8").ravel(), rows[:, 5].astype(float)).tobytes()], pa.binary())], names=["block", "bits"])

    last, held = None, []
    for b in batches:
        for number, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if number != last and held:
                yield block(last, held)
                held = []
            last = number
            held.append(blob)
    if held:
        yield block(last, held)


def build_filter(texts: DataFrame, counts: DataFrame, n_tokens: int) -> tuple[DataFrame, int]:
    """The filter as a table (block, bits), and its number of blocks. ``texts`` has one column, ``counts`` words and counts."""
    n_blocks = max(1, -(-n_tokens // BLOCK))
    kind = "block long, grams binary"
    grams = texts.mapInArrow(_pack_pairs(n_blocks), kind).unionByName(counts.select("word", "c").mapInArrow(_pack_words(n_blocks), kind))
    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_tokens // 4_000_000)
    return written(grams.repartition(parts, "block").sortWithinPartitions("block").mapInArrow(_fill, "block long, bits binary"), "filter"), n_blocks


def _scores(levels: np.ndarray, starts: np.ndarray, n: int, v: int) -> np.ndarray:
    """Log10 probability of each text from the levels of (pair, word before, word) of its tokens."""
    pair, before, word = (COUNT_OF[x] for x in levels)
    alone = (word + 0.5) / (n + 0.5 * (v + 1))
    p = np.minimum((np.minimum(pair, before) + PRIOR * alone) / (before + PRIOR), 1.0)
    return np.add.reduceat(np.log10(p), starts)


def _levels(f: Filter, x: Run) -> np.ndarray:
    """Levels of (pair, word before, word) of a run's tokens."""
    one, at = np.unique(x.hashes, return_inverse=True)
    single = f.levels(mix(one))[at]
    return np.stack([f.levels(x.pairs()), shifted(single), single])


def _runs_of_rows(batches):
    """(rows, run) of a few hundred thousand tokens each."""
    for b in batches:
        at = 0
        for x in _runs(_bytes(b.column(1))):
            yield b.slice(at, len(x.sizes)), x
            at += len(x.sizes)


def _judged(rows: pa.Array, x: Run, levels: np.ndarray, hot, n: int, v: int) -> pa.RecordBatch:
    """Tokens, those known, base score and score of a run's texts as far as frequent words go, and the other words."""
    known, logs = hot
    score = _scores(levels, x.starts, n, v)
    place = np.minimum(np.searchsorted(known, x.hashes), len(known) - 1)
    frequent = known[place] == x.hashes
    base = np.add.reduceat(np.where(frequent, logs[place], 0.0), x.starts)
    n_frequent = np.add.reduceat(frequent.astype(np.int64), x.starts)
    # The other words, each once for each text, with how often it occurs there.
    rare = np.flatnonzero(~frequent)
    text = np.repeat(np.arange(len(x.sizes)), x.sizes)[rare]
    order = np.lexsort((x.hashes[rare], text))
    rare, text = rare[order], text[order]
    h = x.hashes[rare]
    first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1]))[: len(rare)])
    times = np.diff(np.append(first, len(rare)))
    offsets = pa.array(np.searchsorted(text[first], np.arange(len(x.sizes) + 1)).astype(np.int32))
    words = pa.array(x.words(rare[first], text[first]), pa.string())
    cols = [pa.array(x.sizes), pa.array(n_frequent), pa.array(base), pa.array(score)]
    lists = [pa.ListArray.from_arrays(offsets, words), pa.ListArray.from_arrays(offsets, pa.array(times))]
    return pa.RecordBatch.from_arrays([rows, *cols, *lists], names=["row", "n_tokens", "known", "base", "score", "words", "times"])


def _judge(whole, hot, n: int, v: int):
    """Judges texts by a broadcast filter."""

    def run(batches):
        for b, x in _runs_of_rows(batches):
            yield _judged(b.column(0), x, _levels(whole.value, x), hot.value, n, v)

    return run


def gram_keys(x: Run) -> np.ndarray:
    """Distinct keys of a run's words and pairs in order, which is also that of their blocks."""
    return distinct(np.concatenate([mix(distinct(x.hashes)), x.pairs()]))


def _ask(n_blocks: int, per: int):
    """For each run, a row for each part of the filter that it needs, 6 bytes for each key. Texts come by run."""

    def ask(number: int, texts: list) -> pa.RecordBatch:
        keys = gram_keys(Run(texts))
        block = block_of(keys, n_blocks).astype(np.int64)
        part = block // per
        packed = np.empty((len(keys), 6), np.uint8)
        packed[:, :5] = (keys & _LOW).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
        packed[:, 5] = block - part * per
        begin = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(begin), number)), pa.array(part[begin].astype(np.int32)), _blobs(packed, begin)], names=["run", "part", "grams"])

    def run(batches):
        now, held = None, []
        for b in batches:
            number = b.column("run").to_numpy()
            begin = np.flatnonzero(np.append(True, number[1:] != number[:-1])) if len(number) else []
            for s, e in zip(begin, [*begin[1:], len(number)]):
                if number[s] != now:
                    if held:
                        yield ask(now, held)
                    now, held = number[s], []
                held += _bytes(b.column("text").slice(s, e - s))
        if held:
            yield ask(now, held)

    return run


def _answer(n_blocks: int, per: int):
    """Levels of the keys that were asked for. Rows come by part, its blocks (run -1) before the questions."""

    def run(batches):
        part, data = None, np.zeros(0, np.uint8)
        for b in batches:
            parts, runs, blocks = (b.column(k).to_numpy() for k in range(3))
            grams = b.column(3).cast(pa.large_binary())
            at = np.frombuffer(grams.buffers()[1], np.int64)[grams.offset : grams.offset + len(grams) + 1]
            grams = np.frombuffer(grams.buffers()[2] or b"", np.uint8)
            begin = np.flatnonzero(np.append(True, parts[1:] != parts[:-1])[: len(parts)])
            for s, e in zip(begin.tolist(), [*begin[1:].tolist(), len(parts)]):
                if parts[s] != part:
                    part, data = parts[s], np.zeros(per * BLOCK, np.uint8)
                while s < e and runs[s] < 0:
                    to = (blocks[s] - part * per) * BLOCK
                    data[to : to + BLOCK] = grams[at[s] : at[s + 1]]
                    s += 1
                if s == e:
                    continue
                packed = grams[at[s] : at[e]].reshape(-1, 6)  # the questions of all runs at once
                low = np.zeros((len(packed), 8), np.uint8)
                low[:, :5] = packed[:, :5]
                levels = Filter(part * per, data, n_blocks).probe(packed[:, 5].astype(np.int64), low.view("<u8").ravel())
                yield pa.RecordBatch.from_arrays([pa.array(runs[s:e]), pa.array(parts[s:e]), _blobs(levels, (at[s:e] - at[s]) // 6)], names=["run", "part", "grams"])

    return run


def _judge_run(hot, n: int, v: int):
    """Judges the texts of a run by the answers to it."""

    def judged(texts: pa.Table, answers: pa.Table) -> pa.Table:
        x = Run(_bytes(texts.column("text").combine_chunks()))
        known = np.frombuffer(b"".join(answers.sort_by("part").column("grams").to_pylist()), np.uint8)
        one, at = np.unique(x.hashes, return_inverse=True)
        _, place = np.unique(np.concatenate([mix(one), x.pairs()]), return_inverse=True)  # in ``gram_keys``
        found = known[place]
        single = found[: len(one)][at]
        levels = np.stack([found[len(one) :], shifted(single), single])
        rows = pa.concat_arrays(texts.column("row").chunks)
        rows = pa.StructArray.from_arrays([rows.field(0), rows.field(1)], names=["at", "id"])  # both nullable
        return pa.Table.from_batches([_judged(rows, x, levels, hot.value, n, v)])

    return judged


def judge_by_parts(rows: DataFrame, table: DataFrame, n_blocks: int, part_bytes: int, hot, n: int, v: int, out: str) -> DataFrame:
    """What ``_judge`` gives, with a filter that is not gathered: its parts meet the n-grams dealt to them.

    Rows are dealt to runs of about ``RUN`` training tokens by their number, which files give the same at each reading.
    Both readers of the texts take all columns, so that they share one exchange.
    """
    per = min(max(1, part_bytes // BLOCK), 256)
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_blocks // per))
    texts = rows.withColumn("run", F.pmod(F.xxhash64("row.at"), F.lit(max(1, n // RUN)).cast("long"))).repartition(parts, "run")
    asked = texts.sortWithinPartitions("run").mapInArrow(_ask(n_blocks, per), "run long, part int, grams binary")
    questions = asked.select("part", "run", F.lit(-1).cast("long").alias("block"), "grams")
    blocks = table.select(F.floor(F.col("block") / per).cast("int").alias("part"), F.lit(-1).cast("long").alias("run"), "block", F.col("bits").alias("grams"))
    dealt = questions.unionByName(blocks).repartition(parts, "part").sortWithinPartitions("part", "run")
    answers = dealt.mapInArrow(_answer(n_blocks, per), "run long, part int, grams binary")
    return texts.groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(_judge_run(hot, n, v), out)


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", broadcast_bytes: int = BROADCAST, part_bytes: int = PART, frequent: int = FREQUENT) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.struct(F.monotonically_increasing_id().alias("at"), F.col(key).alias("id")).alias("row"), F.col(text).alias("text"))
    train = docs.where(~held_out(key)).select(F.col(text).alias("text"))

    counts = written(train.mapInArrow(_word_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("c")), "counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = total["n"], total["v"]
    below = n + 0.5 * (v + 1)
    # Each of these words is at least one in ``frequent`` tokens, so there are no more of them than that.
    top = counts.where(F.col("c") * frequent >= F.lit(n)).collect()
    by_hash = sorted(zip(word_hashes([r["word"].encode() for r in top]).tolist(), ((r["c"] + 0.5) / below for r in top))) or [(0, 1.0)]
    hot = sc.broadcast((np.array([h for h, _ in by_hash], np.uint64), np.log10([p for _, p in by_hash])))

    table, n_blocks = build_filter(train, counts, n)
    kind = f"row {rows.schema['row'].dataType.simpleString()}, n_tokens long, known long, base double, score double, words array<string>, times array<long>"
    if n_blocks * BLOCK <= broadcast_bytes:
        data = np.zeros(n_blocks * BLOCK, np.uint8)
        for r in table.toLocalIterator():
            data[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["bits"], np.uint8)
        whole = sc.broadcast(Filter(0, data, n_blocks))
        judged = written(rows.mapInArrow(_judge(whole, hot, n, v), kind), "judged")
        whole.unpersist()
    else:
        judged = written(judge_by_parts(rows, table, n_blocks, part_bytes, hot, n, v, kind), "judged")

    rare = judged.select("row.at", F.explode(F.arrays_zip("words", "times")).alias("w")).select("at", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    # Hashing a task's share of the counts spares a sort of all rare words.
    found = rare.join(counts.hint("shuffle_hash"), "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    sums = found.groupBy("at").agg(F.sum(F.col("times") * F.log10((F.col("c") + 0.5) / F.lit(float(below)))).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("seen"))
    out = judged.withColumn("at", F.col("row.at")).join(sums, "at", "left").withColumn(key, F.col("row.id"))
    return out.select(
        key,
        held_out(key).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score",
    )
