"""Periodic runs of words, found by internal pattern matching, and texts without their repeats.

A run is a stretch of words with smallest period ``q`` that has at least ``LEAST`` words and ``TIMES * q``,
and that no neighbouring word extends. Several texts are searched as one sequence, in which each ends in a
mark of its own and words count as equal within a text only.

Prefix doubling sorts the suffixes: after round ``k`` those that agree in their first ``2**k`` words are
neighbours in the suffix array, and only they are sorted further. So the occurrences of a dyadic block, the
``2**k`` words from a multiple of ``2**k`` on, are an interval of the array, and the first one from some
word on is a range successor: a wavelet tree over the array counts the smaller places in the interval and
selects the next.

A run of period ``q``, ``B <= q < 2B`` with ``B = 2**k``, holds a whole block that starts in its first
``B`` words, and that block occurs again ``q`` words on, which is in the window from ``B`` to ``2B - 1`` words
on. With one or two occurrences there, these are the candidate periods. Three or more are a progression whose
difference is the block's own period; the stretch of that period ends within the run, so the candidate is how far
apart that end is from the end of the occurrences' stretch. Blocks of two words give the periods 1 to 3.
Candidates are extended to both sides by the ranks of the rounds, which compare ``2**k`` words at
a time. All of it is logarithmic per word, whatever the text; a text is searched whole in one task.

Defined cases: a null text, or one without words, has no runs and an empty collapsed text; null keys are
kept; rows that repeat are rows; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import table
from tidemill.llm.sql import CRC32

LEAST = 6
TIMES = 4
# Words of texts that are searched together; a longer text is searched by itself.
TOGETHER = 1 << 17


class Suffixes:
    """Suffixes of marked word numbers, sorted by prefix doubling, with the ranks of all rounds."""

    def __init__(self, words: np.ndarray, text: np.ndarray, longest: int):
        self.words, size = words, len(words)
        base = int(words.max()) + 1
        following = np.append(words[1:], 0)
        pairs = (text * base + words) * base + following
        self.places = np.argsort(pairs)
        # ranks[k] has the start of each suffix's interval after round k; words stand for round 0.
        self.ranks, self.ends = [words], [None]
        slots = np.arange(size)
        found = pairs[self.places]
        rank = np.empty(size, np.int64)
        while True:
            # Where groups of equal keys start and end among the slots that are still sorted.
            starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
            sizes = np.diff(np.append(starts, len(found)))
            group = np.repeat(slots[starts], sizes)
            rank[self.places[slots]] = group
            many = np.repeat(sizes > 1, sizes)
            slots, group = slots[many], group[many]
            end = np.zeros(size, np.int64)
            end[slots[np.flatnonzero(np.diff(group, prepend=-1))]] = slots[np.flatnonzero(np.diff(group, append=-1))] + 1
            self.ranks.append(rank.copy())
            self.ends.append(end)
            if len(self.ranks) == 2:
                self.shared = slots
            width = 1 << len(self.ranks) - 1
            if not len(slots) or TIMES * width > longest:
                break
            at = self.places[slots]
            # A suffix that shares its first words has them before its text's mark, so there are words to come.
            keys = rank[at] * size + rank[at + width]
            order = np.argsort(keys)
            self.places[slots] = at[order]
            found = keys[order]

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from ``i`` and from ``j`` on agree (``i < j``, in one text)."""
        return self._agreeing(i, j, lambda x, n, width: x + n)

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before ``i`` and before ``j`` agree."""
        return self._agreeing(i, j, lambda x, n, width: x - n - width)

    def _agreeing(self, i, j, at) -> np.ndarray:
        count = np.zeros(len(i), np.int64)
        top = len(self.ranks) - 1
        for level in range(top, -1, -1):
            rank, width = self.ranks[level], 1 << level
            going = np.arange(len(i))
            while len(going):
                left, right = at(i[going], count[going], width), at(j[going], count[going], width)
                going = going[(left >= 0) & (rank[np.maximum(left, 0)] == rank[np.maximum(right, 0)])]
                count[going] += width
                # Only the widest step may be taken more than once.
                if level < top:
                    break
        return count


class Wavelet:
    """Range successors among the places of a suffix array's shared slots."""

    def __init__(self, suffixes: Suffixes, size: int):
        slots = suffixes.shared
        places = suffixes.places[slots]
        self.before_slot = np.zeros(size + 1, np.int64)
        self.before_slot[slots + 1] = 1
        np.cumsum(self.before_slot, out=self.before_slot)
        self.sorted = np.sort(places)
        self.before_place = np.zeros(size + 1, np.int64)
        self.before_place[places + 1] = 1
        np.cumsum(self.before_place, out=self.before_place)
        values = self.before_place[places]
        self.levels = []
        for bit in reversed(range(max(1, len(slots).bit_length()))):
            one = (values >> bit & 1).astype(bool)
            zeros = np.zeros(len(values) + 1, np.int64)
            np.cumsum(~one, out=zeros[1:])
            self.levels.append((bit, zeros, int(zeros[-1])))
            values = np.concatenate([values[~one], values[one]])

    def successor(self, start: np.ndarray, end: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest place of at least ``least`` in the slots from ``start`` to ``end``, or -1."""
        left, right = self.before_slot[start], self.before_slot[end]
        bound = self.before_place[np.minimum(least, len(self.before_place) - 1)]
        smaller = np.zeros(len(left), np.int64)
        low, high = left, right
        for bit, zeros, ones_at in self.levels:
            one = (bound >> bit & 1).astype(bool)
            in_low, in_high = zeros[low], zeros[high]
            smaller += np.where(one, in_high - in_low, 0)
            low, high = np.where(one, ones_at + low - in_low, in_low), np.where(one, ones_at + high - in_high, in_high)
        found = smaller < right - left
        rest, value = np.where(found, smaller, 0), np.zeros(len(left), np.int64)
        low, high = left, right
        for bit, zeros, ones_at in self.levels:
            in_low, in_high = zeros[low], zeros[high]
            one = rest >= in_high - in_low
            rest = rest - np.where(one, in_high - in_low, 0)
            value |= one.astype(np.int64) << bit
            low, high = np.where(one, ones_at + low - in_low, in_low), np.where(one, ones_at + high - in_high, in_high)
        return np.where(found, self.sorted[np.minimum(value, len(self.sorted) - 1)], -1)


def _candidates(suffixes: Suffixes, tree: Wavelet, begins: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and the periods that runs through them may have."""
    for level in range(1, len(suffixes.ranks)):
        width = 1 << level
        many = np.where(lengths >= (LEAST if level == 1 else TIMES * width), lengths // width, 0)
        block = np.repeat(begins, many) + width * (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
        start = suffixes.ranks[level][block]
        end = suffixes.ends[level][start]
        shared = end > 0
        block, start, end = block[shared], start[shared], end[shared]
        least = 1 if level == 1 else width
        hits = []
        at = block + least - 1
        for _ in range(3):
            at = tree.successor(start, end, at + 1)
            there = (at >= 0) & (at < block + 2 * width)
            block, start, end, at = block[there], start[there], end[there], at[there]
            hits = [h[there] for h in hits] + [at]
            if level == 1 or len(hits) < 3:
                yield block, at - block
        if level > 1 and len(block):
            own = hits[1] - hits[0]
            stop = block + own + suffixes.ahead(block, block + own)
            stop_there = hits[0] + own + suffixes.ahead(hits[0], hits[0] + own)
            period = stop_there - stop
            sound = (period >= width) & (period < 2 * width)
            yield block[sound], period[sound]


def runs_of(texts: list[np.ndarray]) -> list[np.ndarray]:
    """For each text, given as word numbers, its runs as rows of start, length and period, in order."""
    lengths = np.array([len(t) for t in texts], np.int64)
    none = np.empty((0, 3), np.int64)
    longest = int(lengths.max(initial=0))
    if longest < LEAST:
        return [none] * len(texts)
    base = max(int(t.max(initial=0)) for t in texts) + 1
    words = np.concatenate([x for at, t in enumerate(texts) for x in (t, [base + at])]).astype(np.int64)
    begins = np.cumsum(lengths + 1) - lengths - 1
    suffixes = Suffixes(words, np.repeat(np.arange(len(texts)), lengths + 1), longest)
    if not len(suffixes.shared):
        return [none] * len(texts)
    tree = Wavelet(suffixes, len(words))
    found = list(_candidates(suffixes, tree, begins, lengths))
    place = np.concatenate([p for p, _ in found])
    period = np.concatenate([q for _, q in found])
    place, period = np.divmod(np.unique(place * (longest + 1) + period), longest + 1)
    start = place - suffixes.behind(place, place + period)
    stop = place + period + suffixes.ahead(place, place + period)
    long = stop - start >= np.maximum(LEAST, TIMES * period)
    start, stop, period = start[long], stop[long], period[long]
    # A stretch has one smallest period; its multiples are found as well.
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[first], stop[first], period[first]
    order = np.lexsort((period, start))
    rows = np.stack([start, stop - start, period], axis=1)[order]
    cuts = np.searchsorted(rows[:, 0], begins)
    parts = np.split(rows, cuts[1:])
    return [part - [begin, 0, 0] for part, begin in zip(parts, begins)]


def _searched(texts: list[bytes]) -> Iterator[tuple[np.ndarray, bytes]]:
    """Runs and collapsed text of each text, searched together."""
    numbers: dict[bytes, int] = {}
    split = [t.split() for t in texts]
    numbered = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)) for words in split]
    for words, runs in zip(split, runs_of(numbered)):
        if len(runs):
            covered = np.zeros(len(words) + 1, np.int64)
            np.add.at(covered, runs[:, 0] + runs[:, 2], 1)
            np.add.at(covered, runs[:, 0] + runs[:, 1], -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(covered[:-1]) == 0)]
        yield runs, b" ".join(words)


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RUNS_DDL = "array<struct<start:long,length:long,period:long>>"


def _batch(keys: list, found: list[tuple[np.ndarray, bytes]]) -> pa.RecordBatch:
    rows = np.concatenate([r for r, _ in found])
    offsets = np.cumsum([0] + [len(r) for r, _ in found])
    items = pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in range(3)], names=["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items).cast(RUNS),
         pa.array([c for _, c in found], pa.binary()).cast(pa.string())],
        names=["doc_id", "runs", "collapsed"],
    )


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, runs, collapsed`` of every row: its runs by start and period, and its words without those
    that a run has after its first period, joined by spaces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, size = [], [], 0
            for key_, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys.append(key_)
                texts.append((content.as_py() or "").encode())
                # At most half the bytes are words.
                size += len(texts[-1]) // 2 + 1
                if size >= 4 * TOGETHER:
                    yield _batch(keys, list(_searched(texts)))
                    keys, texts, size = [], [], 0
            if keys:
                yield _batch(keys, list(_searched(texts)))

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("__text"))
    return rows.mapInArrow(run, f"doc_id long, runs {RUNS_DDL}, collapsed string")


def planted(key: Column, text: Column) -> Column:
    """The text, or, where 10 divides the key's CRC-32, the text with its words from some word on in a period."""
    crc = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(crc / F.lit(10)).cast("long")

    def periodic(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = (g % F.greatest(n, F.lit(1))).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        again = F.transform(F.sequence(F.lit(0), F.size(words) - a - 1), lambda i: F.get(words, a + i % p))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a), again), " ")).otherwise("")

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # Bound to a name of a lambda, the words are split once.
    return F.when(crc % 10 == 0, F.transform(F.array(words), periodic)[0]).otherwise(text)


def op11_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", planted(F.col("doc_id"), F.coalesce("text", F.lit(""))).alias("text"))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    found = periodic_runs(docs).select("*", longest.alias("__l"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("__l.start")).alias("start"), F.col("__l.length").alias("length"), (-F.col("__l.period")).alias("period"),
        F.floor(1000 * F.col("__l.length") / -F.col("__l.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


SQL = rf"""
WITH {CRC32},
given AS (
  SELECT doc_id, crc32, crc32 // 10 AS g, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents JOIN crc USING (doc_id)),
places AS (SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN g % len(w) END AS a FROM given),
periods AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM places),
numbered AS (
  SELECT doc_id, n, unnest(range(n)) AS i, w, crc32 % 10 = 0 AS changed, a, p FROM periods),
tokens AS (
  SELECT doc_id, n, i, w[1 + CASE WHEN changed AND i >= a THEN a + (i - a) % p ELSE i END] AS word FROM numbered),
equal AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q
  FROM tokens x JOIN tokens y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, i, q, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island),
runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM tokens ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id),
sums AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    first({{'start': start, 'length': length, 'period': period}} ORDER BY length DESC, start, period) AS top
  FROM runs GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, top.start AS "start", top.length AS "length", top.period AS period,
  1000 * top.length // top.period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM documents d LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
