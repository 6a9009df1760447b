"""Periodic runs of words, by internal pattern matching.

A run of period q with at least three periods (and LEAST words) holds an aligned
block of b words, b the power of two at or below q, whose next copy stands q words
on, within the window of starts b to 2b - 1 words after the block. (Up to twice
the smallest block one level serves all smaller periods.) So each dyadic block
asks for its occurrences in the neighbouring window:

* ``Repeats`` names equal blocks of 1, 2, 4, ... words by equal numbers, for the
  places whose block occurs again in the same text, and orders these places by
  them: a suffix array of all that repeats, in which a block's occurrences are
  one interval.
* ``RangeSuccessor``, a wavelet matrix over that array, finds an interval's first
  place in a window, and how many there are.
* More than two occurrences in a window form one arithmetic progression. Its
  difference is the block's own period, so at most two members can be periods of
  a longer run: those that align the start or the end of the stretches with that
  smaller period. One or two occurrences are candidates themselves.

Each candidate is extended to both sides by the numbers of ever smaller blocks,
and kept if long enough.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import accumulate, count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from stratum.llm.common import table, text_groups

#: a run has at least so many words, and so many periods
LEAST, PERIODS = 24, 3
#: words of the smallest block; LEAST words hold an aligned one and its next copy
BLOCK = 8
#: characters of the texts that share one array of suffixes; a longer text has one of its own
BATCH_CHARS = 1_500_000


def words_of(text: str) -> list[bytes]:
    """Stretches without ASCII white space (blank, tab to carriage return)."""
    return text.encode().split()


class RangeSuccessor:
    """Wavelet matrix over numbers below ``size``: how many of an interval are
    smaller than a bound, and the k-th smallest of an interval."""

    def __init__(self, values: np.ndarray, size: int):
        self.bits = max(1, int(size - 1).bit_length())
        self.levels = []
        for bit in range(self.bits - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(ones, out=before[1:])
            self.levels.append((bit, before, len(values) - int(before[-1])))
            values = np.concatenate([values[~ones], values[ones]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        found = np.zeros(len(low), np.int64)
        all_of = bound >= 1 << self.bits
        for bit, before, zeros in self.levels:
            l1, h1 = before[low], before[high]
            one = (bound >> bit & 1).astype(bool)
            found += np.where(one, (high - h1) - (low - l1), 0)
            low_, high_ = np.where(one, zeros + l1, low - l1), np.where(one, zeros + h1, high - h1)
            if bit == self.bits - 1:
                whole = high - low
            low, high = low_, high_
        return np.where(all_of, whole, found)

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        got = np.zeros(len(low), np.int64)
        for bit, before, zeros in self.levels:
            l1, h1 = before[low], before[high]
            few = (high - h1) - (low - l1)
            one = k >= few
            got |= one.astype(np.int64) << bit
            k = np.where(one, k - few, k)
            low, high = np.where(one, zeros + l1, low - l1), np.where(one, zeros + h1, high - h1)
        return got


class Repeats:
    """Numbers of the blocks of 1, 2, 4, ... words that stand more than once in
    their text; 0 where a block stands alone. Texts lie end to end, each with an
    end mark that nothing equals."""

    def __init__(self, symbols: np.ndarray, longest: int):
        self.size = n = len(symbols)
        names = np.where(np.bincount(symbols, minlength=1)[symbols] > 1, symbols + 1, 0).astype(np.int64)
        alive = np.flatnonzero(names)
        #: by level: numbers of all places up to the smallest block, then of the places in ``places``
        self.dense: list[np.ndarray] = []
        self.sparse: list[np.ndarray] = []
        length = 1
        while True:
            if length < BLOCK:
                self.dense.append(np.append(names, np.zeros(BLOCK, np.int64)))
            else:
                if length == BLOCK:
                    self.places = alive
                    self.slot = np.zeros(n + 1, np.int32)
                    self.slot[alive] = np.arange(1, len(alive) + 1)
                self.sparse.append(np.append(0, names[self.places]))
            if length >= BLOCK and (2 * length * PERIODS > longest or not len(alive)):
                break
            # a block stands twice only if both its halves do
            alive = alive[alive + length < n]
            ahead = names[alive + length]
            alive, ahead = alive[ahead > 0], ahead[ahead > 0]
            key = names[alive] * (int(names.max(initial=0)) + 1) + ahead
            order = np.argsort(key, kind="stable")
            key = key[order]
            new = np.append(True, key[1:] != key[:-1])[:len(key)]
            group = np.cumsum(new) - 1
            sizes = np.bincount(group, minlength=1)
            names = np.zeros(n, np.int64)
            names[alive[order]] = np.where(sizes[group] > 1, group + 1, 0) if len(key) else 0
            alive = alive[names[alive] > 0]
            length *= 2
        #: slots by the numbers of their blocks, the shortest blocks first, then by place
        self.suffixes = np.lexsort([np.arange(len(self.places)), *[s[1:] for s in reversed(self.sparse)]])

    def same(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether equal blocks of ``2 ** level`` words start at both places (both
        within the text, or past its end)."""
        if level < len(self.dense):
            x, y = self.dense[level][a], self.dense[level][b]
        else:
            names = self.sparse[level - len(self.dense)]
            x, y = names[self.slot[np.minimum(a, self.size)]], names[self.slot[np.minimum(b, self.size)]]
        return (x == y) & (x > 0)

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from both places on are equal (a < b)."""
        got = np.zeros(len(a), np.int64)
        top = len(self.dense) + len(self.sparse) - 1
        for level in range(top, -1, -1):
            todo = np.arange(len(a))
            while len(todo):
                todo = todo[self.same(level, np.minimum(a + got, self.size)[todo], np.minimum(b + got, self.size)[todo])]
                got[todo] += 1 << level
                if level < top:
                    break
        return got

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before both places are equal (a < b)."""
        got = np.zeros(len(a), np.int64)
        top = len(self.dense) + len(self.sparse) - 1
        for level in range(top, -1, -1):
            step = 1 << level
            todo = np.arange(len(a))
            while len(todo):
                todo = todo[a[todo] - got[todo] >= step]
                at, bt = a[todo] - got[todo] - step, b[todo] - got[todo] - step
                todo = todo[self.same(level, at, bt)]
                got[todo] += step
                if level < top:
                    break
        return got


def _stretch(r: Repeats, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the longest stretch around ``at`` that keeps a period."""
    return at - r.behind(at, at + period), at + period + r.ahead(at, at + period)


def _candidates(r: Repeats, find: RangeSuccessor, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods to look at, from the blocks of one level."""
    names, block = r.sparse[level][1:], BLOCK << level
    listed = names[r.suffixes]
    firsts = np.flatnonzero(np.append(True, listed[1:] != listed[:-1]) & (listed > 0))
    stops = np.flatnonzero(np.append(listed[1:] != listed[:-1], True) & (listed > 0)) + 1
    top = int(names.max(initial=0)) + 1
    low_of, high_of = np.zeros(top, np.int64), np.zeros(top, np.int64)
    low_of[listed[firsts]], high_of[listed[firsts]] = firsts, stops
    asked = np.flatnonzero((names > 0) & (r.places % block == 0))
    places, low, high = r.places[asked], low_of[names[asked]], high_of[names[asked]]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    windows = [(1, block), (block, 2 * block)] if level == 0 else [(block, 2 * block)]
    for near, far in windows:
        before = find.below(low, high, np.searchsorted(r.places, places + near))
        many = find.below(low, high, np.searchsorted(r.places, places + far)) - before
        for nth in (0, 1):
            has = np.flatnonzero(many > nth)
            to = r.places[find.smallest(low[has], high[has], before[has] + nth)]
            if not nth:
                first = np.zeros(len(places), np.int64)
                first[has] = to
            else:
                second = np.zeros(len(places), np.int64)
                second[has] = to
            # nearer than the block's own length, the first occurrence shows the block's own period
            pick = (many[has] <= 2) | (near < block and not nth)
            found.append((places[has][pick], (to - places[has])[pick]))
        row = np.flatnonzero(many > 2)
        if not len(row):
            continue
        at, to, step = places[row], first[row], second[row] - first[row]
        start, end = _stretch(r, at, step)
        start2, end2 = _stretch(r, to, step)
        other = start != start2  # else one stretch of the smaller period, which a smaller block finds
        for period in (start2 - start, end2 - end):
            ok = other & (period >= to - at) & (period <= to - at + (many[row] - 1) * step) & ((period - (to - at)) % step == 0)
            found.append((at[ok], period[ok]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """All runs ``(start, length, period)`` of each list of words, by start, then
    period."""
    parts, starts, base = [], [0], 0
    for words in texts:
        name = defaultdict(count(base).__next__)
        parts.append(np.fromiter(map(name.__getitem__, words), np.int64, len(words)))
        base += len(name) + 1
        parts.append(np.array([base - 1]))  # the text's end mark
        starts.append(starts[-1] + len(words) + 1)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not parts:
        return out
    r = Repeats(np.concatenate(parts), max(map(len, texts)))
    if not len(r.places):
        return out
    find = RangeSuccessor(r.suffixes, len(r.places))
    best: dict[tuple[int, int], int] = {}
    for level in range(len(r.sparse)):
        at, period = _candidates(r, find, level)
        start, end = _stretch(r, at, period)
        long = (end - start >= np.maximum(LEAST, PERIODS * period)) & (period > 0)
        for s, e, q in zip(start[long].tolist(), end[long].tolist(), period[long].tolist()):
            if q < best.get((s, e), q + 1):
                best[s, e] = q
    if best:
        kept = sorted((s, q, e) for (s, e), q in best.items())
        home = np.searchsorted(starts, [s for s, _, _ in kept], side="right") - 1
        for d, (s, q, e) in zip(home.tolist(), kept):
            out[d].append((s - starts[d], e - s, q))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    change = [0] * (len(words) + 1)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [w for w, inside in zip(words, accumulate(change)) if not inside]


RUN = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  edit: Callable[[str | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``doc_id, n_words, runs, collapsed``: every run of a whole text as ``(start,
    length, period)`` in words, by start, then period, and the text without the
    repeats (words joined by one blank). ``edit`` changes a text's words first; it
    gets the id as text.

    Null and empty texts have no words, no runs and an empty collapsed text; texts
    below 24 words have no runs. Repeated rows and null ids stay rows; extra columns
    are not carried. Narrow: no shuffle."""
    source = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.col(id_col).cast("string").alias("key"))
    schema = StructType([source.schema["doc_id"], StructField("n_words", LongType()),
                         StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())])
    arrow = to_arrow_schema(schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts, keys = part.column(1).to_pylist(), part.column(2).to_pylist()
            for i, j in text_groups(texts, BATCH_CHARS):
                words = [words_of(t) for t in texts[i:j]]
                if edit:
                    words = list(map(edit, keys[i:j], words))
                runs = runs_of(words)
                columns = ([len(w) for w in words], [[dict(zip(RUN.names, x)) for x in r] for r in runs],
                           [b" ".join(collapsed(w, r)).decode() for w, r in zip(words, runs)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(i, j - i).cast(arrow.field(0).type),
                     *[pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:])]], schema=arrow)

    return source.mapInArrow(run, schema)


def strongest(runs: Column) -> Column:
    """Of runs by start, then period, the first with the greatest exact length /
    period; null for none."""
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(
        r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def digests(found: DataFrame) -> DataFrame:
    """Count, strongest run and digests of the rows of :func:`periodic_runs`."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("top", strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length DIV top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def planted(doc_id: str | None, words: list[bytes]) -> list[bytes]:
    """The words with a repetition in every tenth document, by a digest of its id
    (a null id: of no text)."""
    h = crc32((doc_id or "").encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs in the documents, of which every tenth gets a repetition first."""
    return digests(periodic_runs(table(spark, sf_dir, "documents"), edit=planted))
