"""Hashed maximum-entropy language model with a class-factored softmax.

A word's probability is that of its class given the words before it, times that
of the word within the class. Both factors are maximum-entropy models:

* The class factor: the previous word, the word before that and the third back (skips)
  and the two previous words together (an n-gram) predict the class through hashed
  weight rows, a bounded table. Classes come from what kind of text words occur in and how frequent they are.
  Its weights are trained by distributed gradient updates: in each round every task
  starts from the same weights, takes mini-batch steps over its own texts, and
  returns its change of each row; Spark adds the changes up, weighted by how many
  tokens touched the row.
* The factor within a class: one weight for every pair of a previous word and a word of
  the class that the training texts hold, over the word's share of its class. These
  weights grow with the corpus. They are dealt to blocks by a hash of previous word and class,
  so that all words that share a normaliser lie together, and each block takes Newton
  steps on the pairs' counts, which are all that the gradient needs.

Texts stand in chunks of about CHUNK tokens. A chunk sends each distinct pair once,
with its own count, to the pair's block, and gets the trained weight back; the same
message asks for the exact counts of words without a number.

Counts cover all training tokens. The most frequent words, up to a bound, get
numbers and are broadcast; all others form one class, in which pairs are told apart by a hash
of the word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from stratum.llm.common import staged, table, texts_of

#: words that get numbers (3 MB to broadcast), and texts whose frequent words are looked at together
MAX_WORDS = 1 << 18
CLASS_TEXTS = 6_000
#: kinds of text, frequency bins of each (and of words of no kind); rare words and the end have own classes
KINDS, BINS = 6, 8
CLASSES = (KINDS + 1) * BINS + 2
ANCHORS = 192
#: weight rows of each of the four class features; with CLASSES they bound the class factor (3.8 MB)
ROWS = 1 << 12
TABLES = 4
OWN_ROW = 3_584
ROUNDS = 2
STEP = 0.1
#: tokens of a gradient step, and of a scoring batch
STEP_TOKENS, BATCH = 8_192, 4_096
MEMO = 300_000
#: texts that are split together
SLICE = 4_096
#: tokens of a chunk of texts, about; what a task holds of the pairs follows from it
CHUNK = 1 << 21
#: variance of the pairs' weights around 0, Newton steps on them, and the longest step
VARIANCE, FIT_STEPS, LONGEST = 8.0, 10, 2.5
#: bits of a pair's key that name its word: a number, or above those a hash of the word. The
#: last bit of a key is free: in a chunk it tells training texts from others while keys are sorted
ITEM_BITS = 19
END = b"\n"  # no word holds white space


def split_words(text: str) -> list[bytes]:
    """Words of the text, A-Z in lower case, and the end."""
    words = text.encode().lower().split()
    words.append(END)
    return words


def coded(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words of a column of texts, the end last, which of them each token is,
    text after text, and the texts' token counts. The same words as
    :func:`split_words` gives."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = lists.flatten()
    some = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty word
    before = np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))
    ends = before[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    held = words.filter(some).dictionary_encode()
    distinct = held.dictionary.cast(pa.binary()).to_pylist()
    return [*distinct, END], np.insert(held.indices.to_numpy(), ends[1:], len(distinct)), np.diff(ends) + 1


def word_hash(word: bytes) -> int:
    h = xxhash.xxh64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text leaves 2 modulo 7 (a null id: as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 7 == 2


def word_counts(texts: DataFrame) -> DataFrame:
    """``h, n``: how often each word (64-bit hash) occurs in ``texts(text)``.
    Tasks count in bounded tables before anything is shuffled."""
    arrow = pa.schema([("h", pa.int64()), ("n", pa.int64())])

    def run(batches):
        def out():
            yield pa.RecordBatch.from_arrays([pa.array([word_hash(w) for w in counts], pa.int64()),
                                              pa.array(list(counts.values()), pa.int64())], schema=arrow)
        counts: dict[bytes, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                distinct, token, _ = coded(batch.column(0).slice(at, SLICE))
                for w, n in zip(distinct, np.bincount(token, minlength=len(distinct)).tolist()):
                    counts[w] = counts.get(w, 0) + n
                if len(counts) > MEMO:
                    yield from out()
                    counts = {}
        yield from out()

    return texts.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Numbered words, most frequent first."""
    hashes: np.ndarray
    counts: np.ndarray
    tokens: int
    words: int

    def __post_init__(self):
        self.memo: Memo | None = None

    def __getstate__(self):
        return {"hashes": self.hashes, "counts": self.counts, "tokens": self.tokens, "words": self.words}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Number of each word; the number of numbered words for all others, whose
        hashes are then in ``memo.rare``."""
        if self.memo is None or len(self.memo) > MEMO:
            number = {h: i for i, h in enumerate(self.hashes.tolist())} if self.memo is None else self.memo.number
            self.memo = Memo(number)
        return np.fromiter(map(self.memo.__getitem__, words), np.int32, len(words))


class Memo(dict):
    """Numbers of the words met; each is hashed when it is first met."""

    def __init__(self, number: dict[int, int]):
        self.number, self.rare = number, {}

    def __missing__(self, word: bytes) -> int:
        h = word_hash(word)
        n = self[word] = self.number.get(h, len(self.number))
        if n == len(self.number):
            self.rare[word] = h
        return n


@dataclass
class TextKinds:
    """Kinds of text, by which of the most frequent words a text holds."""
    mean: np.ndarray
    centre: np.ndarray  # (kind, frequent word)

    def of_bits(self, bits: np.ndarray) -> np.ndarray:
        """Kind of each text, from which words it holds (1 or 0)."""
        return (bits @ self.centre.T - self.mean @ self.centre.T).argmax(axis=1)

    def of(self, texts: list[np.ndarray]) -> np.ndarray:
        bits = np.zeros((len(texts), len(self.mean)), np.float32)
        for i, t in enumerate(texts):
            bits[i, t[t < len(self.mean)]] = 1
        return self.of_bits(bits)


def held_words(texts: DataFrame, anchors: int) -> DataFrame:
    """``row, held`` of ``texts(row, numbers)``, written once: which of the ``anchors`` most
    frequent words each text holds, a bit each."""
    arrow = pa.schema([("row", pa.int64()), ("held", pa.binary())])

    def run(batches):
        for batch in batches:
            flat, sizes = _lists(batch.column(1))
            home, some = np.repeat(np.arange(len(sizes)), sizes), flat < anchors
            bits = np.zeros((len(sizes), anchors), bool)
            bits[home[some], flat[some]] = True
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in np.packbits(bits, axis=1)], pa.binary())],
                                             schema=arrow)

    return staged(texts.select("row", "numbers").mapInArrow(run, "row long, held binary"), "lm-held")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, CLASS_TEXTS):
            yield batch.slice(at, CLASS_TEXTS)


def _bits(column: pa.Array, anchors: int) -> np.ndarray:
    packed, _ = _lists(column, "u1")
    return np.unpackbits(packed.reshape(len(column), -1), axis=1, count=anchors).astype(np.float32)


#: a text's weight in its kind's centre is a whole multiple of this, so that sums don't depend on their order
_GRAIN = 2.0 ** -16


def kind_sums(held: DataFrame, found: TextKinds, weighted: bool = True) -> np.ndarray:
    """Over all of ``held``, by kind: the sums of the texts' weights (what brings a text's held
    words, less the mean, to length 1; or 1 each) by word, and last of all of the kind's texts.
    Tasks add up before anything is shuffled."""
    kinds, anchors = found.centre.shape
    arrow = pa.schema([("kind", pa.int32()), ("word", pa.int32()), ("total", pa.float64())])

    def run(batches):
        total = np.zeros((kinds, anchors + 1))
        for batch in _blocks(batches):
            bits = _bits(batch.column(0), anchors)
            size = np.maximum(np.linalg.norm(bits - found.mean, axis=1), 1e-6)
            own = np.zeros((kinds, len(bits)))
            own[found.of_bits(bits), np.arange(len(bits))] = np.rint(1 / size / _GRAIN) if weighted else 1
            total += own @ np.column_stack([bits, np.ones(len(bits), np.float32)])
        kind, word = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), pa.array(word.astype(np.int32)), pa.array(total[kind, word])],
                                         schema=arrow)

    got = held.select("held").mapInArrow(run, "kind int, word int, total double").groupBy("kind", "word").agg(F.sum("total").alias("total"))
    out = np.zeros((kinds, anchors + 1))
    for kind, word, total in got.collect():  # a row per kind and frequent word
        out[kind, word] = total
    return out


def farthest(held: DataFrame, found: TextKinds) -> bytes:
    """The held words of the text that is least like its nearest centre: each task names one."""
    arrow = pa.schema([("like", pa.float64()), ("row", pa.int64()), ("held", pa.binary())])

    def run(batches):
        best = None
        for batch in _blocks(batches):
            bits = _bits(batch.column(1), len(found.mean)) - found.mean
            like = (bits @ found.centre.T).max(axis=1) / np.maximum(np.linalg.norm(bits, axis=1), 1e-6)
            at = int(np.lexsort((batch.column(0).to_numpy(), like))[0])
            own = (float(like[at]), batch.column(0)[at].as_py(), batch.column(1)[at].as_py())
            best = min(best or own, own)
        if best:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(best, arrow)], schema=arrow)

    return held.select("row", "held").mapInArrow(run, "like double, row long, held binary").orderBy("like", "row").first()["held"]


def text_kinds(texts: DataFrame, anchors: int, kinds: int, seed: int) -> TextKinds:
    """Kinds of all of ``texts(row, numbers)``, of which the ``anchors`` most frequent words are
    looked at: centres far from each other, then moved to the mean of their texts until
    they stay or have moved 25 times. A centre's sums come to the driver, no texts."""
    found = TextKinds(np.zeros(anchors, np.float32), np.zeros((1, anchors), np.float32))
    held = held_words(texts, anchors) if anchors else None
    first = held.orderBy(F.xxhash64("row", F.lit(seed)), "row").first() if anchors else None
    if not first:
        return TextKinds(found.mean, np.zeros((kinds, anchors), np.float32))

    def direction(packed: bytes) -> np.ndarray:
        x = _bits(pa.array([packed], pa.binary()), anchors)[0] - found.mean
        return x / max(np.linalg.norm(x), 1e-6)

    *seen, rows = kind_sums(held, found, weighted=False)[0]
    found.mean = (np.array(seen) / rows).astype(np.float32)
    found.centre = direction(first["held"])[None]
    for _ in range(kinds - 1):  # far from those chosen
        found.centre = np.vstack([found.centre, direction(farthest(held, found))])
    before = None
    for _ in range(25):
        total = kind_sums(held, found)
        if before is not None and (total == before).all():
            break
        before = total
        some = total[:, -1] > 0
        found.centre[some] = (total[some, :-1] / total[some, -1:] - found.mean).astype(np.float32)
        found.centre /= np.maximum(np.linalg.norm(found.centre, axis=1, keepdims=True), 1e-6)
    return found


def told_kinds(seen: np.ndarray) -> np.ndarray:
    """Kind of each word from ``seen`` (word, kind), how often texts of each kind
    hold it: the kind that holds it most, beyond what the kinds' sizes explain;
    the number of kinds for none."""
    share = (seen + 1e-9) / np.maximum(seen.sum(axis=0), 1)
    share /= share.sum(axis=1, keepdims=True)
    return np.where((share.max(axis=1) > 0.5) & (seen.sum(axis=1) > 0), share.argmax(axis=1), seen.shape[1])


def counted_kinds(texts: DataFrame, words: int, found: list[TextKinds]) -> list[np.ndarray]:
    """For each of ``found`` the kind of each of ``words`` numbered words, counted
    over all of ``texts(numbers)``. Tasks add up before anything is shuffled; to the
    driver comes a row per word and kind (of at most MAX_WORDS words)."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(found)
    arrow = pa.schema([("place", pa.int32()), ("word", pa.int32()), ("n", pa.int64())])
    begin = np.cumsum([0, *(len(f.centre) for f in found)])

    def run(batches):
        seen = np.zeros((begin[-1], words + 1), np.int32)
        for batch in batches:
            if batch.num_rows:
                flat, sizes = _lists(batch.column(0))
                cuts = np.cumsum([0, *sizes])
                own = [flat[a:b] for a, b in zip(cuts, cuts[1:])]
                for f, at in zip(shared.value, begin):
                    home = np.repeat(f.of(own), sizes)
                    for k in range(len(f.centre)):
                        seen[at + k] += np.bincount(flat[home == k], minlength=words + 1).astype(np.int32)
        for place, row in enumerate(seen[:, :words]):
            some = np.flatnonzero(row)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), place, np.int32)), pa.array(some.astype(np.int32)),
                                                  pa.array(row[some].astype(np.int64))], schema=arrow)

    got = (texts.select("numbers").mapInArrow(run, "place int, word int, n long")
           .groupBy("place", "word").agg(F.sum("n").alias("n")).toArrow())
    seen = np.zeros((words, begin[-1]))
    seen[got.column("word").to_numpy(), got.column("place").to_numpy()] = got.column("n").to_numpy()
    shared.unpersist()
    return [told_kinds(seen[:, a:b]) for a, b in zip(begin, begin[1:])]


def mass_bins(kind: np.ndarray, weight: np.ndarray, bins: int) -> np.ndarray:
    """Words (by descending weight) of each kind cut into bins of equal mass."""
    out = np.zeros(len(kind), np.int32)
    for k in np.unique(kind):
        own = np.flatnonzero(kind == k)
        mass = np.cumsum(weight[own]) - weight[own]
        out[own] = k * bins + np.minimum(mass * bins // max(weight[own].sum(), 1), bins - 1)
    return out


def classes_of(vocabulary: Vocabulary, kind: np.ndarray) -> np.ndarray:
    """Class of each numbered word, by kind and frequency, and of the others last."""
    n = len(vocabulary.hashes)
    classes = np.full(n + 1, CLASSES - 1, np.int32)
    classes[:n] = mass_bins(kind, vocabulary.counts, BINS)
    classes[:n][vocabulary.hashes == word_hash(END)] = CLASSES - 2
    return classes


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A weight row for each pair, by a hash."""
    both = (a.astype(np.uint32) * np.uint32(0x9E3779B1)) ^ (b.astype(np.uint32) * np.uint32(0x85EBCA77))
    return ((both ^ (both >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(20)).astype(np.int32)


def contexts(numbers: np.ndarray, sizes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Weight rows (feature kind, token) that predict each token's class, for texts
    that stand one after another.
    Frequent words have rows of their own, others that of their class; before a
    text stands a start."""
    own = classes[numbers]
    row = np.where(numbers < OWN_ROW, numbers, OWN_ROW + own).astype(np.int32)
    begin = np.cumsum(sizes) - sizes
    place = np.arange(len(numbers)) - np.repeat(begin, sizes)
    back = []
    for k in (1, 2, 3):
        prior = np.full(len(row), OWN_ROW + CLASSES, np.int32)
        prior[k:] = row[:-k] if len(row) > k else row[:0]
        prior[place < k] = OWN_ROW + CLASSES
        back.append(prior)
    return np.stack([back[0], back[1] + ROWS, back[2] + 2 * ROWS, _mixed(back[0], back[1]) + 3 * ROWS])


def stretch_sums(a: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows from each of ``first`` to the next: short stretches of one length
    together, long ones as a product with ones; row by row takes several times as long."""
    size = np.diff(np.append(first, len(a)))
    out = np.empty((len(first), a.shape[1]), a.dtype)
    for k in range(1, 9):
        some = np.flatnonzero(size == k)
        if len(some):
            total = a[first[some]]
            for j in range(1, k):
                total += a[first[some] + j]
            out[some] = total
    ones = np.ones(int(size.max(initial=0)), a.dtype)
    for k in np.flatnonzero(size > 8).tolist():
        out[k] = ones[:size[k]] @ a[first[k]:first[k] + size[k]]
    return out


@dataclass
class Model:
    vocabulary: Vocabulary
    classes: np.ndarray
    bias: np.ndarray
    weights: np.ndarray  # (TABLES * ROWS, CLASSES)
    share: np.ndarray    # of each numbered word in its class; from 2 ** 18 on, of each hash of a word without a number
    rare_total: float    # sum of count + 1 over the other words, and 1 for unknown ones

    def _exponentials(self, start: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Exponents from ``start`` and the weights of ``rows``, their exponentials and the sums of those."""
        z = self.weights.take(rows[0], axis=0)
        for r in rows[1:]:
            z += self.weights.take(r, axis=0)
        z += start
        z -= z.max()
        e = np.exp(z)
        total = e @ np.ones(CLASSES, np.float32)
        if total.min() < 1e-30:  # a token far below the others: from its own maximum
            z -= z.max(axis=1, keepdims=True)
            e = np.exp(z)
            total = e @ np.ones(CLASSES, np.float32)
        return z, e, total

    def softmax(self, start: np.ndarray, rows: np.ndarray) -> np.ndarray:
        _, e, total = self._exponentials(start, rows)
        e /= total[:, None]
        return e

    def log_share(self, start: np.ndarray, rows: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log probability of each token's ``target``."""
        z, _, total = self._exponentials(start, rows)
        return z[np.arange(len(target)), target].astype(np.float64) - np.log(total)

    def token_scores(self, numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Natural log probability of each token's class, and of numbered words their
        share of it."""
        rows = contexts(numbers, sizes, self.classes)
        out = np.empty(len(numbers))
        for at in range(0, len(numbers), BATCH):
            part = slice(at, at + BATCH)
            out[part] = self.log_share(self.bias, rows[:, part], self.classes[numbers[part]])
        known = numbers < len(self.vocabulary.hashes)
        out[known] += np.log(self.share[numbers[known]])
        return out

    def _step(self, start: np.ndarray, rows: np.ndarray, target: np.ndarray, seen: np.ndarray,
              touched: np.ndarray) -> None:
        g = self.softmax(start, rows)
        g[np.arange(len(target)), target] -= 1
        for r in rows:
            order = np.argsort(r.astype(np.uint16), kind="stable")
            first = np.flatnonzero(np.diff(r[order], prepend=-1))
            used = r[order][first]
            total = stretch_sums(g.take(order, axis=0), first)
            touched[used] += np.diff(np.append(first, len(order)))
            seen[used] += total * total
            self.weights[used] -= STEP * total / np.sqrt(seen[used] + 1e-6)

    def steps(self, numbers: np.ndarray, sizes: np.ndarray, seen: np.ndarray, touched: np.ndarray) -> None:
        """Gradient steps over the tokens of some texts; ``seen`` holds the sums of
        squared gradients, ``touched`` the tokens per row."""
        rows = contexts(numbers, sizes, self.classes)
        for at in range(0, len(numbers), STEP_TOKENS):
            part = slice(at, at + STEP_TOKENS)
            self._step(self.bias, rows[:, part], self.classes[numbers[part]], seen, touched)


def numbered(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``row, doc_id, numbers, rare, chunk`` of every whole text, written once: the
    word numbers, the end among them (32 bits each), the hashes of words without a number
    (64 bits), and which chunk of its task's texts it stands in."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = texts_of(docs).select(F.struct(F.monotonically_increasing_id().alias("row"), "doc_id").alias("doc_id"), "text")
    schema = StructType([rows.schema["doc_id"], StructField("numbers", BinaryType()), StructField("rare", BinaryType()),
                         StructField("chunk", LongType())])
    arrow = to_arrow_schema(schema)

    def packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
        """A text's numbers as one value, for each text."""
        ends = pa.py_buffer((cuts * values.itemsize).astype("<i4"))
        return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, ends, pa.py_buffer(np.ascontiguousarray(values))])

    def run(batches):
        v, tokens = shared.value, 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                distinct, token, sizes = coded(part.column(1))
                of = v.numbers(distinct)
                hashes = np.array([v.memo.rare[w] if n == len(v.hashes) else 0 for w, n in zip(distinct, of.tolist())], "<i8")
                numbers, cuts = of[token], np.append(0, np.cumsum(sizes))
                rare = np.flatnonzero(numbers == len(v.hashes))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(arrow.field(0).type), packed(numbers.astype("<i4"), cuts),
                     packed(hashes[token[rare]], np.searchsorted(rare, cuts)), pa.array((tokens + cuts[:-1]) // CHUNK, pa.int64())],
                    schema=arrow)
                tokens += int(cuts[-1])

    return staged(rows.mapInArrow(run, schema).select(
        "doc_id.*", "numbers", "rare", (F.shiftright("doc_id.row", 33) * (1 << 30) + F.col("chunk")).alias("chunk")),
        "lm-numbers", compression="zstd")


def _lists(column: pa.Array, kind: str = "<i4") -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of packed numbers one after another, and each text's count."""
    ends = np.frombuffer(column.buffers()[1], "<i4")[column.offset:column.offset + len(column) + 1].astype(np.int64)
    width = np.dtype(kind).itemsize
    if not len(column) or ends[-1] == ends[0]:
        return np.zeros(0, kind), np.diff(ends) // width
    return (np.frombuffer(column.buffers()[2], kind, (ends[-1] - ends[0]) // width, int(ends[0])), np.diff(ends) // width)


_BLOCK = 512
_CHANGES = "block int, change binary, touched binary"


def _adder(kind: type):
    """Changes of weight rows added up by block, each row's weighted by its tokens: a
    bounded table for any number of tasks. ``kind``: the numbers the changes come in."""
    def add(batches):
        sums: dict[int, list[np.ndarray]] = {}
        arrow = pa.schema([("block", pa.int32()), ("change", pa.binary()), ("touched", pa.binary())])
        for batch in batches:
            for block, change, touched in zip(*(batch.column(c).to_pylist() for c in range(3))):
                n = np.frombuffer(touched, np.float32).astype(np.float64)
                got = [np.frombuffer(change, kind).astype(np.float32).reshape(len(n), -1) * n[:, None].astype(np.float32), n]
                sums[block] = [a + b for a, b in zip(sums[block], got)] if block in sums else got
        mean = [(c / np.maximum(n, 1)[:, None]).astype(np.float32).tobytes() for c, n in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(mean, pa.binary()),
                                          pa.array([n.astype(np.float32).tobytes() for _, n in sums.values()], pa.binary())],
                                         schema=arrow)
    return add


def train_round(model: Model, texts: DataFrame) -> None:
    """One round of distributed gradient updates over ``texts(numbers)``."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(model)
    arrow = pa.schema([("block", pa.int32()), ("change", pa.binary()), ("touched", pa.binary())])

    def learn(batches):
        m = shared.value
        own = replace(m, weights=m.weights.copy())
        seen, touched = np.zeros_like(own.weights), np.zeros(len(own.weights))
        for batch in batches:
            own.steps(*_lists(batch.column(0)), seen, touched)
        change, touched = (own.weights - m.weights).astype(np.float16), touched.astype(np.float32)
        for block in range(len(change) // _BLOCK):
            rows = slice(block * _BLOCK, (block + 1) * _BLOCK)
            if touched[rows].any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([change[rows].tobytes()], pa.binary()),
                                                  pa.array([touched[rows].tobytes()], pa.binary())], schema=arrow)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    changes = (texts.select("numbers").mapInArrow(learn, _CHANGES)
               .withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(4)))
               .repartition(parts, "block", "salt").drop("salt").mapInArrow(_adder(np.float16), _CHANGES)
               .repartition(parts, "block").mapInArrow(_adder(np.float32), _CHANGES))
    for block, change, _ in changes.collect():  # one row per block: the size of the model
        model.weights[block * _BLOCK:(block + 1) * _BLOCK] += np.frombuffer(change, np.float32).reshape(-1, CLASSES)
    shared.unpersist()


def _least_count(counts: DataFrame, most: int | None = None) -> int:
    """A count that at most ``most`` words reach, as few steps above the exact one
    as a histogram of 64 steps per power of e tells. No word is sorted for it."""
    most = most or MAX_WORDS
    step = F.floor(F.log(F.col("n").cast("double")) * 64)
    reached, least = 0, (1 << 62)
    for _, n, low in sorted(counts.groupBy(step).agg(F.count("*"), F.min("n")).collect(), reverse=True):
        reached += n
        if reached > most:
            return least
        least = low
    return 1


def vocabulary_of(counts: DataFrame) -> Vocabulary:
    total, words = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.where(F.col("n") >= _least_count(counts)).toArrow().sort_by([("n", "descending"), ("h", "ascending")])
    return Vocabulary(top.column("h").to_numpy(), top.column("n").to_numpy(), int(total), int(words))


def rare_masses(counts: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Sum of count + 1 of the words without a number, by the last bits of their hashes:
    one row for each that occurs, 2 ** 18 at most, comes to the driver."""
    out = np.zeros(1 << (ITEM_BITS - 1))
    if vocabulary.words > len(vocabulary.hashes):
        rare = counts.where(F.col("n") < int(vocabulary.counts[-1])) if len(vocabulary.counts) else counts
        got = rare.groupBy(F.col("h").bitwiseAND((1 << (ITEM_BITS - 1)) - 1).alias("item")).agg(
            F.sum(F.col("n") + 1).alias("mass")).toArrow()
        out[got.column("item").to_numpy()] = got.column("mass").to_numpy()
    return out


def empty_model(vocabulary: Vocabulary, classes: np.ndarray, rare: np.ndarray | None = None) -> Model:
    """Shares by count alone: no weights yet."""
    n = len(vocabulary.hashes)
    weight = vocabulary.counts + 1.0
    mass = np.bincount(classes[:n], weight, CLASSES)
    total = float(vocabulary.tokens - vocabulary.counts.sum() + vocabulary.words - n + 1)
    mass[CLASSES - 1] += total
    bias = np.log(np.maximum(mass, 1e-3) / np.maximum(mass, 1e-3).sum()).astype(np.float32)
    share = np.zeros(1 << ITEM_BITS)
    share[:n] = weight / mass[classes[:n]]
    if rare is not None:
        share[1 << (ITEM_BITS - 1):] = rare / total
    return Model(vocabulary, classes, bias, np.zeros((TABLES * ROWS, CLASSES), np.float32), share, total)


def train(texts: DataFrame, vocabulary: Vocabulary, rare: np.ndarray | None = None) -> Model:
    """The class factor of ``texts(row, numbers)``. To the driver come sums by kind of text and
    frequent word, a count per numbered word and kind of text, both over all texts, and, each
    round, one summed change per weight row."""
    anchors = min(ANCHORS, len(vocabulary.hashes))
    kind, = counted_kinds(texts, len(vocabulary.hashes), [text_kinds(texts, anchors, KINDS, 3)])
    model = empty_model(vocabulary, classes_of(vocabulary, kind), rare)
    for k in range(ROUNDS):  # each round its own share of the texts
        train_round(model, texts.where(F.pmod(F.xxhash64("row", F.lit(23)), F.lit(ROUNDS)) == k))
    return model


START = np.uint64(0x51_7CC1_B727_220A)


def _key(a: np.ndarray, b: np.ndarray, what: int) -> np.ndarray:
    """A 64-bit key of each pair."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + np.uint64(what * 0x632BE59BD9B4E019 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + b * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def pair_keys(hashes: np.ndarray, numbers: np.ndarray, sizes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Key of each token's pair, for texts that stand one after another: a hash of the
    word before (at a text's start, of that) and the token's class, then the word."""
    prior = np.empty_like(hashes)
    prior[1:] = hashes[:-1]
    prior[np.cumsum(sizes) - sizes] = START
    low = np.uint64((1 << ITEM_BITS) - 1)
    rare = np.uint64(1 << (ITEM_BITS - 1))
    item = np.where(numbers < len(classes) - 1, numbers.astype(np.uint64), rare | (hashes & (rare - np.uint64(1))))
    return ((_key(prior, classes[numbers].astype(np.uint64), 1) & ~low) | item) << np.uint64(1)


def fitted(keys: np.ndarray, n: np.ndarray, share: np.ndarray, variance: float = VARIANCE) -> np.ndarray:
    """What each of the sorted ``keys`` adds to its word's log share of the class: its
    weight, less the log of its normaliser.

    Keys of one previous word and class share a normaliser, over which the words
    without a weight keep their shares. Weights of the pairs that occur (``n`` times in
    training) maximise the likelihood of these counts under a Gaussian prior, by exact
    Newton steps; pairs that are only asked for have none."""
    if not len(keys):
        return np.zeros(0)
    group = keys >> np.uint64(ITEM_BITS + 1)
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    home = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
    q = share[(keys >> np.uint64(1) & np.uint64((1 << ITEM_BITS) - 1)).astype(np.int64)]
    sums = lambda x: np.add.reduceat(x, first)[home]
    occurs, total, weight = n > 0, sums(n).astype(np.float64), np.zeros(len(keys))
    for _ in range(FIT_STEPS):
        p = np.where(occurs, q * np.exp(weight), 0) / (1 + sums(q * np.expm1(weight)))
        own = total * p + 1 / variance
        ahead = np.where(occurs, n - total * p - weight / variance, 0) / own
        # the Hessian is this diagonal less total * p p': solved by its rank of one
        step = ahead + p / own * total * sums(p * ahead) / (1 - total * sums(p * p / own))
        weight += np.clip(step, -LONGEST, LONGEST)
    return weight - np.log1p(np.add.reduceat(q * np.expm1(weight), first))[home]


def _planes(values: np.ndarray, width: int) -> bytes:
    """The lowest bytes of whole numbers, place by place: this compresses well."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _from_planes(data: bytes, width: int) -> np.ndarray:
    size = len(data) // width
    out = np.zeros((size, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, size).T
    return out.view("<i8")[:, 0]


#: logs travel as whole multiples of this, in three bytes
_UNIT = 2.0 ** -18


def _packed_logs(x: np.ndarray) -> bytes:
    return _planes(np.clip(np.rint(x / _UNIT), -(1 << 23), (1 << 23) - 1).astype(np.int64), 3)


def _unpacked_logs(data: bytes) -> np.ndarray:
    x = _from_planes(data, 3)
    return np.where(x >> 23, x - (1 << 24), x) * _UNIT


def block_bits(spark: SparkSession, tokens: int) -> int:
    """Pairs are dealt to 2 ** this blocks by the first bits of their keys: some for
    each shuffle partition, and no more than about 2 ** 22 tokens' pairs in one."""
    return max(4, (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length(), (tokens >> 22).bit_length())


_ASKED = "chunk long, first long, last long, block int, keys binary, n binary, words binary, m binary"
_TOLD = "chunk long, first long, last long, block int, logs binary, counts binary"


def asked(texts: DataFrame, model: Model, bits: int) -> DataFrame:
    """Each chunk's messages to the blocks: its distinct pairs and its distinct words without a
    number, sorted, each with its count in the chunk's training texts. A chunk whose
    rows are read by several tasks sends messages for each part, the rows ``first`` to ``last``."""
    shared = texts.sparkSession.sparkContext.broadcast((model.vocabulary.hashes, model.classes))
    arrow = pa.schema([("chunk", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("block", pa.int32()),
                       *[(c, pa.binary()) for c in ("keys", "n", "words", "m")]])

    def message(at: int, rows: list[int], held: list[tuple]) -> Iterator[pa.RecordBatch]:
        columns = []
        for kind in (0, 1):  # pairs, then words
            key = np.sort(np.concatenate([h[kind] | np.uint64(h[2]) for h in held]))
            learns, key = (key & np.uint64(1)).astype(np.int64), key & ~np.uint64(1)
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
            columns.append((key[first], np.add.reduceat(learns, first) if len(key) else learns))
        (pairs, n), (words, w) = columns
        homes = [u >> np.uint64(64 - bits) for u in (pairs, words)]
        blocks = np.unique(np.concatenate(homes))
        cuts = [[np.searchsorted(h, blocks, side).tolist() for side in ("left", "right")] for h in homes]
        out = [(at, min(rows), max(rows), block, _planes(pairs[i:j], 8), _planes(n[i:j], 4), _planes(words[k:m], 8), _planes(w[k:m], 4))
               for block, i, j, k, m in zip(blocks.tolist(), *cuts[0], *cuts[1])]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    def run(batches):
        hashes, classes = shared.value
        hashes = np.append(hashes, 0).view(np.uint64)
        at, rows, held, tokens = None, [], [], 0
        for batch in batches:
            chunks, learns = batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            for chunk in dict.fromkeys(chunks.tolist()):
                if held and (chunk != at or tokens >= CHUNK):
                    yield from message(at, rows, held)
                    rows, held, tokens = [], [], 0
                at = chunk
                for learn in (False, True):
                    some = batch.filter(pa.array((chunks == chunk) & (learns == learn)))
                    if some.num_rows:
                        numbers, own, sizes, rare = words_of(some.column(3), some.column(4), hashes)
                        keys = pair_keys(own, numbers, sizes, classes)
                        held.append((keys[classes[numbers] != CLASSES - 2], own[rare] & ~np.uint64(1), int(learn)))
                        rows += some.column(1).to_pylist()
                        tokens += len(numbers)
        if held:
            yield from message(at, rows, held)

    return texts.select("chunk", "row", "learn", "numbers", "rare").mapInArrow(run, _ASKED)


def words_of(numbers: pa.Array, rare: pa.Array, hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Numbers and hashes of all words of some texts, the texts' sizes, and where the words without a number stand."""
    flat, sizes = _lists(numbers)
    own = hashes[flat]
    where = np.flatnonzero(flat == len(hashes) - 1)
    own[where] = _lists(rare, "<u8")[0]
    return flat, own, sizes, where


def told(messages: DataFrame, model: Model) -> DataFrame:
    """The blocks' answers: each message's pairs' logs and its words' counts, in its order. A block's
    messages are added up and its weights trained in one task."""
    shared = messages.sparkSession.sparkContext.broadcast((model.share, VARIANCE))
    arrow = pa.schema([("chunk", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("block", pa.int32()),
                       ("logs", pa.binary()), ("counts", pa.binary())])

    def sums(keys: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        parts = [_from_planes(k, 8).view(np.uint64) for k in keys]
        every = np.concatenate(parts)
        order = np.argsort(every, kind="stable")  # sorted runs: merged
        ordered = every[order]
        new = np.append(True, ordered[1:] != ordered[:-1])[:len(every)]
        first = np.flatnonzero(new)
        n = np.concatenate([_from_planes(c, 4) for c in counts])[order]
        place = np.empty(len(every), np.int64)
        place[order] = np.cumsum(new) - 1
        return ordered[first], np.add.reduceat(n, first) if len(n) else n, place, np.cumsum([0, *map(len, parts)]).tolist()

    def answer(block: pa.Table) -> pa.Table:
        columns = {c: block.column(c).to_pylist() for c in ("keys", "n", "words", "m")}
        keys, n, place, cuts = sums(columns["keys"], columns["n"])
        logs = fitted(keys, n, *shared.value)[place]
        _, m, where, ends = sums(columns["words"], columns["m"])
        m = m[where]
        return pa.Table.from_arrays(
            [*[block.column(c).combine_chunks() for c in ("chunk", "first", "last", "block")],
             pa.array([_packed_logs(logs[i:j]) for i, j in zip(cuts, cuts[1:])], pa.binary()),
             pa.array([_planes(m[i:j], 5) for i, j in zip(ends, ends[1:])], pa.binary())], schema=arrow)

    return messages.groupBy("block").applyInArrow(answer, _TOLD)


def score_texts(texts: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score`` of
    ``texts(doc_id, row, chunk, learn, numbers, rare)``. A task holds a chunk's texts and answers."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(model)
    base = float(np.log10(model.vocabulary.tokens + 1.0 * (model.vocabulary.words + 1)))
    schema = StructType([texts.schema["doc_id"], StructField("n_tokens", LongType()), StructField("n_known", LongType()),
                         StructField("base_score", DoubleType()), StructField("score", DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        m = shared.value
        if not left.num_rows:
            return arrow.empty_table()
        left = left.sort_by("row").combine_chunks()
        hashes = np.append(m.vocabulary.hashes, 0).view(np.uint64)
        numbers, own, sizes, rare = words_of(left.column("numbers").chunk(0), left.column("rare").chunk(0), hashes)
        begin, row = np.cumsum(sizes) - sizes, left.column("row").to_numpy()
        keys, several = pair_keys(own, numbers, sizes, m.classes), m.classes[numbers] != CLASSES - 2
        seen, log_p = np.append(m.vocabulary.counts, 0).astype(np.float64)[numbers], m.token_scores(numbers, sizes)
        parts: dict[tuple[int, int], list[tuple]] = {}
        for first, last, block, logs, counts in zip(*(right.column(c).to_pylist() for c in ("first", "last", "block", "logs", "counts"))):
            parts.setdefault((first, last), []).append((block, logs, counts))
        ends = np.append(begin, len(numbers))
        for (first, last), answers in parts.items():
            i, j = ends[np.searchsorted(row, first)], ends[np.searchsorted(row, last, side="right")]
            answers.sort()
            token = i + np.flatnonzero(several[i:j])
            _, place = np.unique(keys[token], return_inverse=True)
            log_p[token] += np.concatenate([_unpacked_logs(a) for _, a, _ in answers])[place]
            word = rare[np.searchsorted(rare, i):np.searchsorted(rare, j)]
            _, place = np.unique(own[word] & ~np.uint64(1), return_inverse=True)
            seen[word] = np.concatenate([_from_planes(c, 5) for *_, c in answers])[place]
        log_p[rare] += np.log(seen[rare] + 1.0) - np.log(m.rare_total)
        sums = lambda x: np.add.reduceat(x, begin)
        return pa.Table.from_arrays(
            [left.column("doc_id").combine_chunks().cast(arrow.field(0).type), pa.array(sizes.astype(np.int64)),
             pa.array(sums((seen > 0).astype(np.int64))), pa.array(sums(np.log10(seen + 1.0)) - sizes * base),
             pa.array(sums(log_p) / np.log(10))], schema=arrow)

    answers = told(asked(texts, model, block_bits(spark, model.vocabulary.tokens)), model)
    return (texts.select("doc_id", "row", "chunk", "numbers", "rare").groupBy("chunk")
            .cogroup(answers.groupBy("chunk")).applyInArrow(run, schema))


def language_model_scores(docs: DataFrame) -> DataFrame:
    """Learn from the rows that aren't held out, score all: ``doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score``.

    Null and empty texts are one token, the end. Null ids belong to the training
    rows; repeated rows count and are scored one by one; an unknown word has the share
    of one that was never counted; extra columns are not carried. An empty table gives
    an empty result."""
    texts = texts_of(docs)
    learn = texts.where(~held_out(F.col("doc_id")))
    counts = staged(word_counts(learn), "lm-counts")
    vocabulary = vocabulary_of(counts)
    ready = numbered(docs, vocabulary)
    model = train(ready.where(~held_out(F.col("doc_id"))), vocabulary, rare_masses(counts, vocabulary))
    scored = score_texts(ready.withColumn("learn", ~held_out(F.col("doc_id"))), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
                         F.lit(model.vocabulary.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(table(spark, sf_dir, "documents"))
