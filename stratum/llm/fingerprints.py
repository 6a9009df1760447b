"""Homomorphic multiset fingerprints of documents.

A text is the multiset of its paragraphs (lines). Each paragraph is hashed to
a wide vector and a text's fingerprint is the sum of its paragraphs' vectors,
modulo a power of two. So the order of paragraphs doesn't matter, and adding
or removing a paragraph is one vector addition or subtraction.

The vector has two parts. ``EQUAL`` lanes of 64 bits hold a keyed hash of the
whole paragraph, for equality. ``LIKE`` lanes of 32 bits hold a signed count
sketch of the paragraph's distinct neighbouring word pairs, also a sum, so it
stays additive; the cosine of two sketches estimates how much of two texts is the
same words in the same surroundings.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from stratum.llm.common import map_texts, table, texts_of

#: lanes of the two parts; together the fingerprint has 8 * 8 + 4 * 192 bytes
EQUAL, LIKE = 8, 192
MEMO = 400_000
#: paragraphs of fewer words also count their character trigrams
SHORT = 8
MIX = np.uint64(0x9E3779B97F4A7C15)


class Multiset:
    """The running fingerprint of a set of paragraphs."""

    def __init__(self, equal=None, like=None):
        self.equal = np.zeros(EQUAL, np.uint64) if equal is None else equal
        self.like = np.zeros(LIKE, np.int32) if like is None else like

    def __add__(self, other: "Multiset") -> "Multiset":
        return Multiset(self.equal + other.equal, self.like + other.like)

    def __sub__(self, other: "Multiset") -> "Multiset":
        return Multiset(self.equal - other.equal, self.like - other.like)

    def __eq__(self, other) -> bool:
        return self.equal.tobytes() == other.equal.tobytes()

    def hex(self) -> str:
        return self.equal.astype("<u8").tobytes().hex() + self.like.astype("<i4").tobytes().hex()

    def likeness(self, other: "Multiset") -> float:
        """0 to 1; 1 for equal multisets, near 0 for unrelated texts."""
        if self == other:
            return 1.0
        a, b = self.like.astype(np.float64), other.like.astype(np.float64)
        norm = float(np.sqrt((a @ a) * (b @ b)))
        return min(1.0, max(0.0, float(a @ b) / norm)) if norm else 0.0

    @classmethod
    def from_hex(cls, text: str) -> "Multiset":
        data = bytes.fromhex(text)
        return cls(np.frombuffer(data[:8 * EQUAL], "<u8").copy(), np.frombuffer(data[8 * EQUAL:], "<i4").copy())


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * MIX
    x ^= x >> np.uint64(32)
    return x * MIX


def trigrams(words: list[str]) -> list[bytes]:
    text = " ".join(words)
    return [text[i:i + 3].encode() for i in range(max(1, len(text) - 2))]


class Hasher:
    def __init__(self):
        self.words: dict[str, int] = {}

    def paragraphs(self, parts: list[str]) -> Multiset:
        """The sum of the vectors of ``parts``."""
        whole = np.frombuffer(b"".join([hashlib.blake2b(p.encode(), digest_size=8 * EQUAL).digest()
                                        for p in parts]), "<u8").reshape(-1, EQUAL)
        equal = whole.sum(axis=0, dtype=np.uint64)
        split = [p.split() for p in parts]
        flat = [w for ws in split for w in ws]
        if not flat:
            return Multiset(equal)
        memo = self.words
        if len(memo) > MEMO:
            memo.clear()
        for w in set(flat).difference(memo):
            memo[w] = xxhash.xxh64_intdigest(w.encode())
        h = np.fromiter(map(memo.__getitem__, flat), np.uint64, len(flat))
        sizes = [len(ws) for ws in split]
        home = np.repeat(np.arange(len(parts), dtype=np.uint64), sizes)
        before = np.roll(h, 1)
        before[np.flatnonzero(np.diff(home, prepend=home[0] + np.uint64(1)))] = 0  # pairs don't cross paragraphs
        pair = mixed(h ^ (before * MIX + (before >> np.uint64(29))))
        short = [(k, g) for k, ws in enumerate(split) if 0 < len(ws) < SHORT for g in trigrams(ws)]
        if short:
            pair = np.append(pair, mixed(np.array([xxhash.xxh64_intdigest(g, 7) for _, g in short], np.uint64)))
            home = np.append(home, np.array([k for k, _ in short], np.uint64))
        # once a paragraph: repetition inside one doesn't drown the rest
        _, kept = np.unique(mixed(pair ^ (home * MIX)), return_index=True)
        pair = pair[kept]
        lane = ((pair >> np.uint64(40)) % np.uint64(LIKE)).astype(np.int64)
        sign = 1.0 - 2.0 * ((pair >> np.uint64(39)) & np.uint64(1)).astype(np.float64)
        like = np.bincount(lane, sign, LIKE).astype(np.int64).astype(np.int32)
        return Multiset(equal, like)

    def text(self, text: str) -> Multiset:
        return self.paragraphs(text.split("\n"))

    def replaced(self, mark: Multiset, text: str, keep: int, new: str) -> tuple[Multiset, str]:
        """Fingerprint and text after all behind the first ``keep`` characters is
        replaced by ``new``: paragraphs that go are subtracted, those that come
        are added, the others aren't read again."""
        edited = text[:keep] + new
        at = text.rfind("\n", 0, keep) + 1  # start of the paragraph the edit begins in
        gone, came = text[at:].split("\n"), edited[at:].split("\n")
        return mark - self.paragraphs(gone) + self.paragraphs(came), edited


@lru_cache(maxsize=1)
def hasher() -> Hasher:
    return Hasher()


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (hex) of every whole text; a null text is empty.
    Narrow: no shuffle."""
    def setup():
        h = hasher()
        return lambda texts: [[h.text(t).hex() for t in texts]]
    return map_texts(df, setup, [StructField("fingerprint", StringType())], id_col, text_col)


#: sampled keys for each range
KEYS_A_RANGE = 50


def _range_of(key: Column, cuts: list[Column]) -> Column:
    """How many of the ascending ``cuts`` are below ``key``: first among every
    so-manieth of them, then among those between."""
    if not cuts:
        return F.lit(0)
    step = int(len(cuts) ** 0.5) + 1
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]

    def below(some: Column) -> Column:
        return F.aggregate(some, F.lit(0), lambda n, c: n + F.when(key > c, 1).otherwise(0))
    coarse = below(F.array(*[g[0] for g in groups]))  # the group that ends below the key
    rest = F.array(*[F.array(*g) for g in groups])
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + below(F.get(rest, coarse - 1)))


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              ranges: int | None = None) -> DataFrame:
    """``doc_id, text, h, row, range, tail``: rows dealt to contiguous ranges of ascending
    keys, and for each range a ``tail``: the first text of the next range that holds rows, of
    the last range that of the first.

    A key is the id (null ones first), a hash of the text and the row's number, so rows that share
    an id, or are equal, are dealt to several ranges as well. Cuts come from a sample of
    KEYS_A_RANGE keys a range, over all rows by a hash; the driver holds these, and one
    id and hash a range."""
    spark = df.sparkSession
    rows = texts_of(df, id_col, text_col).withColumns({"h": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    id_type = rows.schema["doc_id"].dataType
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "h", "row")
    share = min(1.0, KEYS_A_RANGE * ranges / max(1, rows.count()))
    place = F.xxhash64("doc_id", "h", "row").cast("double") / F.lit(2.0 ** 64) + 0.5
    keys = [r.key for r in rows.where(place < share).select(key.alias("key")).orderBy("key").collect()]
    chosen = [keys[i * len(keys) // ranges] for i in range(1, ranges)] if keys else []
    cuts = [F.struct(F.lit(k.some).alias("some"), F.lit(k.doc_id).cast(id_type).alias("doc_id"),
                     F.lit(k.h).alias("h"), F.lit(k.row).alias("row")) for k in dict.fromkeys(chosen)]
    dealt = rows.withColumn("range", _range_of(key, cuts))
    heads = sorted((r.range, r.head) for r in dealt.groupBy("range").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "h")).alias("head")).collect())
    if not heads:
        return dealt.withColumn("tail", F.lit(False))
    follow = [(at, head.doc_id, head.h) for (at, _), (_, head) in zip(heads, [*heads[1:], heads[0]])]
    asked = F.broadcast(spark.createDataFrame(follow, StructType([  # a row for each range
        StructField("to", IntegerType()), StructField("id", id_type), StructField("hash", LongType())])))
    tails = (rows.join(asked, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("hash")))
             .groupBy("to", "id", "hash").agg(F.first("text").alias("text")))
    return dealt.withColumn("tail", F.lit(False)).unionByName(tails.select(
        F.col("id").alias("doc_id"), "text", F.col("hash").alias("h"), F.lit(0).cast("long").alias("row"),
        F.col("to").alias("range"), F.lit(True).alias("tail")))


def edited_neighbours(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      ranges: int | None = None) -> DataFrame:
    """Fingerprint of each whole text and of its edited text: the last half (in
    code points, rounded down) replaced by as much of the next document's start.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. Next is by ascending id, of any type that sorts, then by a
    hash of the text; after the last
    comes the first. A null text is empty; null ids come first; repeated rows
    follow one another as rows of their own; a single row is its own next; an
    empty table gives an empty result; extra columns are not carried."""
    dealt = with_next(df, id_col, text_col, ranges)
    schema = StructType([dealt.schema["doc_id"], StructField("n_chars", LongType()),
                         StructField("edited_sha256", StringType()), StructField("fingerprint", StringType()),
                         StructField("edited_fingerprint", StringType()),
                         StructField("near_edited", DoubleType()), StructField("near_next", DoubleType())])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        h, arrow = hasher(), to_arrow_schema(schema)

        def line(now, follow):
            doc_id, text, mark = now
            half = len(text) // 2
            new, edited = h.replaced(mark, text, len(text) - half, follow[1][:half])
            return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), mark.hex(), new.hex(),
                    mark.likeness(new), mark.likeness(follow[2]))

        def out(rows):
            columns = zip(*rows) if rows else [[] for _ in arrow]
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow)],
                                              schema=arrow)

        held, held_range = None, None
        for batch in batches:
            rows = []
            for doc_id, text, at, tail in zip(*(c.to_pylist() for c in batch.columns)):
                now = (doc_id, text, h.text(text))
                if held is not None and held_range == at:
                    rows.append(line(held, now))
                held, held_range = (None, None) if tail else (now, at)  # each range ends with its tail
            yield out(rows)

    sorted_rows = (dealt.repartition("range")
                   .sortWithinPartitions("range", "tail", F.col("doc_id").asc_nulls_first(), "h", "row"))
    return sorted_rows.select("doc_id", "text", "range", "tail").mapInArrow(run, schema)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_neighbours(table(spark, sf_dir, "documents"))
