"""SimHash near duplicates through Gray-ordered hierarchical indexes.

Fingerprints. Bit i is 1 if it is set in over half of the 64-bit hashes of the
text's word shingles, repeats included.

Links. Two fingerprints that differ in at most d bits agree on at least one of
d + 1 blocks of bits, so each distinct fingerprint is listed under its d + 1
block values. The lists are sorted by block value and Gray rank and dealt to
tasks by range, so a hot block value is spread over tasks. Runs of the sorted
rows get a hierarchical index: neighbours in Gray order share most bits, a
node holds the bits that all below it share and the nodes above it don't
already hold, and a search adds up differences on the way down and drops a
whole group as soon as they exceed d. A list that continues in other runs
leaves a tile there; tiles of one list are compared in pairs, unless their
shared bits alone differ too much. Each run and pair gives links that connect
what it found connected, never all its pairs.

Groups. The links' connected components.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from stratum.llm.common import map_texts, staged, table
from stratum.llm.components import components

BITS = 64
#: rows of a run: bounds a task's memory, not the result
RUN = 4096
FAN = 8
#: pairs held before they are reduced to connecting links
HELD_PAIRS = 1_000_000
SEED = 42


def shingle_hashes(text: str, words: int) -> list[int]:
    tokens = text.encode().lower().split()
    if len(tokens) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(tokens), SEED)] if tokens else []
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = np.append(0, ends[:len(tokens) - words]).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[words - 1:] - 1).tolist())]


def simhash(text: str, words: int = 4) -> int:
    hashes = np.array(shingle_hashes(text, words), "<u8")
    if not len(hashes):
        return 0
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


class GrayIndex:
    """Index over fingerprints in list and Gray order; ``group`` is their list."""

    def __init__(self, fps: np.ndarray, group: np.ndarray):
        mask, pattern = np.full(len(fps), ~np.uint64(0)), fps
        first = last = group
        levels = [(mask, pattern, first, last)]
        while len(pattern) > 1:
            at = np.arange(0, len(pattern), FAN)
            lead = np.repeat(pattern[at], np.diff(np.append(at, len(pattern))))
            mask = np.bitwise_and.reduceat(mask & ~(pattern ^ lead), at)
            pattern = pattern[at] & mask
            first, last = first[at], last[np.minimum(at + FAN, len(last)) - 1]
            levels.append((mask, pattern, first, last))
        self.levels = []
        above = np.zeros(1, np.uint64)
        for mask, pattern, first, last in reversed(levels):
            own = mask & ~above  # what nodes above hold already isn't compared again
            self.levels.append((own, pattern, first, last))
            above = np.repeat(mask, FAN)[:len(levels[len(levels) - len(self.levels) - 1][0])] \
                if len(self.levels) < len(levels) else above

    def within(self, queries: np.ndarray, group: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """All (query, member) positions of one list at distance ``most`` or less."""
        own, pattern, first, last = self.levels[0]
        q = np.arange(len(queries), dtype=np.int32)
        node = np.zeros(len(queries), np.int32)
        seen = np.zeros(len(queries), np.uint8)
        for depth, (own, pattern, first, last) in enumerate(self.levels):
            if depth:
                begin = node * FAN
                count = np.minimum(len(pattern) - begin, FAN)
                step = np.arange(count.sum(), dtype=np.int32) - np.repeat(np.cumsum(count) - count, count).astype(np.int32)
                node = np.repeat(begin, count) + step
                q, seen = np.repeat(q, count), np.repeat(seen, count)
            near = (first[node] <= group[q]) & (group[q] <= last[node])
            q, node, seen = q[near], node[near], seen[near]
            seen = seen + np.bitwise_count((queries[q] ^ pattern[node]) & own[node])
            near = seen <= most
            q, node, seen = q[near], node[near], seen[near]
        return q, node


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest connected position of each of ``n`` positions."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def connecting_links(queries: np.ndarray, query_group: np.ndarray, members: np.ndarray,
                     member_group: np.ndarray, most: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprints) that connect whatever pairs at distance ``most`` or
    less connect; ``same``: the queries are the members."""
    index = GrayIndex(members, member_group)
    shift = 0 if same else len(queries)
    n = len(members) + shift
    held_a, held_b, held = [], [], 0

    def reduce():
        root = _roots(np.concatenate(held_a), np.concatenate(held_b), n)
        a = np.flatnonzero(root != np.arange(n))
        return a, root[a]

    for at in range(0, len(queries), 256):
        q, m = index.within(queries[at:at + 256], query_group[at:at + 256], most)
        q, m = q.astype(np.int64) + at, m.astype(np.int64) + shift
        if same:
            q, m = q[m > q], m[m > q]
        held_a.append(q)
        held_b.append(m)
        held += len(q)
        if held > HELD_PAIRS:
            a, b = reduce()
            held_a, held_b, held = [a], [b], len(a)
    a, b = reduce()
    every = members if same else np.concatenate([queries, members])
    return every[a], every[b]


def gray_rank(fp: Column) -> Column:
    """Place of a bit pattern in Gray order (sorted as signed numbers)."""
    for step in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, step))
    return fp


def block_masks(most: int, blocks: int | None = None) -> list[int]:
    """Masks of all choices of ``blocks - most`` out of ``blocks`` blocks of bits
    (default: one block more than ``most``). More blocks make longer, rarer list
    values, for tables of far more fingerprints, and more lists."""
    blocks = blocks or most + 1
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    masks = [sum(c) for c in combinations(block, blocks - most)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def blocks_for(n: int, most: int) -> int:
    """Blocks for ``n`` distinct fingerprints: the fewest by which a list holds a run's
    rows at most, were the fingerprints evenly spread. The result is the same for any
    number; lists of few bits grow with the table, and what is compared in them with its square."""
    for blocks in range(most + 1, 2 * most + 2):
        if n <= RUN << (BITS * (blocks - most) // blocks):
            return blocks
    return 2 * most + 2


_FOUND = "a long, b long, list int, value long, shared long, pattern long, members binary"


def _runs(most: int):
    arrow = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("list", pa.int32()), ("value", pa.int64()),
                       ("shared", pa.int64()), ("pattern", pa.int64()), ("members", pa.binary())])

    def search(rows: list[np.ndarray]):
        lists, values, fps = rows
        new = np.append(True, (lists[1:] != lists[:-1]) | (values[1:] != values[:-1]))
        group = np.cumsum(new)
        fp = fps.view(np.uint64)
        a, b = connecting_links(fp, group, fp, group, most, True)
        none = [None] * len(a)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.view(np.int64)) for x in (a, b)] + [pa.array(none, f.type) for f in list(arrow)[2:]], schema=arrow)
        tiles = []
        for g in {1, int(group[-1])}:  # lists that may go on in other runs
            own = fp[group == g]
            shared = ~np.bitwise_or.reduce(own ^ own[0])
            i = int(np.argmax(group == g))
            tiles.append((None, None, int(lists[i]), int(values[i]), int(shared.view(np.int64)),
                          int((own[0] & shared).view(np.int64)), own.tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*tiles), arrow)], schema=arrow)

    def run(batches):
        kept = [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        for batch in batches:
            kept = [np.concatenate([k, batch.column(i).to_numpy()]) for i, k in enumerate(kept)]
            while len(kept[0]) >= RUN:
                yield from search([k[:RUN] for k in kept])
                kept = [k[RUN:] for k in kept]
        if len(kept[0]):
            yield from search(kept)
    return run


def _tile_pairs(most: int):
    arrow = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                a, b = connecting_links(x, np.ones(len(x), np.int64), y, np.ones(len(y), np.int64), most, False)
                yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)) for v in (a, b)], schema=arrow)
    return run


def hamming_links(distinct: DataFrame, most: int, blocks: int | None = None) -> DataFrame:
    """Links ``a, b`` between the fingerprints of ``distinct(fp)`` whose connected
    components are those of all pairs at distance ``most`` or less."""
    masks = block_masks(most, blocks)
    listed = distinct.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks]))
        .alias("list", "value")).withColumn("gray", gray_rank(F.col("fp")))
    order = ["list", "value", "gray"]
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = staged(listed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                   .select("list", "value", "fp").mapInArrow(_runs(most), _FOUND), "simhash-runs")
    tiles = (found.where("members IS NOT NULL").drop("a", "b")
             .withColumn("tile", F.xxhash64("members")))
    x, y = tiles.alias("x"), tiles.alias("y")
    apart = F.bit_count(F.col("x.pattern").bitwiseXOR(F.col("y.pattern"))
                        .bitwiseAND(F.col("x.shared")).bitwiseAND(F.col("y.shared")))
    pairs = (x.join(y, (F.col("x.list") == F.col("y.list")) & (F.col("x.value") == F.col("y.value"))
                    & (F.col("x.tile") < F.col("y.tile")) & (apart <= most))
             .select(F.col("x.members").alias("x"), F.col("y.members").alias("y")))
    across = pairs.repartition(parts).mapInArrow(_tile_pairs(most), "a long, b long")
    return found.where("members IS NULL").select("a", "b").unionByName(across)


def simhash_groups(df: DataFrame, words: int = 4, most: int = 4, blocks: int | None = None,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    Null, empty and blank texts have fingerprint zero and are linked like any
    other; repeated rows keep a row each; null ids are rows too, and the
    component id is the smallest id that isn't null (null if there is none).
    Extra columns are not carried. An empty table gives an empty result."""
    def setup():
        return lambda texts: [np.array([simhash(t, words) for t in texts], np.uint64).view(np.int64)]

    docs = staged(map_texts(df, setup, [StructField("fp", LongType())], id_col, text_col), "simhash-docs")
    distinct = staged(docs.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    blocks = blocks or blocks_for(distinct.count(), most)
    roots = components(hamming_links(distinct.select("fp"), most, blocks))
    # both written, so that the last join may split a large group's rows
    rooted = staged(distinct.join(roots, F.col("fp") == F.col("node"), "left")
                    .select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    smallest = staged(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-smallest")
    of = rooted.join(smallest, "root").select("fp", "component_id")
    return docs.join(of, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))
