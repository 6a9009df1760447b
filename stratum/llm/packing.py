"""Sum-of-squares packing of tokenised documents into fixed-length sequences.

Documents become token ids and one closing id; only documents longer than a
sequence are cut, so that all pieces but the first are full. Pieces are dealt
evenly to shards of bounded size. In a shard, longest first, each piece goes
to the open sequence that leaves the sum over all residual gaps of (number of
open sequences with that gap) squared smallest; a full sequence leaves the
count. A new sequence is opened only when no open one has room. That choice
keeps the gaps varied, so later pieces find exact fits.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from stratum.llm.common import explode_texts, staged, table, unused

#: pieces a shard may hold: its packing runs in one task's memory
SHARD_PIECES = 60_000
#: room for sequences in one shard's block of sequence ids
ID_BLOCK = 1 << 32
#: Letters and numbers outside these blocks are newer than some Unicode tables;
#: texts that hold others are split by the tokenizer's own tables.
OLD_BLOCKS = re.compile("[^\x00-ԯḀ-➿　-龥가-힣＀-￯]")


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write bytes with."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokens:
    """Token ids as the tokenizers library gives them for a byte-level file.

    The same merges run in a faster library where the file allows it: its ids
    must be the order of its merges, and added tokens plain strings. Texts are
    cut at added tokens first, as the library does by default."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        import public_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.slow = Tokenizer.from_file(path)
        alphabet = _byte_alphabet()
        added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in added}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        in_order = [spec["model"]["vocab"][a + b] for a, b in pairs] == list(range(256, 256 + len(pairs)))
        pre = spec["pre_tokenizer"]
        self.fast = None
        if (in_order and spec["normalizer"] is None and pre["type"] == "ByteLevel"
                and not pre["add_prefix_space"] and pre["use_regex"]
                and not any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec["added_tokens"])):
            self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN,
                                          mergeable_ranks=ranks, special_tokens={})
        self.added = added
        self.cut = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or OLD_BLOCKS.search(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        if self.cut is None or not self.cut.search(text):
            return self._plain(text)
        parts = [np.array([self.added[p]], np.uint32) if p in self.added else self._plain(p)
                 for p in self.cut.split(text)]
        return np.concatenate(parts)

    def _plain(self, text: str) -> np.ndarray:
        return self.fast.encode_to_numpy(text, disallowed_special=())


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


def token_pieces(df: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every whole text: its ids,
    then ``end_id``; longer ones in pieces, of which the first takes the rest."""
    def setup():
        t = tokens(tokenizer_path)

        def pieces(text):
            ids = np.append(t.ids(text), np.uint32(end_id)).astype("<u4")
            ends = list(range(len(ids) % capacity or capacity, len(ids) + 1, capacity))
            out, start = [], 0
            for k, end in enumerate(ends):
                out.append((k, start, end - start, zlib.crc32(ids[start:end])))
                start = end
            return out
        return pieces

    return explode_texts(df, setup, [StructField("piece", IntegerType()), StructField("start", LongType()),
                                     StructField("length", LongType()),
                                     StructField("ids_crc32", LongType())], id_col, text_col)


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset for each length, by the sum-of-squares rule."""
    place = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    count = np.zeros(capacity + 1, np.int64)  # open sequences by gap
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    made, none = 0, np.int64(1 << 60)
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        gap = capacity
        if size < capacity:
            # by the gap that would be left: one such sequence more, one of the gap before less
            change = 2 * (count[:capacity + 1 - size] - count[size:]) + 2
            change[0] = 1 - 2 * count[size]
            left = int(np.where(count[size:] > 0, change, none).argmin())
            if count[size + left]:
                gap = size + left
        if gap < capacity:
            at = open_at[gap].pop()
            count[gap] -= 1
        else:
            at, made = made, made + 1
        place[i], offset[i] = at, capacity - gap
        if gap > size:
            count[gap - size] += 1
            open_at[gap - size].append(at)
    return place, offset


def pack(pieces: DataFrame, capacity: int = 2048, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` (with a ``length`` up to ``capacity``) and, for each, its
    ``sequence_id`` and ``offset``; offsets of a sequence have no gaps.

    Rows are dealt to shards by row, not by key, so repeated rows and hot ids
    spread evenly; the number of shards follows the number of rows."""
    rows = staged(pieces, "pack-pieces")
    shards = -(-rows.count() // shard_pieces) or 1
    in_shard, in_row = unused(rows, "shard"), unused(rows, "row")
    dealt = rows.withColumn(in_shard, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    out = StructType([*rows.schema.fields, StructField("sequence_id", LongType()),
                      StructField("offset", LongType())])
    names = [f.name for f in rows.schema.fields]

    def place(group):
        import pyarrow as pa

        # rows arrive in any order: a fixed one makes a repeated task give the same places
        group = group.sort_by([(in_row, "ascending")])
        seq, off = pack_lengths(group.column("length").to_numpy().astype(np.int64), capacity)
        shard = group.column(in_shard)[0].as_py()
        return (group.select(names).append_column("sequence_id", pa.array(seq + shard * ID_BLOCK, pa.int64()))
                .append_column("offset", pa.array(off, pa.int64())))

    return (dealt.withColumn(in_row, F.monotonically_increasing_id())
            .groupBy(in_shard).applyInArrow(place, out))


def pack_texts(df: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise and pack every row: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``.

    Null and empty texts are one piece, the closing id. Null ids, ties and
    repeated rows are packed row by row. Extra columns are not carried. An empty
    table gives an empty result."""
    return pack(token_pieces(df, tokenizer_path, capacity, end_id, id_col, text_col), capacity)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
