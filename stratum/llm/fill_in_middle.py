"""Fill-in-middle: cut a text at two unit borders and put its middle last.

Every character becomes a symbol of its own class and the class of the one after
it, so a unit's last character can be told by its symbol alone. The symbols of a
batch of texts stand in one ``WaveletMatrix``; a unit count up to a place is the
sum of the ranks of the symbols that end units, and a cut after ``k`` units is
found by bisection on these counts, for all texts of the batch together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stratum.llm.common import table, text_groups

WORD, SPACE, LINE, END = range(4)
#: class of each character up to the blank; all others are WORD
CLASSES = np.full(34, WORD, np.uint8)
CLASSES[[9, 11, 12, 13, 32]] = SPACE
CLASSES[10] = LINE
#: the (class, class after) of the characters that end a unit
UNITS = {
    "tokens": [(WORD, SPACE), (WORD, LINE), (WORD, END), (SPACE, END), (LINE, END)],
    "lines": [(LINE, WORD), (LINE, SPACE), (LINE, LINE), (LINE, END), (WORD, END), (SPACE, END)],
    "chars": [(a, b) for a in (WORD, SPACE, LINE) for b in (WORD, SPACE, LINE, END)],
}
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: characters of one matrix; a longer text has one of its own
BATCH_CHARS = 2_000_000


class Bits:
    """Ones before a place: 64 bits a word, with the ones before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, "<u8")
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:], dtype=np.int64)
        self.ones = int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Ranks of small symbols: a bit vector per bit, the highest first, each over
    the symbols ordered by the bits before it."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.size, self.levels = len(symbols), []
        for bit in range(bits - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            level = Bits(ones)
            self.levels.append((bit, level, self.size - level.ones))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before each of the places."""
        start, at = np.zeros(1, np.int64), at
        for bit, level, zeros in self.levels:
            if symbol >> bit & 1:
                start, at = zeros + level.rank(start), zeros + level.rank(at)
            else:
                start, at = start - level.rank(start), at - level.rank(at)
        return at - start


class Borders:
    """Unit counts and cuts of texts joined end to end; ``starts`` has the place
    of each text and, last, the end of all."""

    def __init__(self, joined: str, starts: np.ndarray, unit: str = "tokens"):
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        kinds = CLASSES[np.minimum(points, 33)]
        after = np.append(kinds[1:], END).astype(np.uint8)
        filled = np.diff(starts) > 0
        after[starts[1:][filled] - 1] = END
        self.ends = [a << 2 | b for a, b in UNITS[unit]]
        self.matrix = WaveletMatrix(kinds << 2 | after, 4)
        self.starts, self.stops = starts[:-1], starts[1:]
        self.first = self.count(self.starts)
        #: units of each text
        self.units = self.count(self.stops) - self.first

    def count(self, at: np.ndarray) -> np.ndarray:
        return sum(self.matrix.rank(s, at) for s in self.ends)

    def cut(self, k: np.ndarray) -> np.ndarray:
        """The place after the first ``k`` units of each text."""
        low, high, want = self.starts.copy(), self.stops.copy(), self.first + k
        while (open_ := low < high).any():
            mid = (low + high) >> 1
            short = open_ & (self.count(mid) < want)
            low, high = np.where(short, mid + 1, low), np.where(open_ & ~short, mid, high)
        return low


def rearrange(texts: list[str], draws: list[np.ndarray], rate: int, spm_rate: int,
              unit: str = "tokens") -> list[list]:
    """``n, form, prefix_chars, middle_chars, output`` of each text, by lists."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    borders = Borders("".join(texts), starts, unit)
    a, b, chosen, kind = draws
    one, two = a % (borders.units + 1), b % (borders.units + 1)
    first = (borders.cut(np.minimum(one, two)) - borders.starts).tolist()
    second = (borders.cut(np.maximum(one, two)) - borders.starts).tolist()
    rows = []
    for text, n, i, j, plain, spm in zip(texts, borders.units.tolist(), first, second,
                                         (chosen % 100 >= rate).tolist(), (kind % 100 < spm_rate).tolist()):
        if plain or not text or PREFIX in text or SUFFIX in text or MIDDLE in text:
            rows.append((n, "plain", None, None, text))
            continue
        head, mid, tail = text[:i], text[i:j], text[j:]
        made = (f"{SUFFIX}{tail}{PREFIX}{head}{MIDDLE}{mid}" if spm
                else f"{PREFIX}{head}{SUFFIX}{tail}{MIDDLE}{mid}")
        rows.append((n, "spm" if spm else "psm", i, j - i, made))
    return [list(c) for c in zip(*rows)]


def _draw(id_col: str, seed: int, k: int) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"draw{k}")


def fill_in_middle(df: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80, unit: str = "tokens",
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: ``rate`` percent of
    the texts rearranged, ``spm_rate`` percent of these with the suffix first.

    Cuts and forms are drawn from a digest of seed and id, so equal ids draw alike
    and a rerun gives the same rows. Texts that are null, empty or hold a marker stay plain;
    a null id draws as an empty one. Repeated rows stay rows; extra columns are
    not carried. Narrow: no shuffle."""
    source = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       *[_draw(id_col, seed, k) for k in range(4)])
    schema = StructType([source.schema["doc_id"], StructField("n", LongType()), StructField("form", StringType()),
                         StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()),
                         StructField("output", StringType())])
    arrow = to_arrow_schema(schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(1).to_pylist()
            draws = [part.column(2 + k).to_numpy() for k in range(4)]
            for i, j in text_groups(texts, BATCH_CHARS):
                made = rearrange(texts[i:j], [d[i:j] for d in draws], rate, spm_rate, unit)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(i, j - i).cast(arrow.field(0).type),
                     *[pa.array(c, f.type) for c, f in zip(made, list(arrow)[1:])]], schema=arrow)

    return source.mapInArrow(run, schema)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text again, from an output and its form alone."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    first, second, mid = (F.instr(output, m) for m in (PREFIX, SUFFIX, MIDDLE))

    def part(start: Column, stop: Column) -> Column:
        return F.substring(output, start + 3, stop - start - 3)
    rest = F.substring(output, mid + 3, F.length(output))
    return (F.when(form == "psm", F.concat(part(first, second), rest, part(second, mid)))
            .when(form == "spm", F.concat(part(first, mid), rest, part(second, first)))
            .otherwise(output))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


OP13_SQL = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
cuts AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n,
         CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS one, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS two,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT doc_id, t, n, form, array_to_string(u[:least(one, two)], '') AS p,
         array_to_string(u[least(one, two) + 1:greatest(one, two)], '') AS m,
         array_to_string(u[greatest(one, two) + 1:], '') AS s
  FROM cuts)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
