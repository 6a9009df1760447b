"""Language identification, words first.

A word met in training scores its log frequency in each language. An unseen word
backs off to its character n-grams, the longest first: the mean log frequency of
those of its n-grams that are known, where none of them is, of the next shorter
ones. A text's score is the sum over its words; the prediction is the language
with the greatest sum, and its posterior under equal priors.

Words are counted by Spark over a bounded sample of the labelled texts, an even
share of characters for each language, so that a rare language is not lost beside
one that most rows hold. Equal texts count once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from stratum.llm.common import map_texts, table

#: characters of labelled text to learn from, over all languages (expected number)
SAMPLE_CHARS = 6_000_000
#: longest character n-gram, and in how many words of the sample one must stand
LONGEST, LEAST_WORDS = 5, 2
#: added to each count
PRIOR = 0.5
UNKNOWN = "und"
#: languages whose shares are broadcast
MAX_LANGUAGES = 100_000
#: unseen words whose scores a task remembers
MAX_WORDS = 200_000
_WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Stretches of letters, in lower case."""
    return _WORDS.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    """Its n-grams, its ends marked by blanks."""
    word = f" {word} "
    return [word[i:i + n] for i in range(len(word) - n + 1)]


class Model:
    """Log frequencies by language: a row for each known word and n-gram."""

    def __init__(self, languages: list[str], words: dict[str, np.ndarray]):
        """``words``: counts by language of each word."""
        self.languages = languages
        grams: dict[str, np.ndarray] = {}
        held: Counter = Counter()
        for word, counts in words.items():
            there = (counts > 0).astype(np.float64)
            for n in range(1, LONGEST + 1):
                for g in set(grams_of(word, n)):
                    held[g] += 1
                    if g in grams:
                        grams[g] += there
                    else:
                        grams[g] = there.copy()
        known = sorted(words)
        self.words = {w: i for i, w in enumerate(known)}
        self.word_rows = self._logs([words[w] for w in known])
        self.grams: dict[str, int] = {}
        blocks, at = [], 0
        for n in range(1, LONGEST + 1):
            some = sorted(g for g in grams if len(g) == n and held[g] >= LEAST_WORDS)
            self.grams |= {g: at + i for i, g in enumerate(some)}
            blocks.append(self._logs([grams[g] for g in some]))
            at += len(some)
        self.gram_rows = np.concatenate(blocks)

    def _logs(self, counts: list[np.ndarray]) -> np.ndarray:
        c = np.array(counts, np.float64).reshape(len(counts), len(self.languages)) + PRIOR
        return np.log(c / c.sum(axis=0)).astype(np.float32) if len(counts) else c.astype(np.float32)

    def unseen(self, word: str) -> np.ndarray | None:
        """Scores of a word that training has not met; None without any known
        character."""
        for n in range(LONGEST, 0, -1):
            rows = [r for r in map(self.grams.get, grams_of(word, n)) if r is not None]
            if rows:
                return self.gram_rows[rows].mean(axis=0, dtype=np.float64)
        return None


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.memo: dict[str, np.ndarray | None] = {}

    def predict(self, text: str) -> tuple[str, float]:
        model = self.model
        if not model.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        counts = Counter(words_of(text))
        total = np.zeros(len(model.languages))
        rows, times = [], []
        if len(self.memo) > MAX_WORDS:
            self.memo.clear()
        for word, c in counts.items():
            at = model.words.get(word)
            if at is not None:
                rows.append(at)
                times.append(c)
                continue
            if word not in self.memo:
                self.memo[word] = model.unseen(word)
            if (logs := self.memo[word]) is not None:
                total += c * logs
        if rows:
            total += np.array(times, np.float64) @ model.word_rows[rows]
        best = int(total.argmax())
        return model.languages[best], float(1 / np.exp(total - total[best]).sum())


def labelled(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, text`` of the rows that have both."""
    return df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).dropna()


def sampled(rows: DataFrame, chars: int = SAMPLE_CHARS) -> DataFrame:
    """Texts of each language with about an even share of ``chars`` characters, all
    of them where a language has fewer. Chosen by a hash of the text, and equal
    texts of a language once, so copies can't outgrow the bound.

    The driver holds one row for each language."""
    sizes = rows.groupBy("lang").agg(F.sum(F.length("text")).alias("chars")).collect()
    if not sizes:
        return rows
    even = chars / len(sizes)
    share = rows.sparkSession.createDataFrame([(r.lang, min(1.0, even / max(1, r.chars))) for r in sizes],
                                              "lang string, share double")
    if len(sizes) <= MAX_LANGUAGES:  # a few MB; more are joined by a shuffle
        share = F.broadcast(share)
    place = F.xxhash64("text").cast("double") / F.lit(2.0 ** 64) + 0.5
    return rows.join(share, "lang").where(place < F.col("share")).select("lang", "text").dropDuplicates()


def word_counts(rows: DataFrame) -> DataFrame:
    """``lang, word, n`` over all texts of ``lang, text``; counted in each batch
    before they are shuffled."""
    schema = StructType([StructField("lang", StringType()), StructField("word", StringType()),
                         StructField("n", LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.update([(lang, w) for w in words_of(text)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()),
                 pa.array(list(found.values()), pa.int64())], names=schema.names)

    return rows.mapInArrow(count, schema).groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", chars: int = SAMPLE_CHARS) -> Model:
    """Model of the languages of ``df``; rows without text or language take no part.
    What the driver gets is bounded by ``chars``."""
    rows = word_counts(sampled(labelled(df, text_col, lang_col), chars)).collect()
    languages = sorted({r.lang for r in rows})
    at = {lang: i for i, lang in enumerate(languages)}
    words: dict[str, np.ndarray] = {}
    for r in rows:
        words.setdefault(r.word, np.zeros(len(languages)))[at[r.lang]] += r.n
    return Model(languages, words)


@lru_cache(maxsize=1)
def _scorer(shared) -> Scorer:
    return Scorer(shared.value)


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text.

    Null and empty texts, texts without a letter, and all texts where nothing was
    learned give ``und`` and 0. Equal sums go to the first language by name. Repeated
    rows and null ids stay rows; extra columns are not carried. Narrow: no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def setup():
        score = _scorer(shared).predict
        return lambda texts: [list(c) for c in zip(*map(score, texts))] if texts else [[], []]
    return map_texts(df, setup, [StructField("lang_pred", StringType()), StructField("score", DoubleType())],
                     id_col, text_col)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no language is learned from (a null id counts as an empty one)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2


def languages_of(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learn from the rows that are not
    held out, predict all."""
    model = train(docs.where(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages_of(table(spark, sf_dir, "documents"))
