"""Toxicity by a factorization machine over hashed terms.

Terms are a text's distinct lower-case words and their first letters (so that
other endings of a known stem count too), as 64-bit hashes. Terms in too few
training texts are left out; each of the rest gets a weight and factors, as a pair
may tell what neither term does. Terms whose share among
toxic texts is beyond chance are fitted first, in larger steps, so that the
others only learn what those leave open. Scores are brought to probabilities by a line
through the scores of a part of the training texts, from a machine fitted without them. A score adds the weights of a text's terms
and, for every pair of them, the product of their factors, which is linear to
compute: half of the squared sum less the sum of squares. So two terms that
mean little alone can say much together.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField

from stratum.llm.common import map_texts, staged, table

#: labelled rows the model is fitted on, about; all are used if there are fewer
SAMPLE_ROWS = 16_384
MIN_TEXTS = 3
#: terms that tell less of the label by chance alone in all but one of 1000 cases wait for the second part of the fit
LEAST_TOLD = 10.83
FACTORS = 8
STEMS = (4, 5)
MEMO = 400_000
WORD = re.compile(r"\w+")


def term_hashes(word: str) -> list[int]:
    out = [xxhash.xxh64_intdigest(word.encode())]
    out += [xxhash.xxh64_intdigest(word[:k].encode(), k) for k in STEMS if len(word) > k]
    return [h - (1 << 64) if h >> 63 else h for h in out]


class Terms:
    """Distinct terms of texts; ``known`` maps hashes to places (None: hashes)."""

    def __init__(self, known: dict[int, int] | None = None):
        self.known = known
        self.memo: dict[str, tuple[int, ...]] = {}

    def of(self, text: str) -> set[int]:
        words, memo = set(WORD.findall(text.lower())), self.memo
        if len(memo) > MEMO:
            memo.clear()
        for w in words.difference(memo):
            hashes = term_hashes(w)
            memo[w] = tuple(hashes) if self.known is None else tuple(
                self.known[h] for h in hashes if h in self.known)
        return set(chain.from_iterable(map(memo.__getitem__, words)))


class Machine:
    """Parameters: a bias, and per term its weight, its factors and their squared norm."""

    def __init__(self, terms: np.ndarray, bias: float, weight: np.ndarray, factors: np.ndarray,
                 line: tuple[float, float] = (1.0, 0.0)):
        self.terms, self.bias, self.line = terms, bias, line
        self.packed = np.column_stack([weight, (factors ** 2).sum(1), factors]).astype(np.float32)

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """Log odds of texts by the places of their terms."""
        out = []
        for at in rows:
            total = self.packed[at].sum(axis=0, dtype=np.float64)
            out.append(self.bias + total[0] + 0.5 * ((total[2:] ** 2).sum() - total[1]))
        return self.line[0] * np.array(out, np.float64) + self.line[1]

    def scorer(self) -> Callable[[list[str]], list[list]]:
        terms = Terms({h: i for i, h in enumerate(self.terms.tolist())})

        def score(texts):
            z = self.scores([np.fromiter(sorted(terms.of(t)), np.int64) for t in texts])
            p = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
            return [p.tolist(), (p >= 0.5).astype(int).tolist()]
        return score


def fit_machine(rows: list[np.ndarray], labels: np.ndarray, tells: np.ndarray, first: int = 16, epochs: int = 8,
                seed: int = 7) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and factors by mini-batch gradient steps on the logistic
    loss, each parameter with its own decreasing step: ``first`` epochs over the
    terms that tell of the label alone, then all terms, in smaller steps. Steps and
    epochs were chosen on a part of the training rows."""
    n_terms, whole = len(tells), rows
    rng = np.random.default_rng(seed)
    weight = np.zeros(n_terms)
    factors = rng.normal(0, 0.003, (n_terms, FACTORS))
    share = min(max(labels.mean(), 1e-3), 1 - 1e-3) if len(labels) else 0.5
    bias = float(np.log(share / (1 - share)))
    seen_w, seen_f = np.full(n_terms, 1.0), np.full((n_terms, FACTORS), 1.0)
    for epoch in range(first + epochs):
        alone = epoch < first
        rows = [r[tells[r]] for r in whole] if alone else whole
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 256):
            batch = order[at:at + 256]
            sizes = [len(rows[i]) for i in batch]
            flat = np.concatenate([rows[i] for i in batch])
            home = np.repeat(np.arange(len(batch)), sizes)
            if not len(flat):
                continue
            v = factors[flat]
            sums = np.stack([np.bincount(home, v[:, f], len(batch)) for f in range(FACTORS)], 1)
            squares = np.bincount(home, (v ** 2).sum(1), len(batch))
            z = bias + np.bincount(home, weight[flat], len(batch)) + 0.5 * ((sums ** 2).sum(1) - squares)
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[batch]
            bias -= 0.02 * float(error.mean())
            terms, place = np.unique(flat, return_inverse=True)
            g = np.bincount(place, error[home], len(terms)) + (1e-3 if alone else 1e-2) * weight[terms]
            seen_w[terms] += g ** 2
            weight[terms] -= (0.5 if alone else 0.01) * g / np.sqrt(seen_w[terms])
            for f in range(FACTORS):
                g = np.bincount(place, error[home] * (sums[home, f] - v[:, f]), len(terms)) + 1e-2 * factors[terms, f]
                seen_f[terms, f] += g ** 2
                factors[terms, f] -= (0.05 if alone else 0.005) * g / np.sqrt(seen_f[terms, f])
    return bias, weight, factors


def line_through(z: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make scores log odds: a logistic regression on one value,
    held near slope 1; as they are where labels are of one kind only."""
    if len(set(labels.tolist())) < 2:
        return 1.0, 0.0
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - labels) * z).sum() + 0.1 * (a - 1), (p - labels).sum()])
        h = np.array([[(w * z * z).sum() + 0.1, (w * z).sum()], [(w * z).sum(), w.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -2, 2))
    return max(a, 0.1), b


def calibrated(places: np.ndarray, rows: list[np.ndarray], labels: np.ndarray, tells: np.ndarray, seed: int = 7) -> "Machine":
    """A machine fitted on all rows, whose scores go through the line found on a quarter
    of them by a machine fitted on the others."""
    apart = np.random.default_rng(seed).random(len(rows)) < 0.25
    line = (1.0, 0.0)
    if 0 < apart.sum() < len(rows):
        trial = Machine(places, *fit_machine([r for r, x in zip(rows, apart) if not x], labels[~apart], tells))
        line = line_through(trial.scores([r for r, x in zip(rows, apart) if x]), labels[apart])
    return Machine(places, *fit_machine(rows, labels, tells), line)


def held_out(id_col: Column, parts: int, part: int) -> Column:
    """Rows whose id, as text, has this remainder of crc32 (a null id: as empty)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % parts == part


def about(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """About ``rows`` rows, chosen by a hash of ``keys``; all if there are fewer."""
    n = df.count()
    share = min(1.0, rows / max(n, 1))
    return df.where(F.pmod(F.xxhash64(*keys, F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20))) if share < 1 else df


def told(n: Column, ones: Column, rows: int, positive: int) -> Column:
    """How much a term tells of the label: the log-likelihood ratio of its count
    among positive and other texts against the shares of all texts."""
    def part(seen: Column, share: float) -> Column:
        return F.when(seen > 0, seen * F.log(seen / (n * F.lit(max(share, 1e-9))))).otherwise(0.0)
    share = positive / max(rows, 1)
    return 2 * (part(ones.cast("double"), share) + part((n - ones).cast("double"), 1 - share))


def train(texts: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """A machine for ``texts(doc_id, text, label)``. Terms are counted by Spark
    over the bounded sample; term places of its rows come to the driver, which
    takes the gradient steps. Rows are chosen by id and text and equal ones count
    once, so an id or a text that many rows share doesn't outgrow the bound."""
    labelled_rows = texts.select("doc_id", "text", "label").where("label IN (0, 1)")
    sample = about(labelled_rows, sample_rows, "doc_id", "text").distinct()
    keyed = sample.select(F.struct("doc_id", F.col("label").cast("int").alias("label")).alias("doc_id"), "text")
    hashes = map_texts(keyed, lambda: (lambda ts, t=Terms(): [[list(t.of(x)) for x in ts]]),
                       [StructField("terms", ArrayType(LongType()))])
    total = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    counted = (hashes.select("doc_id.label", F.explode("terms").alias("term")).groupBy("term")
               .agg(F.count("*").alias("n"), F.sum("label").alias("ones")).where(F.col("n") >= MIN_TEXTS))
    kept = (counted.select("term", (told(F.col("n"), F.col("ones"), *total) >= LEAST_TOLD).alias("tells"))
            .toPandas().sort_values("term"))
    places = kept["term"].to_numpy(np.int64)
    known = sample.sparkSession.sparkContext.broadcast({h: i for i, h in enumerate(places.tolist())})

    rows = map_texts(keyed, lambda: (lambda ts, t=Terms(known.value): [[sorted(t.of(x)) for x in ts]]),
                     [StructField("at", ArrayType(IntegerType()))]).select("doc_id.doc_id", "doc_id.label", "at")
    got = rows.toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")])
    at = got.column("at").combine_chunks()
    ends, flat = at.offsets.to_numpy(), at.values.to_numpy()
    labels = got.column("label").to_numpy().astype(np.float64)
    known.unpersist()
    return calibrated(places, [flat[a:b] for a, b in zip(ends, ends[1:])], labels, kept["tells"].to_numpy(bool))


def score_texts(df: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` of every whole text; null and empty texts get
    the score of no terms. Narrow; the machine (bounded) is broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(machine)
    return map_texts(df, lambda: shared.value.scorer(),
                     [StructField("score", DoubleType()), StructField("predicted", IntegerType())], id_col, text_col)


def labelled(docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """``doc_id, text, label`` of training rows: labels that aren't null and whose
    id isn't held out. Documents with several labels have a row for each."""
    marks = (labels.select(F.col("doc_id").alias("label_id"), F.col(column).alias("label"))
             .where("label IS NOT NULL AND label_id IS NOT NULL").where(~held_out(F.col("label_id"), 5, 0)))
    return docs.select("doc_id", "text").join(marks, F.col("doc_id") == F.col("label_id")).drop("label_id")


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Null and empty texts are scored as texts without terms; null ids and repeated
    rows keep rows of their own; without any training label every score is 0.5;
    extra columns are not carried; an empty table gives an empty result."""
    scored = score_texts(docs, train(labelled(docs, labels, "toxic"), sample_rows))
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
