"""Quality classifier from weak labels.

Heuristic labellers look at a text's measures and vote good, junk or nothing.
Expectation maximisation over all documents estimates from the agreement of
their votes how accurate each labeller is (a table of vote probabilities per
class) and how common junk is. As there are few labellers, the documents
matter only through the counts of their vote patterns, which Spark
aggregates. The posterior of each pattern then labels a sample, on which a
linear scorer over hashed features (word shapes and measures) is trained; its
score decides.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField

from stratum.llm.common import map_texts, table
from stratum.llm.toxicity import about

#: texts that the scorer is trained on, about; all are used if there are fewer
SAMPLE_ROWS = 16_384
#: weights of the hashed scorer
BUCKETS = 1 << 16

# byte classes: lower-case letters and bytes of other scripts, upper case, digits,
# sentence marks, other signs, spaces, line ends
_CLASS = np.zeros(256, np.uint8)
_CLASS[33:127] = 4
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 3
_CLASS[0:33] = 5
_CLASS[10] = 6
_SHAPE = bytes(b"aA0"[c] if c < 3 else (b if c < 5 else 32) for b, c in enumerate(_CLASS.tolist()))
_PLAIN = set(b"aA0")


@dataclass
class Measures:
    words: int
    distinct: float     # distinct words, as a share of what texts of this length have
    top: float          # share of the most frequent word
    runs: float         # share of words equal to the one before
    upper: float        # share of upper case among letters
    signs: float        # share of other signs among characters that aren't spaces
    marks: float        # share of words that end with a sentence mark
    shouts: float       # share of words that end with a doubled mark or sign
    lone: float         # share of words without letters and digits
    lines: float        # share of lines that repeat earlier ones
    length: float       # mean word length


def measure(text: str) -> tuple[Measures, list[bytes]]:
    """Measures of a whole text and its words' shapes."""
    data = text.encode()
    words = data.split()
    n = len(words)
    if not n:
        return Measures(0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0), []
    sizes = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=7)
    letters = int(sizes[0] + sizes[1])
    counts = Counter(words)
    shapes = data.translate(_SHAPE).split()
    ends = Counter(s[-2:] for s in shapes)
    lines = [x for x in data.split(b"\n") if x.strip()]
    return Measures(
        n, len(counts) / min(n, 2.5 * n ** 0.8), max(counts.values()) / n,
        sum(map(bytes.__eq__, words[1:], words)) / n, int(sizes[1]) / max(letters, 1),
        int(sizes[4]) / max(int(sizes[:5].sum()), 1),
        sum(c for e, c in ends.items() if e[-1:] in b".,;:!?") / n,
        sum(c for e, c in ends.items() if len(e) == 2 and e[0] == e[1] and e[0] not in b"aA0") / n,
        sum(c for shape, c in Counter(shapes).items() if not set(shape) & _PLAIN) / n,
        1 - len(set(lines)) / len(lines), (len(data) - n) / n), shapes


# Each labeller: 1 good, 0 junk, None no vote.
def _vote(good: bool, junk: bool) -> int | None:
    return 1 if good and not junk else 0 if junk and not good else None


LABELLERS = {
    "varied": lambda m: _vote(m.words >= 20 and m.distinct > 0.35, m.words >= 20 and m.distinct < 0.15),
    "top_word": lambda m: _vote(m.words >= 20 and m.top < 0.15, m.words >= 20 and m.top > 0.3),
    "runs": lambda m: _vote(m.words >= 10 and m.runs < 0.05, m.words >= 10 and m.runs > 0.3),
    "case": lambda m: _vote(0.0 < m.upper < 0.2, m.upper > 0.5),
    "signs": lambda m: _vote(m.words >= 5 and m.signs < 0.03, m.signs > 0.12),
    "marks": lambda m: _vote(0.03 < m.marks < 0.5, m.words >= 20 and (m.marks < 0.005 or m.marks > 0.8)),
    "shouts": lambda m: _vote(m.words >= 10 and m.shouts < 0.02, m.shouts > 0.2),
    "lone": lambda m: _vote(m.words >= 10 and m.lone < 0.05, m.words >= 10 and m.lone > 0.2),
    "lines": lambda m: _vote(False, m.lines > 0.5),
    "length": lambda m: _vote(m.words >= 5 and 3 < m.length < 12, m.words > 0 and not 2 < m.length < 20),
}


def votes(m: Measures) -> str:
    """One character per labeller: 1, 0, or - for no vote."""
    return "".join("-" if (v := f(m)) is None else str(v) for f in LABELLERS.values())


def features(m: Measures, shapes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values: each word shape by the root of its share, each measure
    by a step it falls into."""
    found: dict[int, float] = {}
    short = Counter()
    for shape, c in Counter(shapes).items():
        squeezed = b"".join(shape[i:i + 1] for i in range(len(shape)) if shape[i - 1:i] != shape[i:i + 1] or not i)
        short[squeezed[:12]] += c
    for shape, c in short.items():
        at = xxhash.xxh32_intdigest(shape, 1) % BUCKETS
        found[at] = found.get(at, 0.0) + math.sqrt(c / m.words)
    for name in ("distinct", "top", "runs", "upper", "signs", "marks", "shouts", "lone", "lines"):
        at = xxhash.xxh32_intdigest(f"{name} {min(int(getattr(m, name) * 16), 24)}", 2) % BUCKETS
        found[at] = found.get(at, 0.0) + 0.5
    at = xxhash.xxh32_intdigest(f"words {m.words.bit_length()}", 3) % BUCKETS
    found[at] = found.get(at, 0.0) + 0.5
    return np.fromiter(found, np.int32), np.fromiter(found.values(), np.float64)


def posteriors(patterns: dict[str, int], rounds: int = 200) -> tuple[dict[str, float], np.ndarray]:
    """Probability of good for each vote pattern, and each labeller's vote
    probabilities (labeller, class, vote), by expectation maximisation from the
    majority of votes. Patterns without votes get the share of good ones."""
    if not patterns:
        return {}, np.zeros((len(LABELLERS), 2, 2))
    names = sorted(patterns)
    n = np.array([patterns[p] for p in names], np.float64)
    vote = np.array([["01-".index(c) for c in p] for p in names])
    said = np.eye(3)[vote][:, :, :2]  # pattern, labeller, vote; no vote tells nothing
    good = (vote == 1).sum(1)
    junk = (vote == 0).sum(1)
    p = (good + 1.0) / (good + 2.0 * junk + 2.0)  # a junk vote is the rarer, so the stronger sign
    for _ in range(rounds):
        both = np.stack([(1 - p) * n, p * n])
        share = (both.sum(1) + 1) / (n.sum() + 2)
        tables = np.einsum("cp,plv->lcv", both, said) + 0.5
        tables /= tables.sum(2, keepdims=True)
        like = np.log(share)[:, None] + np.einsum("plv,lcv->cp", said, np.log(tables))
        new = 1 / (1 + np.exp(np.clip(like[0] - like[1], -500, 500)))
        done = np.abs(new - p).max() < 1e-9
        p = new
        if done:
            break
    return dict(zip(names, p.tolist())), tables


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12,
               seed: int = 5) -> np.ndarray:
    """Weights (the last one is the bias) by gradient steps on the logistic loss
    against soft labels."""
    rng = np.random.default_rng(seed)
    weight, seen = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-3)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 128):
            batch = order[at:at + 128]
            place = np.concatenate([np.append(rows[i][0], BUCKETS) for i in batch])
            value = np.concatenate([np.append(rows[i][1], 1.0) for i in batch])
            home = np.repeat(np.arange(len(batch)), [len(rows[i][0]) + 1 for i in batch])
            z = np.bincount(home, weight[place] * value, len(batch))
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[batch]
            used, to = np.unique(place, return_inverse=True)
            g = np.bincount(to, error[home] * value, len(used)) / len(batch) + 1e-5 * weight[used]
            seen[used] += g ** 2
            weight[used] -= 0.2 * g / np.sqrt(seen[used])
    return weight


@dataclass
class Scorer:
    posterior: dict[str, float]
    accuracy: np.ndarray
    weight: np.ndarray

    def of(self, text: str) -> tuple[str, float, float]:
        m, shapes = measure(text)
        pattern = votes(m)
        place, value = features(m, shapes)
        z = float(self.weight[place] @ value) + float(self.weight[BUCKETS])
        return pattern, self.posterior.get(pattern, 0.5), 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def train(texts: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Scorer:
    """Labeller accuracies from the votes on all ``texts(doc_id, text)``; the
    scorer from about ``sample_rows`` of them. To the driver come the counts of
    vote patterns (bounded by the number of labellers) and the sample's features."""
    def vote():
        return lambda ts: [[votes(measure(t)[0]) for t in ts]]
    counted = map_texts(texts, vote, [StructField("votes", StringType())]).groupBy("votes").count()
    posterior, tables = posteriors({r["votes"]: r["count"] for r in counted.collect()})

    def extract():
        def run(ts):
            found = [(votes(m), *features(m, s)) for m, s in map(measure, ts)]
            return [[f[0] for f in found], [f[1].tolist() for f in found], [f[2].tolist() for f in found]]
        return run
    # by id and text, equal rows once: an id that many rows share doesn't outgrow the bound
    sample = about(texts, sample_rows, "doc_id", "text").distinct()
    rows = map_texts(sample, extract, [
        StructField("votes", StringType()), StructField("place", ArrayType(IntegerType())),
        StructField("value", ArrayType(DoubleType()))]).orderBy("doc_id", "votes").collect()
    if not rows:
        return Scorer(posterior, tables, np.zeros(BUCKETS + 1))
    weight = fit_scorer([(np.array(r["place"], np.int64), np.array(r["value"], np.float64)) for r in rows],
                        np.array([posterior[r["votes"]] for r in rows]))
    return Scorer(posterior, tables, weight)


def score_texts(df: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, votes, posterior, score, keep`` of every whole text. Narrow; the
    scorer (bounded) is broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(scorer)

    def setup():
        s = shared.value

        def run(ts):
            found = [s.of(t) for t in ts]
            return [[f[0] for f in found], [f[1] for f in found], [f[2] for f in found],
                    [int(f[2] >= 0.5) for f in found]]
        return run
    return map_texts(df, setup, [StructField("votes", StringType()), StructField("posterior", DoubleType()),
                                 StructField("score", DoubleType()), StructField("keep", IntegerType())],
                     id_col, text_col)


def quality(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Weak labels, posteriors and the trained scorer's decision for every row:
    ``doc_id, votes, posterior, score, keep``.

    Null and empty texts get no votes; null ids and repeated rows keep rows of
    their own; extra columns are not carried; an empty table gives an empty
    result. No given label is used."""
    return score_texts(docs, train(docs.select("doc_id", "text"), sample_rows))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))
