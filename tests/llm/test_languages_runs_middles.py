"""Language identification, periodic runs and fill-in-middle against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import fill_in_middle as fim
from stratum.llm import language_id, runs
from stratum.llm.common import text_groups

from .conftest import SF

SPACE = b"\x20\x09-\x0D"


def _sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


# --- language identification ---------------------------------------------------------------

def _langs():
    return dict(duckdb.connect().execute(f"SELECT doc_id, lang FROM read_parquet('{SF}/documents.parquet')").fetchall())


def test_languages_held_out(query, docs):
    got, langs = query("op11_language_id"), _langs()
    assert sorted(got.doc_id) == sorted(docs)
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and set(got.lang_pred) <= {*langs.values(), "und"}
    held = got[got.held_out]
    assert (held.lang_pred == held.doc_id.map(langs)).mean() > 0.97


def test_languages_equal_a_plain_version(query, docs):
    """The same scores from counts taken text by text, word by word."""
    langs = _langs()
    names = sorted({v for v in langs.values() if v})
    words = {n: Counter() for n in names}
    for lang, text in {(langs[i], docs[i]) for i in docs if zlib.crc32(str(i).encode()) % 4 != 2}:
        words[lang].update(re.findall(r"[^\W\d_]+", text.lower()))
    vocabulary = set().union(*words.values())

    def logs(counts, everything):
        """Log frequency of an item in each language."""
        size = {n: sum(counts[n].get(x, 0) + 0.5 for x in everything) for n in names}
        return lambda x: np.array([math.log((counts[n].get(x, 0) + 0.5) / size[n]) for n in names])

    def grams(word, k):
        return [f" {word} "[i:i + k] for i in range(len(word) + 3 - k)]

    of_word, of_gram, known = logs(words, vocabulary), {}, {}
    for k in range(1, 6):
        held = Counter(g for w in vocabulary for g in set(grams(w, k)))
        known[k] = {g for g, c in held.items() if c >= 2}
        per = {n: Counter(g for w in words[n] for g in set(grams(w, k))) for n in names}
        of_gram[k] = logs(per, known[k])

    def score(word):
        if word in vocabulary:
            return of_word(word)
        for k in range(5, 0, -1):
            if some := [g for g in grams(word, k) if g in known[k]]:
                return sum(map(of_gram[k], some)) / len(some)
        return 0
    got = query("op11_language_id").set_index("doc_id")
    for i in sorted(docs)[::7]:
        total = sum(score(w) for w in re.findall(r"[^\W\d_]+", docs[i].lower()))
        assert got.lang_pred[i] == names[int(total.argmax())]
        assert got.score[i] == pytest.approx(1 / np.exp(total - total.max()).sum(), abs=1e-4)


def test_backoff_is_to_the_longest_known_gram():
    model = language_id.Model(["a", "b"], {"stone": np.array([5., 0]), "stones": np.array([2., 0]), "pierre": np.array([0, 4.]),
                                           "pierres": np.array([0, 1.])})
    whole = model.unseen("stony")  # " ston" and "stony": the first is known
    assert (whole == model.gram_rows[model.grams[" ston"]]).all() and whole[0] > whole[1]
    assert model.unseen("pi")[1] > model.unseen("pi")[0]
    assert model.unseen("漢") is not None  # its ends are known
    scorer = language_id.Scorer(model)
    assert scorer.predict("STONE, stone!")[0] == "a" and scorer.predict("12 ... ²³ _") == ("und", 0.0)
    assert scorer.predict("")[0] == "und" and scorer.predict("ß")[0] in "ab"


def test_languages_on_odd_rows(spark):
    rows = [(None, "der hund und die katze", "de"), (1, None, "de"), (2, "the dog and the cat", None), (3, "", "en"),
            (4, "the dog and the cat", "en"), (4, "the dog and the cat", "en"), (5, "12 34 !!", "en"),
            (6, "der hund " * 30_000, "de"), (7, "x" * 20_000, "en")]
    table = spark.createDataFrame([(*r, "p", 0.5) for r in rows],
                                  "doc_id long, text string, lang string, lang_pred string, score double")
    got = language_id.languages_of(table).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    by = {r.doc_id: r for r in got}
    assert (by[1].lang_pred, by[3].lang_pred, by[5].lang_pred) == ("und",) * 3 and by[1].score == 0
    assert by[2].lang_pred == by[4].lang_pred == "en" and by[6].lang_pred == "de"
    assert language_id.languages_of(table.limit(0)).count() == 0
    nothing = language_id.languages_of(table.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}


def test_a_rare_language_beside_a_hot_one_keeps_its_share(spark):
    """A text repeated by half of the rows and a language with nearly all others."""
    rows = spark.range(4000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 'the same text again' WHEN id = 5 THEN 'ein seltener satz' "
        "ELSE concat('some text with number', chr(97 + id % 26), chr(97 + id % 17), chr(97 + id % 11)) END AS text",
        "CASE WHEN id = 5 THEN 'de' ELSE 'en' END AS lang")
    chosen = language_id.sampled(rows, 4000)
    assert chosen.where("lang = 'de'").count() == 1
    assert chosen.agg(F.sum(F.length("text"))).first()[0] < 6000
    assert chosen.count() == chosen.distinct().count()


# --- periodic runs ---------------------------------------------------------------------------

def _runs(words):
    """Every maximal stretch of each period, by comparing words that far apart."""
    n, best = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                best.setdefault((i, j + q), q)
            i = j
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def _periodic(rng):
    letters = [b"a", b"b", b"c"][:rng.randint(1, 3)]
    some = [rng.choice(letters) for _ in range(rng.randint(1, 30))]
    kind = rng.randrange(5)
    if kind == 0:  # repeated, with a few words changed
        words = (some * 40)[:rng.choice([5, 23, 24, 25, 60, 300])]
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = b"z"
    elif kind == 1:  # stretches of one word in the period
        some = [b"a"] * rng.randint(1, 30) + [b"b"] + [b"a"] * rng.randint(0, 9)
        words = some * rng.randint(2, 9)
        k = rng.randint(0, len(words))
        words[k:k] = [b"a"] * rng.randint(0, 40)
    elif kind == 2:  # repeats inside repeats
        inner = some[:4] * rng.randint(1, 9) + some[4:9]
        words = inner * rng.randint(3, 6) + some[:4] * rng.randint(0, 30)
    elif kind == 3:
        a, b = [b"a"], [b"a", b"b"]
        for _ in range(9):
            a, b = b, b + a
        words = b[:rng.randint(1, 90)] * rng.randint(3, 8)
    else:
        words = [rng.choice(letters) for _ in range(rng.choice([0, 1, 30, 400]))]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(60):
        texts = [_periodic(rng) for _ in range(rng.randint(1, 8))]
        assert runs.runs_of(texts) == list(map(_runs, texts))


def test_range_successor():
    rng = np.random.default_rng(1)
    values = rng.permutation(200)
    find = runs.RangeSuccessor(values, 200)
    low = rng.integers(0, 200, 300)
    high = np.array([rng.integers(x, 201) for x in low])
    bound = rng.integers(0, 400, 300)
    k = np.array([rng.integers(0, max(1, b - a)) for a, b in zip(low, high)])
    assert find.below(low, high, bound).tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(low, high, bound)]
    full = high > low
    assert find.smallest(low, high, k)[full].tolist() == [
        int(np.sort(values[a:b])[i]) for a, b, i in zip(low[full], high[full], k[full])]


def test_runs_query(query, docs):
    got = query("op12_periodic_runs").set_index("doc_id")
    assert sorted(got.index) == sorted(docs)
    seen = 0
    for i, text in docs.items():
        words = re.findall(rb"[^" + SPACE + rb"]+", text.encode())
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        want = _runs(words)
        r, seen = got.loc[i], seen + len(want)
        assert r.n_runs == len(want)
        assert r.runs_sha256 == _sha("".join("%d,%d,%d\n" % x for x in want))
        dropped = {k for s, length, q in want for k in range(s + q, s + length)}
        assert r.collapsed_sha256 == _sha(b" ".join(w for k, w in enumerate(words) if k not in dropped))
        if want:
            s, length, q = min(want, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, length, q, 1000 * length // q)
        else:
            assert all(v is None or v != v for v in (r.start, r.length, r.period, r.exponent_milli))
    assert seen > 10


def test_runs_on_odd_rows(odd, empty):
    got = {r.doc_id: r for r in runs.periodic_runs(odd).collect()}
    assert [tuple(x) for x in got[8].runs] == [(0, 60_000, 1)] and got[8].collapsed == "word"
    assert (got[1].n_words, got[1].runs, got[1].collapsed) == (0, [], "") and got[4].collapsed == "one"
    made = {r.doc_id: r for r in runs.digests(runs.periodic_runs(odd)).collect()}
    assert made[8].exponent_milli == 60_000_000 and made[8].n_runs == 1
    assert made[1].start is None and made[1].runs_sha256 == made[1].collapsed_sha256 == _sha("")
    assert runs.digests(runs.periodic_runs(empty)).count() == 0


# --- fill in middle -------------------------------------------------------------------------

TOKENS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = ["", "a", " ", "\n\n", " a", "a ", "a b\tc\n", "Ünï 漢字 🙂\x00 x\xa0y ", "one\ntwo\n\nthree", "x" * 300 + " " * 300]


def test_wavelet_matrix_ranks():
    rng = np.random.default_rng(2)
    symbols = rng.integers(0, 12, 1000).astype(np.uint8)
    m, at = fim.WaveletMatrix(symbols, 4), rng.integers(0, 1001, 50)
    for s in range(12):
        assert m.rank(s, at).tolist() == [int((symbols[:i] == s).sum()) for i in at]


@pytest.mark.parametrize("unit,split", [("tokens", TOKENS.findall), ("chars", list),
                                        ("lines", lambda t: re.findall(r"[^\n]*\n|[^\n]+", t))])
def test_cuts_are_unit_borders(unit, split):
    units = list(map(split, TEXTS))
    starts = np.cumsum([0, *map(len, TEXTS)])
    borders = fim.Borders("".join(TEXTS), starts, unit)
    assert borders.units.tolist() == list(map(len, units))
    for k in range(max(map(len, units)) + 1):
        want = [len("".join(u[:min(k, len(u))])) for u in units]
        got = borders.cut(np.minimum(k, borders.units)) - starts[:-1]
        assert got.tolist() == want


def test_middles_query(query, docs):
    got = query("op13_fill_in_middle").set_index("doc_id")
    assert sorted(got.index) == sorted(docs)
    for i, text in docs.items():
        units = TOKENS.findall(text)
        h = hashlib.sha256(f"42:{i}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
        a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
        plain = not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50
        form = "plain" if plain else "spm" if h4 % 100 < 80 else "psm"
        out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
        r = got.loc[i]
        assert (r.n, r.form, r.output_sha256, r.restored_sha256) == (len(units), form, _sha(out), _sha(text))
        assert plain and r.prefix_chars != r.prefix_chars or (r.prefix_chars, r.middle_chars) == (len(p), len(m))


def test_middles_match_sql(query):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(fim.OP13_SQL).df().set_index("doc_id").sort_index()
    got = query("op13_fill_in_middle").set_index("doc_id").sort_index()[list(want.columns)]
    assert got.equals(want.astype(got.dtypes.to_dict()))


def test_middles_restore_any_text(spark, odd, empty):
    texts = [*TEXTS, "holds <P> itself", "half < P><S ends with <", "S> starts", "M>P>S>", "퟿"]
    rows = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts * 20)] + [(None, "null id", "x", 1)],
                                 "doc_id long, text string, form string, n int")
    made = fim.fill_in_middle(rows, rate=100).withColumn("back", fim.restored())
    assert sorted(r.back for r in made.collect()) == sorted([*texts * 20, "null id"])
    assert {r.form for r in made.collect()} == {"plain", "psm", "spm"}
    got = fim.fill_in_middle(odd, rate=100)
    assert got.count() == odd.count() and fim.fill_in_middle(empty).count() == 0
    assert {r.form for r in got.where("doc_id IN (1, 2)").collect()} == {"plain"}


def test_a_long_text_stands_alone():
    texts = ["a b", "c " * 50, "", "d", "e f g"]
    assert list(text_groups(texts, 10)) == [(0, 1), (1, 2), (2, 5)]
    assert list(text_groups([], 10)) == [] and list(text_groups([""], 10)) == [(0, 1)]
