"""Parts of the operators against plain versions, with random input."""

import datetime as dt
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratum.llm import bpe, fingerprints, packing, quality, simhash, token_counts
from stratum.llm.components import components

TEXT = st.text(alphabet=st.sampled_from(list(" \n\t'abthersinlé漢🙂01.,!▁\xa0Б")), max_size=60)


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def codec(ranks):
    return bpe.Codec(ranks, public_tokenizers.PATTERN)


def test_transducer_equals_plain_merges(ranks):
    rng = np.random.default_rng(1)
    small = bpe.MergeTransducer(ranks, max_states=50)  # starts anew all the time
    machine = bpe.MergeTransducer(ranks)
    for _ in range(3000):
        word = bytes(rng.choice(list(b"abcdeinorst \xc3\xa9"), rng.integers(1, 30)).tolist())
        want = tuple(ranks[t] for t in machine.merge(word))
        if word not in ranks:
            assert machine.encode(word) == want == small.encode(word)


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_encode_decode(codec, text):
    import tiktoken

    lib = getattr(test_encode_decode, "lib", None)
    if lib is None:
        lib = test_encode_decode.lib = tiktoken.Encoding(
            "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.transducer.ranks, special_tokens={})
    ids = codec.encode(text)
    assert ids == lib.encode_ordinary(text)
    assert "".join(codec.decode_stream(ids, block=1)) == text


@given(st.binary(max_size=40), st.integers(1, 5))
def test_utf8_stream(data, size):
    s = bpe.Utf8Stream()
    got = "".join(s.feed(data[i:i + size]) for i in range(0, len(data), size)) + s.close()
    assert got.replace("�", "") == data.decode("utf-8", "replace").replace("�", "")


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_whole_token_counts(text):
    w = token_counts.counter(public_tokenizers.path("piece_bpe_32k.model"))
    assert w.safe_cuts
    assert w.counts([text]) == [len(w.model.encode(text))]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab é<|endoftext|>漢ࡰ \n")), max_size=40))
def test_tokens_as_the_library(text):
    t = packing.tokens(public_tokenizers.path("byte_bpe_50k.json"))
    for x in (text, text + "<|endoftext|> " + text):
        assert t.ids(x).tolist() == t.slow.encode(x, add_special_tokens=False).ids


@given(st.lists(st.integers(1, 64), max_size=80))
def test_packing_fits_without_gaps(lengths):
    lengths = np.array(lengths, np.int64)
    place, offset = packing.pack_lengths(lengths, 64)
    for b in set(place.tolist()):
        spans = sorted((int(o), int(n)) for p, o, n in zip(place, offset, lengths) if p == b)
        assert [o for o, _ in spans] == np.cumsum([0, *[n for _, n in spans][:-1]]).tolist()
        assert sum(n for _, n in spans) <= 64


def test_paragraphs_are_a_multiset():
    h = fingerprints.Hasher()
    a, b, c = "one line of it\nanother line\nthird", "third\none line of it\nanother line", "third"
    assert h.text(a) == h.text(b) and h.text(a).hex() == h.text(b).hex()
    assert h.text(a) - h.text(c) == h.text("one line of it\nanother line")
    assert fingerprints.Multiset.from_hex(h.text(a).hex()) == h.text(a)
    assert not h.text(a) == h.text(a + "\n")
    mark, edited = h.replaced(h.text(a), a, 9, "new end\nof it")
    assert edited == "one line new end\nof it" and mark == h.text(edited)


def test_gray_index_finds_all_pairs():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (60, 20, 3), dtype=np.uint64), axis=2)
    fps = np.unique((base[:, None] ^ flips).ravel())
    group = np.sort(rng.integers(0, 3, len(fps)))
    q, m = simhash.GrayIndex(fps, group).within(fps, group, 4)
    near = (np.bitwise_count(fps[:, None] ^ fps[None]) <= 4) & (group[:, None] == group[None])
    assert set(zip(q.tolist(), m.tolist())) == set(zip(*map(list, np.nonzero(near))))


def test_links_across_runs(spark, monkeypatch):
    """One block value for all fingerprints, runs far smaller than its list."""
    monkeypatch.setattr(simhash, "RUN", 16)
    rng = np.random.default_rng(9)
    fps = sorted({int(b) << 20 | int(f) for b in rng.integers(0, 1 << 20, 40) for f in rng.integers(0, 16, 6)})
    got = {r["node"]: r["root"] for r in components(
        simhash.hamming_links(spark.createDataFrame([(f,) for f in fps], "fp long"), 4)).collect()}
    left, want = set(fps), {}
    while left:
        part, todo = set(), [min(left)]
        while todo:
            a = todo.pop()
            part.add(a)
            left.discard(a)
            new = {b for b in left if (a ^ b).bit_count() <= 4}
            left -= new
            todo += new
        want |= {a: min(part) for a in part if len(part) > 1}
    assert got == want


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 150: 100, 200: 100}


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(2)
    n = len(quality.LABELLERS)
    truth = rng.random(4000) < 0.8
    right = rng.random((4000, n)) < np.linspace(0.7, 0.95, n)
    votes = np.where(rng.random((4000, n)) < 0.3, -1, np.where(right, truth[:, None], ~truth[:, None]))
    names = ["".join("-" if v < 0 else str(v) for v in row) for row in votes.tolist()]
    counts = {}
    for x in names:
        counts[x] = counts.get(x, 0) + 1
    p, tables = quality.posteriors(counts)
    assert np.mean([(p[x] >= 0.5) == t for x, t in zip(names, truth)]) > 0.97
    assert np.allclose(tables[:, 1, 1], np.linspace(0.7, 0.95, n), atol=0.06)


def test_intervals_and_most_specific_entry(spark):
    from stratum.llm.url_filters import intervals, url_filters

    d = dt.date
    entries = spark.createDataFrame([
        ("block", "domain", "x.org", d(2024, 1, 1), "add"), ("block", "domain", "x.org", d(2024, 2, 1), "remove"),
        ("block", "domain", "x.org", d(2024, 2, 1), "add"), ("block", "domain", "x.org", d(2024, 3, 1), "add"),
        ("allow", "host", "a.x.org", d(2024, 1, 10), "add"), ("block", "prefix", "a.x.org/p", d(2024, 1, 20), "add"),
        ("block", None, "x.org", d(2024, 1, 1), "add")], "list string, kind string, pattern string, day date, action string")
    spans = {(r.pattern, r.since, r.until) for r in intervals(entries).collect()}
    assert ("x.org", d(2024, 1, 1), d(2024, 2, 1)) in spans and ("x.org", d(2024, 3, 1), None) in spans
    assert not [s for s in spans if s[1] == d(2024, 2, 1)]
    urls = [("https://A.x.org/p/1", d(2024, 1, 5), True), ("https://a.x.org/p/1", d(2024, 1, 15), False),
            ("https://a.x.org/p/1", d(2024, 1, 25), True), ("https://b.x.org", d(2024, 2, 10), False),
            ("https://b.x.org", d(2024, 3, 10), True), ("https://bx.org/", d(2024, 1, 5), False),
            (None, d(2024, 1, 5), False), ("nonsense", d(2024, 1, 5), False), ("https://x.org", None, False)]
    got = url_filters(spark.createDataFrame([(n, u, w, "own") for n, (u, w, _) in enumerate(urls)],
                                            "page_id long, url string, fetch_day date, list string"), entries)
    assert {r.page_id: r.blocked for r in got.collect()} == {n: b for n, (_, _, b) in enumerate(urls)}


def _made_model(rng, words=300, rare=0):
    from stratum.llm import language_model as lm

    names = [f"w{i}".encode() for i in range(words)]
    counts = np.sort(rng.integers(2, 4000, words))[::-1]
    v = lm.Vocabulary(np.array([lm.word_hash(w) for w in names]), counts, int(counts.sum()) + rare, words + rare)
    hashes = np.array([lm.word_hash(f"r{i}".encode()) for i in range(rare)], np.int64).view(np.uint64)
    masses = np.bincount((hashes & np.uint64((1 << 18) - 1)).astype(np.int64), np.full(rare, 2.0), 1 << 18)
    return lm.empty_model(v, lm.classes_of(v, rng.integers(0, lm.KINDS + 1, words)), masses), hashes


def test_language_model_probabilities_sum_to_one():
    """Class, share and pair weights together: over all words after the same two words."""
    from stratum.llm import language_model as lm

    rng = np.random.default_rng(8)
    m, rare = _made_model(rng, 300, 40)
    m.weights[:] = rng.normal(0, 0.5, m.weights.shape)
    hashes = np.append(m.vocabulary.hashes.view(np.uint64), rare)
    words = np.concatenate([[3, 5, w] for w in range(340)])
    numbers, sizes = np.minimum(words, 300).astype(np.int32), np.full(340, 3)
    keys = lm.pair_keys(hashes[words], numbers, sizes, m.classes)
    last = np.arange(2, len(words), 3)
    unique = np.unique(keys)
    n = np.where(np.isin(unique, keys[last]) & (rng.random(len(unique)) < 0.3), rng.integers(1, 50, len(unique)), 0)
    logs = dict(zip(unique.tolist(), lm.fitted(unique, n, m.share).tolist()))
    log_p = m.token_scores(numbers, sizes)[last] + [logs[k] for k in keys[last].tolist()]
    log_p[300:] += np.log(2.0 / m.rare_total)  # words without a number, each seen once
    unknown = m.token_scores(np.array([3, 5, 300], np.int32), np.array([3]))[2] - np.log(m.rare_total)
    left = [logs[k] for k in keys[last][300:].tolist()]  # what the words without a weight have lost to the others
    assert np.exp(log_p).sum() + np.exp(unknown + min(left)) == pytest.approx(1.0, abs=1e-5)
    assert (n > 0).sum() > 50


def test_language_model_weights_maximise_the_counts():
    """The gradient is zero, and weights that differ from 0 are those of pairs that occur."""
    from stratum.llm import language_model as lm

    rng = np.random.default_rng(4)
    share = np.zeros(1 << lm.ITEM_BITS)
    share[:40] = rng.dirichlet(np.ones(40))
    groups = np.repeat(np.arange(1, 9, dtype=np.uint64), 40)
    keys = ((groups << np.uint64(lm.ITEM_BITS)) | np.tile(np.arange(40, dtype=np.uint64), 8)) << np.uint64(1)
    n = np.where(rng.random(320) < 0.4, rng.integers(1, 60, 320), 0)
    n[:40] = 0  # a group that is only asked for
    old, lm.FIT_STEPS = lm.FIT_STEPS, 60
    try:
        got = lm.fitted(keys, n, share)
    finally:
        lm.FIT_STEPS = old
    assert (got[:40] == 0).all()
    for g in range(1, 8):
        part, c = got[40 * g:40 * g + 40], n[40 * g:40 * g + 40]
        p = share[:40] * np.exp(part)
        assert p.sum() == pytest.approx(1)
        log_z = -part[c == 0][0]  # pairs without a weight have the normaliser alone
        assert (part[c == 0] == -log_z).all()
        assert c[c > 0] - c.sum() * p[c > 0] == pytest.approx((part[c > 0] + log_z) / lm.VARIANCE, abs=1e-5)
    soon = lm.fitted(keys, n, share)
    assert np.abs(soon - got).max() < 0.05  # the steps that are taken come near


def test_language_model_messages_keep_their_numbers():
    from stratum.llm import language_model as lm

    x = np.random.default_rng(0).normal(0, 6, 999)
    assert lm._unpacked_logs(lm._packed_logs(x)) == pytest.approx(x, abs=2.0 ** -19)
    for n, width in ((np.array([0, 1, (1 << 40) - 1]), 5), (np.array([0, 7, (1 << 32) - 1]), 4)):
        assert (lm._from_planes(lm._planes(n, width), width) == n).all()
    keys = np.array([1 << 63, (1 << 64) - 1, 5], np.uint64)
    assert (lm._from_planes(lm._planes(keys, 8), 8).view(np.uint64) == keys).all()


def test_language_model_sees_three_words_back():
    from stratum.llm import language_model as lm

    classes = np.arange(20, dtype=np.int32) % lm.CLASSES
    one, other = (lm.contexts(np.array([a, 2, 3, 4], np.int32), np.array([4]), classes) for a in (1, 5))
    assert (one[:, 3] != other[:, 3]).sum() == 1  # the third back alone
    assert lm.CLASSES == 58


def test_language_model_kinds_cover_all_texts(spark, monkeypatch):
    """Every word of a text of one kind gets that kind, however few texts place the kinds."""
    from stratum.llm import language_model as lm

    monkeypatch.setattr(lm, "CLASS_TEXTS", 40)
    monkeypatch.setattr(lm, "KINDS", 2)
    made = []
    monkeypatch.setattr(lm, "classes_of", lambda v, kind, f=lm.classes_of: made.append(kind) or f(v, kind))
    monkeypatch.setattr(lm, "train_round", lambda model, texts: None)
    n = 1000  # words 0-5 and 6-11 mark two kinds of text; each text has a word of its own
    texts = [[*range(i % 2 * 6, i % 2 * 6 + 6)] * 3 + [12 + i] for i in range(n)]
    counts = np.array([n // 2 * 3] * 12 + [1] * n)
    v = lm.Vocabulary(np.arange(12 + n), counts, int(counts.sum()), 12 + n)
    monkeypatch.setattr(lm, "ANCHORS", 12)
    packed = [(i, np.array(t, "<i4").tobytes()) for i, t in enumerate(texts)]
    lm.train(spark.createDataFrame(packed, "row long, numbers binary"), v)
    own = made[0][12:]
    assert set(own) == {0, 1} and len(set(own[::2])) == len(set(own[1::2])) == 1


def test_language_model_kinds_are_placed_by_all_texts(spark, monkeypatch):
    """The shares of the frequent words, and the centres, are those of every training text."""
    from stratum.llm import language_model as lm

    monkeypatch.setattr(lm, "CLASS_TEXTS", 40)
    made, counted = [], lm.counted_kinds
    monkeypatch.setattr(lm, "counted_kinds", lambda texts, words, found: made.append(found[0]) or counted(texts, words, found))
    rows = [(i, "the cat sat" if i % 3 else "a dog ran " + "far " * (i % 7 == 0)) for i in range(400)]
    lm.language_model_scores(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = [set(lm.split_words(x)) for i, x in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    words = sorted({w for t in texts for w in t})
    shares = sorted(sum(w in t for t in texts) / len(texts) for w in words)
    found, = made
    assert sorted(found.mean.tolist()) == pytest.approx(shares, abs=1e-6)
    assert np.linalg.norm(found.centre, axis=1) == pytest.approx(1, abs=1e-5)


def test_language_model_counts_all_contexts(spark, monkeypatch):
    """Words beyond the numbered ones are told apart by what stands before them."""
    from stratum.llm import language_model as lm

    monkeypatch.setattr(lm, "MAX_WORDS", 3)
    rows = [(i, f"l{i % 40} r{i % 40}") for i in range(1400)] + [(None, "l3 r3")]
    out = [i for i in range(2000, 2100) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    docs = spark.createDataFrame([*rows, (out[0], "l3 r3"), (out[1], "l3 r7")], "doc_id long, text string")
    got = {r.doc_id: r for r in lm.language_model_scores(docs).collect()}
    assert got[out[0]].held_out and got[out[1]].held_out
    assert got[out[0]].score > got[out[1]].score + 0.5
    assert got[None].score == pytest.approx(got[out[0]].score, abs=0.1)


@pytest.mark.parametrize("most,chunk,bits", [(2000, 1 << 21, 4), (50, 3000, 6), (1, 700, 4), (1 << 18, 5000, 5)])
def test_language_model_equals_a_plain_version(spark, monkeypatch, docs, most, chunk, bits):
    """Counts of all words, numbered or not, in texts to learn from and held out, and the
    scores from pairs counted by hand, whatever chunks and blocks they pass through."""
    import math

    from stratum.llm import language_model as lm

    monkeypatch.setattr(lm, "MAX_WORDS", most)
    monkeypatch.setattr(lm, "CHUNK", chunk)
    monkeypatch.setattr(lm, "block_bits", lambda spark, tokens: bits)
    made = []
    monkeypatch.setattr(lm, "train", lambda *a, f=lm.train: made.append(f(*a)) or made[0])
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in lm.language_model_scores(frame).collect()}
    words = {i: lm.split_words(t) for i, t in docs.items()}
    learn = {i for i in docs if zlib.crc32(str(i).encode()) % 7 != 2}
    c = Counter(w for i in learn for w in words[i])
    total, kinds = sum(c.values()), len(c)
    m = made[0]
    numbered = len(m.vocabulary.hashes)
    assert numbered <= most and m.vocabulary.words == kinds
    hashes = {w: np.int64(lm.word_hash(w)).view(np.uint64) for ws in words.values() for w in ws}
    keys = {i: lm.pair_keys(np.array([hashes[w] for w in words[i]]), m.vocabulary.numbers(words[i]), np.array([len(words[i])]),
                            m.classes).tolist() for i in docs}
    pairs = Counter(k for i in learn for k in keys[i])  # the end is alone in its class, if it has a number
    every = np.array(sorted({k for ks in keys.values() for k in ks}), np.uint64)
    logs = dict(zip(every.tolist(), lm.fitted(every, np.array([pairs[k] for k in every.tolist()]), m.share)))
    for i, ws in words.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (i not in learn, len(ws), total)
        assert r.n_known == sum(w in c for w in ws)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (total + kinds + 1)) for w in ws), rel=1e-9)
        score = m.token_scores(m.vocabulary.numbers(ws), np.array([len(ws)]))
        for k, (w, n) in enumerate(zip(ws, m.vocabulary.numbers(ws))):
            score[k] += 0 if m.classes[n] == lm.CLASSES - 2 else logs[keys[i][k]]
            score[k] += math.log((c[w] + 1) / m.rare_total) if n == numbered else 0
        assert r.score == pytest.approx(score.sum() / math.log(10), abs=1e-3)


def test_toxicity_learns_pairs_that_tell_nothing_alone(spark):
    """Two words each as common in clean texts as in toxic ones, but toxic together."""
    from stratum.llm import toxicity

    def made(n, seed):
        rng = np.random.default_rng(seed)
        told = ["alpha omega", "alpha", "omega", "slur"]
        return [(i, " ".join([*(f"f{w}" for w in rng.integers(0, 300, 30)), told[i % 4]]), int(i % 4 in (0, 3)))
                for i in range(n)]

    machine = toxicity.train(spark.createDataFrame(made(4000, 1), "doc_id long, text string, label int"))
    known = set(machine.terms.tolist())
    assert all(toxicity.term_hashes(w)[0] in known for w in ("alpha", "omega"))
    rows = made(400, 2)
    predicted = machine.scorer()([text for _, text, _ in rows])[1]
    assert np.mean([p == label for p, (*_, label) in zip(predicted, rows)]) > 0.9


@pytest.mark.parametrize("context", ["{0}'ll", "a{0}1 {0}", " {0} x{0}'s"])
def test_every_code_point_is_split_as_the_library_does(codec, context):
    """All planes that hold characters, and every 97th of the others."""
    import tiktoken

    target = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.transducer.ranks, special_tokens={})
    points = [p for p in (*range(0x32400), *range(0xE0000, 0xE0200), *range(0x32400, 0x110000, 97)) if not 0xD800 <= p < 0xE000]
    for i in range(0, len(points), 500):
        text = "\n".join([context.format(chr(p)) for p in points[i:i + 500]])
        assert codec.encode(text) == target.encode_ordinary(text)


def test_patterns_are_spelled_out():
    classes = {"L": "a-z", "N": "0-9", "s": " \\t"}
    assert bpe.spelled_out(r" ?\p{L}+|[^\s\p{L}\p{N}]+|\s+(?!\S)|\\s\.", classes) == (
        r" ?[a-z]+|[^ \ta-z0-9]+|[ \t]+(?![^ \t])|\\s\.")
    with pytest.raises(ValueError, match="inside brackets"):
        bpe.spelled_out(r"[\S]", classes)


def _plain_fingerprint(text):
    """A text's fingerprint from its definition, word by word: the sum of a keyed hash of each
    paragraph, and of signed counts of its distinct neighbouring pairs and, where short, trigrams."""
    import hashlib

    import xxhash

    mask, mix = (1 << 64) - 1, 0x9E3779B97F4A7C15

    def mixed(x):
        x = x * mix & mask
        x ^= x >> 32
        return x * mix & mask

    equal, like = [0] * 8, [0] * 192
    for n, part in enumerate(text.split("\n")):
        digest = hashlib.blake2b(part.encode(), digest_size=64).digest()
        for k in range(8):
            equal[k] = equal[k] + int.from_bytes(digest[8 * k:8 * k + 8], "little") & mask
        words, before, found = part.split(), 0, set()
        for w in words:
            h = xxhash.xxh64_intdigest(w.encode())
            found.add(mixed(h ^ (before * mix & mask) + (before >> 29) & mask))
            before = h
        if words and len(words) < 8:
            line = " ".join(words)
            found |= {mixed(xxhash.xxh64_intdigest(line[i:i + 3].encode(), 7)) for i in range(max(1, len(line) - 2))}
        for x in found:
            like[(x >> 40) % 192] += 1 - 2 * (x >> 39 & 1)
    return b"".join(x.to_bytes(8, "little") for x in equal).hex() + b"".join(x.to_bytes(4, "little", signed=True) for x in like).hex()


def test_fingerprints_from_their_definition(docs):
    h = fingerprints.Hasher()
    for text in ["", "one", "a b\n\n a  b \nb a", "Ünï 漢字 🙂\nx", *list(docs.values())[:25]]:
        assert h.text(text).hex() == _plain_fingerprint(text)


def _followers(rows):
    """Next texts by id (null first), then a hash of the text, by sorting all rows."""
    import xxhash

    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0,
                                        np.uint64(xxhash.xxh64_intdigest(r[1].encode(), 42)).astype(np.int64)))
    return [(a, b[1]) for a, b in zip(order, [*order[1:], order[0]])]


@pytest.mark.parametrize("kind", ["numbers", "texts"])
def test_next_documents_with_hot_ids(spark, kind):
    """A third of the rows share an id, a third have none, one text stands many times; ids of any type."""
    import hashlib

    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, "same text" if i % 5 == 0 else f"text of {i}\nand more {i * 7}")
            for i in range(600)]
    if kind == "texts":
        rows = [(None if i is None else f"id {i:05d}", t) for i, t in rows]
    frame = spark.createDataFrame(rows, "doc_id long, text string" if kind == "numbers" else "doc_id string, text string")
    dealt = fingerprints.with_next(frame.repartition(4), ranges=12)
    sizes = [r["count"] for r in dealt.where("NOT tail").groupBy("range").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 150 and dealt.where("tail").count() == len(sizes)
    got = fingerprints.edited_neighbours(frame.repartition(4), ranges=12).collect()
    want = Counter()
    for (doc_id, text), after in _followers(rows):
        half = len(text) // 2
        want[doc_id, hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in got) == want


def test_range_of_a_key(spark):
    from pyspark.sql import functions as F

    for n in (0, 1, 2, 5, 17, 40):
        cuts = [3 * i for i in range(n)]
        got = spark.range(-2, 130).select("id", fingerprints._range_of(F.col("id"), [F.lit(c) for c in cuts]).alias("at"))
        assert [r.at for r in got.orderBy("id").collect()] == [sum(x > c for c in cuts) for x in range(-2, 130)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["", " ", "a", "a b", "one two three", "x " * 9]), max_size=6), st.integers(0, 40),
       st.sampled_from(["", "\n", "a\n\nb", "new words"]))
def test_edits_are_sums(lines, keep, new):
    h, text = fingerprints.Hasher(), "\n".join(lines)
    mark, edited = h.replaced(h.text(text), text, min(keep, len(text)), new)
    assert mark.hex() == h.text(edited).hex()
    assert sum((h.paragraphs([p]) for p in text.split("\n")), fingerprints.Multiset()).hex() == h.text(text).hex()


def test_blocks_and_shards_follow_the_table():
    from stratum.llm import neighbours

    for most in (0, 2, 4):
        sizes = [simhash.blocks_for(n, most) for n in (0, 1, 10 ** 5, 10 ** 8, 10 ** 10, 10 ** 12)]
        assert sizes == sorted(sizes) and sizes[0] == most + 1
    assert [simhash.blocks_for(n, 4) for n in (10 ** 7, 10 ** 8, 10 ** 11)] == [5, 6, 7]
    assert [neighbours.shards_for(n, 8) for n in (0, 10, 7_000, 10 ** 5, 10 ** 6, 10 ** 7)] == [1, 1, 2, 8, 8, 77]


@pytest.mark.parametrize("blocks", [5, 6, 7])
def test_links_don_t_depend_on_the_blocks(spark, monkeypatch, blocks):
    """A list value that many fingerprints share over many short runs, repeated rows among them."""
    monkeypatch.setattr(simhash, "RUN", 40)
    rng = np.random.default_rng(5)
    far = [int(x) for x in rng.integers(0, 1 << 63, 120, dtype=np.uint64)]
    hot = [int(x) for x in rng.integers(0, 1 << 20, 150, dtype=np.uint64)]  # their upper blocks are all zero
    near = [x ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False)) for x in (far + hot)[::3]]
    every = sorted({*far, *hot, *near})
    distinct = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in every], "fp long")
    got = {(r.a, r.b) for r in simhash.hamming_links(distinct, 4, blocks).collect()}
    place = {int(np.uint64(x).astype(np.int64)): i for i, x in enumerate(every)}

    def groups(links):
        home = list(range(len(every)))

        def root(i):
            while home[i] != i:
                i = home[i]
            return i
        for a, b in links:
            x, y = sorted((root(a), root(b)))
            home[y] = x
        return [root(i) for i in range(len(every))]
    want = [(i, j) for i, a in enumerate(every) for j in range(i) if (a ^ every[j]).bit_count() <= 4]
    assert groups([(place[a], place[b]) for a, b in got]) == groups(want) and len(want) > 50


def test_toxicity_line_makes_log_odds():
    from stratum.llm import toxicity

    rng = np.random.default_rng(3)
    z = rng.normal(0, 3, 20_000)
    labels = (rng.random(20_000) < 1 / (1 + np.exp(-(2 * z + 1)))).astype(float)
    assert toxicity.line_through(z, labels) == pytest.approx((2, 1), abs=0.1)
    assert toxicity.line_through(z, np.zeros(20_000)) == (1.0, 0.0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aB \t\n\x0b\x0c\r\x1c\x85\xa0É漢\x00")), max_size=12), max_size=5))
def test_language_model_splits_columns_as_texts(texts):
    import pyarrow as pa

    from stratum.llm import language_model as lm

    for column in (pa.array(texts, pa.string()), pa.array(["x y", *texts], pa.string()).slice(1)):
        distinct, token, sizes = lm.coded(column)
        words = [distinct[i] for i in token]
        assert words == [w for t in texts for w in lm.split_words(t)]
        assert sizes.tolist() == [len(lm.split_words(t)) for t in texts]


def test_language_model_stretch_sums():
    from stratum.llm import language_model as lm

    rng = np.random.default_rng(1)
    a = rng.normal(size=(500, 7)).astype(np.float32)
    first = np.unique(np.append(0, rng.integers(0, 500, 90)))
    first = first[(first < 100) | (first > 240)]  # a long one among them
    assert lm.stretch_sums(a, first) == pytest.approx(np.add.reduceat(a, first, axis=0), abs=1e-4)
