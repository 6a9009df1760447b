"""Each query over the smallest tables against the contract, by brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import public_tokenizers
import xxhash

from .conftest import SF


def _words(text):
    data = re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode())
    return re.findall(rb"[^\x20\x09-\x0D]+", data)


def _labels():
    return duckdb.connect().execute(f"SELECT * FROM read_parquet('{SF}/labels.parquet')").df()


def test_quality_agrees_with_labels(query, docs):
    got = query("op1_quality_classifier")
    assert sorted(got.doc_id) == sorted(docs)
    both = got.merge(_labels(), on="doc_id")
    assert ((both.keep == 1) == (both.quality == 1)).mean() > 0.95
    assert (both.keep[both.quality == 1] == 1).mean() > 0.97


def test_packing(query, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = query("op2_best_fit_packing")
    assert set(got.doc_id) == set(docs)
    total = 0
    for doc_id, pieces in got.sort_values("piece").groupby("doc_id"):
        ids = np.array([*t.encode(docs[doc_id], add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for n, p in enumerate(pieces.itertuples()):
            assert (p.piece, p.start) == (n, at)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            assert n == 0 or p.length == 2048
            at += p.length
        assert at == len(ids)
        total += at
    for _, places in got.sort_values("offset").groupby("sequence_id"):
        assert places.offset.tolist() == [0, *places.length.cumsum()[:-1]]
        assert places.length.sum() <= 2048
    assert got.sequence_id.nunique() <= 1.02 * total / 2048 + 2


def test_neighbours(query):
    rows = duckdb.connect().execute(f"SELECT vec_id, embedding FROM read_parquet('{SF}/embeddings.parquet') ORDER BY 1").fetchall()
    ids = np.array([r[0] for r in rows])
    v = np.array([r[1] for r in rows], np.float64)
    got = query("op3_nearest_neighbours").sort_values(["query_id", "rank"])
    assert set(got.query_id) == set(ids[ids % 50 == 0].tolist())
    hits = 0
    for q, near in got.groupby("query_id"):
        i = int(np.flatnonzero(ids == q)[0])
        exact = v @ v[i] / (np.linalg.norm(v, axis=1) * np.linalg.norm(v[i]))
        order = [int(ids[k]) for k in np.lexsort((ids, -exact)) if k != i][:5]
        assert near["rank"].tolist() == [1, 2, 3, 4, 5]
        assert near.score.is_monotonic_decreasing
        assert np.allclose(near.score, [exact[np.flatnonzero(ids == x)[0]] for x in near.vec_id], atol=1e-12)
        hits += len(set(order) & set(near.vec_id))
    assert hits >= 0.9 * len(got)


def test_bpe_round_trip(query, docs):
    import tiktoken
    from stratum.llm.bpe import load_ranks

    e = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, special_tokens={},
                          mergeable_ranks=load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    got = query("op4_bpe")
    assert len(got) == len(docs)
    for r in got.itertuples():
        ids = e.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_language_model(query, docs):
    tokens = {i: [*_words(t), None] for i, t in docs.items()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    c = Counter(w for i, ws in tokens.items() if not out[i] for w in ws)
    n, v = sum(c.values()), len(c)
    got = query("op5_lm_scoring")
    assert len(got) == len(docs)
    for r in got.itertuples():
        ws = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out[r.doc_id], len(ws), n)
        assert r.n_known == sum(w in c for w in ws)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel=1e-9)
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_toxicity_held_out(query, docs):
    got = query("op6_toxicity")
    assert sorted(got.doc_id) == sorted(docs)
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    both = got.merge(_labels(), on="doc_id")
    assert (both.predicted == both.toxic)[both.held_out].mean() >= 0.9


def test_token_counts(query, docs):
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = query("op7_token_counts")
    assert len(got) == len(docs)
    for r in got.itertuples():
        n = len(m.encode(docs[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 4096)


def test_simhash(query, docs):
    got = query("op8_simhash_near_dedup").set_index("doc_id")
    fps = {}
    for i, t in docs.items():
        w = _words(t)
        s = [b" ".join(w[k:k + 4]) for k in range(max(1, len(w) - 3))] if w else []
        ones = [0] * 64
        for x in s:
            h = xxhash.xxh64_intdigest(x, 42)
            for b in range(64):
                ones[b] += h >> b & 1
        fps[i] = sum(1 << b for b in range(64) if 2 * ones[b] > len(s))
        assert got.fingerprint[i] == f"{fps[i]:016x}"
    left, group = sorted(docs), {}
    while left:
        first = todo = [left.pop(0)]
        first = first[0]
        while todo:
            a = todo.pop()
            group[a] = first
            near = [b for b in left if (fps[a] ^ fps[b]).bit_count() <= 4]
            todo += near
            left = [b for b in left if b not in near]
    assert got.component_id.to_dict() == group


def test_fingerprints(query, docs):
    from stratum.llm.fingerprints import Hasher

    h, ids = Hasher(), sorted(docs)
    got = query("op9_fingerprints").set_index("doc_id")
    for i, j in zip(ids, [*ids[1:], ids[0]]):
        half = len(docs[i]) // 2
        edited = docs[i][:len(docs[i]) - half] + docs[j][:half]
        r = got.loc[i]
        assert (r.n_chars, r.edited_sha256) == (len(docs[i]), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (h.text(docs[i]).hex(), h.text(edited).hex())
        assert r.near_next == pytest.approx(h.text(docs[i]).likeness(h.text(docs[j])))
    assert (got.near_edited > got.near_next).mean() > 0.97


def test_url_filters_match_sql(query):
    from stratum.llm.registry import SQL

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    got = query("op10_url_filters")
    want = con.execute(SQL["op10_url_filters"]).df()[list(got.columns)]

    def rows(f):
        return sorted(map(repr, f.astype(object).where(f.notna(), None).itertuples(index=False, name=None)))
    assert rows(got) == rows(want)
    assert got.blocked.any() and not got.blocked.all()
