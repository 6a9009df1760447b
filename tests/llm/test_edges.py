"""Every operator and stage on odd rows and on empty tables."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stratum.llm import (bpe, fill_in_middle, fingerprints, language_id, language_model, neighbours, packing, quality,
                         runs, simhash, token_counts, toxicity, url_filters)

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BY_TEXT = {
    "quality": lambda d, m: quality.quality(d),
    "bpe": lambda d, m: bpe.round_trip(d, RANKS, public_tokenizers.PATTERN),
    "language_model": lambda d, m: language_model.language_model_scores(d),
    "toxicity": lambda d, m: toxicity.toxicity(d, m),
    "token_counts": lambda d, m: token_counts.token_counts(d, public_tokenizers.path("piece_bpe_32k.model")),
    "simhash": lambda d, m: simhash.simhash_groups(d),
    "fingerprints": lambda d, m: fingerprints.edited_neighbours(d, ranges=3),
    "language_id": lambda d, m: language_id.languages_of(d),
    "runs": lambda d, m: runs.periodic_runs(d),
    "fill_in_middle": lambda d, m: fill_in_middle.fill_in_middle(d),
}


@pytest.mark.parametrize("name", BY_TEXT)
def test_one_row_for_each(name, odd, marks):
    got = BY_TEXT[name](odd, marks).collect()
    ids = [r["doc_id"] for r in odd.collect()]
    assert sorted([r["doc_id"] for r in got], key=str) == sorted(ids, key=str)


@pytest.mark.parametrize("name", BY_TEXT)
def test_empty_tables(name, empty, marks):
    assert BY_TEXT[name](empty, marks.limit(0)).count() == 0


def test_no_labels(odd, marks):
    assert {r.score for r in toxicity.toxicity(odd, marks.limit(0)).collect()} == {0.5}


def test_values_on_odd_rows(odd, marks):
    one = {r.doc_id: r for r in BY_TEXT["simhash"](odd, marks).collect()}
    assert one[1].fingerprint == one[2].fingerprint == one[3].fingerprint == "0" * 16
    assert one[1].component_id == one[3].component_id == 1 and one[6].component_id == 5
    counts = {r.doc_id: r for r in BY_TEXT["token_counts"](odd, marks).collect()}
    assert (counts[1].n_tokens, counts[2].n_bytes, counts[8].over_limit) == (0, 0, True)
    lm = {r.doc_id: r for r in BY_TEXT["language_model"](odd, marks).collect()}
    assert lm[1].n_tokens == lm[2].n_tokens == lm[3].n_tokens == 1 and lm[8].n_tokens == 60_001
    marked = {r.doc_id: r for r in BY_TEXT["fingerprints"](odd, marks).collect()}
    assert marked[5].fingerprint == marked[6].fingerprint and marked[1].n_chars == 0
    back = bpe.decode_ids(bpe.encode_texts(odd, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert {r.doc_id: r.text for r in back.collect()}[7] == {r.doc_id: r.text for r in odd.collect()}[7]


def test_packing_odd_and_empty(odd, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack_texts(odd, path).collect()
    assert sum(r.piece == 0 for r in got) == odd.count()
    assert {r.length for r in got if r.doc_id in (1, 2)} == {1}
    assert packing.pack_texts(empty, path).count() == 0


def test_packing_beside_columns_of_its_own_names(spark):
    rows = [(i, 100 * i + 1, "s", 2.5, "r") for i in range(20)]
    pieces = spark.createDataFrame(rows, "doc_id long, length long, shard string, row double, __shard string")
    got = packing.pack(pieces, 2048).collect()
    assert sorted(tuple(r)[:5] for r in got) == rows and len({(r.sequence_id, r.offset) for r in got}) == 20


def test_neighbours_odd_and_empty(spark):
    rows = [(0, [1.0, 0.0]), (50, [2.0, 0.0]), (50, [2.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, None), (4, []),
            (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, [float("inf"), 1.0]), (None, [1.0, 0.0]),
            (9, [1.0, 0.0, 0.0]), (100, [0.0, 1.0, 0.0]), (150, [1.0])]
    table = spark.createDataFrame([(*r, 7, 1.0) for r in rows], "vec_id long, embedding array<float>, rank int, score double")
    ask = F.col("vec_id") % 50 == 0
    got = {}
    for r in neighbours.nearest(table, ask).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: [1, 50, 2], 50: [0, 1, 2], 100: [9]}
    assert neighbours.nearest(table.limit(0), ask).count() == 0


def test_url_filters_empty(spark):
    captures = spark.createDataFrame([], "page_id long, url string, fetch_day date")
    entries = spark.createDataFrame([], "list string, kind string, pattern string, day date, action string")
    assert url_filters.url_filters(captures, entries).count() == 0


@pytest.fixture
def folder(tmp_path, marks):
    marks.write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, folder, odd, empty, name, stage):
    for at, frame in (("odd", odd), ("empty", empty)):
        frame.write.parquet(f"{folder}/{at}")
        docs = spark.read.parquet(f"{folder}/{at}")
        got = stage(spark, docs, folder)
        if stage is not corpus_pipeline.pack:
            assert got.columns == docs.columns
            assert got.exceptAll(docs).count() == 0
        if at == "empty":
            assert got.count() == 0


def test_one_of_each_group_stays(spark, odd, folder):
    odd.write.parquet(f"{folder}/d")
    kept = corpus_pipeline.drop_near_copies(spark, spark.read.parquet(f"{folder}/d"), folder).collect()
    assert sum(r.text is not None and r.text.startswith("The same text") for r in kept) == 1
    assert sum(not (r.text or "").strip() for r in kept) == 1
    assert {4, 8, 9} <= {r.doc_id for r in kept}


def test_pipeline_runs(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = corpus_pipeline.run(spark, sf)
    assert 0 < got.select("doc_id").distinct().count() < docs.count()


def test_sample_stays_bounded_with_hot_ids(spark):
    """A third of the rows have one id, another third none, and a text stands 1,000 times."""
    rows = spark.range(6000).selectExpr(
        "CASE id % 3 WHEN 0 THEN 7 WHEN 1 THEN NULL ELSE id END AS doc_id",
        "CASE WHEN id % 6 = 0 THEN 'same' ELSE concat('text ', id) END AS text")
    chosen = toxicity.about(rows, 600, "doc_id", "text").distinct()
    assert 350 < chosen.count() < 700
    assert 100 < chosen.where("doc_id = 7").count() < 200 and 100 < chosen.where("doc_id IS NULL").count() < 300


def test_pipeline_equals_a_plain_chain(spark):
    """Decisions of each stage's operator, near copies by brute force, and every piece packed once."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    machine = toxicity.train(toxicity.labelled(docs, spark.read.parquet(f"{sf}/labels.parquet"), "toxic"))
    clean = docs.join(toxicity.score_texts(docs, machine).where("predicted = 0").select("doc_id"), "doc_id", "left_semi")
    scorer = quality.train(clean.select("doc_id", "text"))
    good = clean.join(quality.score_texts(clean, scorer).where("keep = 1").select("doc_id"), "doc_id", "left_semi")
    marks = {r.doc_id: int(r.fingerprint, 16) for r in simhash.simhash_groups(good.select("doc_id", "text")).collect()}
    assert len(marks) == good.count() > 0  # no id repeats here
    home = {i: i for i in marks}

    def root(i):
        while home[i] != i:
            i = home[i]
        return i

    ids = sorted(marks)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (marks[a] ^ marks[b]).bit_count() <= 4:
                x, y = sorted((root(a), root(b)))
                home[y] = x
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in got} == {i for i in ids if root(i) == i}
    assert len({(r.doc_id, r.piece) for r in got}) == len(got)


def test_a_vector_that_a_third_of_the_rows_share(spark):
    """Its rows are one node, and each other's nearest, smaller ids first; the others' results are whole."""
    import numpy as np

    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(900, 8)).astype(np.float32)
    vectors[::3] = vectors[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(0, vectors[0].tolist())] * 50
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in neighbours.nearest(table, F.col("vec_id") % 50 == 0, shard_rows=150).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    wide = vectors.astype(np.float64)
    wide /= np.linalg.norm(wide, axis=1, keepdims=True)
    same = hits = 0
    for q in range(0, 900, 50):
        score = np.round(wide @ wide[q], 12)
        want = [int(x) for x in np.lexsort((np.arange(900), -score)) if x != q][:5]
        if q % 3 == 0:
            assert got[q] == want == [x for x in range(0, 21, 3) if x != q][:5]
            same += 1
        hits += len(set(got[q]) & set(want))
    assert same == 6 and hits >= 0.95 * 5 * 18
