"""Scans and sinks: CSV landing, partition replacement, upsert."""

import hashlib
import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from stratum.functions import checksum
from stratum.plans.pipeline import Layout, Source, ingest_bronze
from stratum.session import new_path
from stratum.sources.files import read_bronze, read_csv, read_table, string_schema
from stratum.sources.sinks import merge_frames, upsert, write_partitioned
from stratum.operators.lineage import add_lineage


def test_csv_quoted_newlines_doubled_quotes_and_codes(spark):
    d = tempfile.mkdtemp(prefix="csv-", dir="/tmp")
    path = os.path.join(d, "reviews.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('review_id,comment,zip\n'
                'r1,"line one\nline two",01037\n'
                'r2,"said ""great"", twice",20000\n')
    df = read_csv(spark, path, string_schema(["review_id", "comment", "zip"]), multi_line=True)
    rows = {r.review_id: r for r in df.collect()}
    assert rows["r1"].comment == "line one\nline two"
    assert rows["r2"].comment == 'said "great", twice'
    assert rows["r1"].zip == "01037"          # no inference: leading zero kept


def test_partition_overwrite_replaces_only_touched_dates(spark):
    path = new_path(spark, "t-bronze")
    df = spark.range(10).withColumnRenamed("id", "k")
    write_partitioned(add_lineage(df, "f.csv", "2026-01-01T06:00:00"), path)
    write_partitioned(add_lineage(df, "f.csv", "2026-01-02T06:00:00"), path)
    n = write_partitioned(add_lineage(df.where("k < 3"), "f.csv", "2026-01-01T09:00:00"), path)
    assert n == 3
    counts = {str(r[0]): r[1] for r in read_bronze(spark, path).groupBy("_ingestion_date")
              .count().collect()}
    assert counts == {"2026-01-01": 3, "2026-01-02": 10}
    pruned = read_bronze(spark, path, ["2026-01-02"])
    assert pruned.count() == 10
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_ingestion_date" in plan


def test_upsert_first_load_then_merge_null_safe(spark):
    path = new_path(spark, "t-silver")
    schema = "k1 string, k2 int, v string"
    first = spark.createDataFrame([("a", 1, "old"), ("b", None, "old"), ("c", 1, "keep")], schema)
    assert upsert(spark, first, path, ["k1", "k2"])[0] == "created"
    second = spark.createDataFrame([("a", 1, "new"), ("b", None, "new"), ("d", 2, "ins")], schema)
    action, n = upsert(spark, second, path, ["k1", "k2"])
    assert (action, n) == ("merged", 4)
    got = {(r.k1, r.k2): r.v for r in read_table(spark, path).collect()}
    assert got == {("a", 1): "new", ("b", None): "new", ("c", 1): "keep", ("d", 2): "ins"}
    # rerunning the same source changes nothing (idempotent)
    upsert(spark, second, path, ["k1", "k2"])
    again = {(r.k1, r.k2): r.v for r in read_table(spark, path).collect()}
    assert again == got


keys = st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["x", "y"])), max_size=12,
                unique_by=lambda t: t[0])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=keys, source=keys)
def test_merge_row_count_is_key_union(spark, target, source):
    schema = "k int, v string"
    t = spark.createDataFrame(target, schema)
    s = spark.createDataFrame(source, schema)
    merged = merge_frames(t, s, ["k"]).collect()
    assert len(merged) == len({k for k, _ in target} | {k for k, _ in source})
    want = dict(target)
    want.update(dict(source))
    assert {r.k: r.v for r in merged} == want


def test_upsert_leaves_no_staged_copy(spark):
    from stratum.session import scratch_dir
    from stratum.sources.files import path_exists

    path = new_path(spark, "silver-staging")
    src = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    upsert(spark, src, path, ["k"])
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    before = {st.getPath().getName() for st in fs.listStatus(root)}
    upsert(spark, spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), path, ["k"])
    after = {st.getPath().getName() for st in fs.listStatus(root)}
    assert not [n for n in after - before if n.startswith("upsert-")]
    assert path_exists(spark, path)
    assert sorted(map(tuple, read_table(spark, path).collect())) == [(1, "a"), (2, "c"), (3, "d")]


def _folders(spark, path):
    """Folders of the current version, with the names of their files."""
    from stratum.sources.versions import DATA, commit_of, names

    return {f: names(spark, f"{path}/{DATA}/{f}") for f in commit_of(spark, path).folders}


def test_partitioned_upsert_rewrites_only_touched_partitions(spark):
    schema = "k int, p int, v string"
    day1 = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, "c"), (4, None, "d"),
                                  (5, 3, "e")], schema)
    day2 = spark.createDataFrame([(2, 1, "B"), (4, None, "D"), (6, 1, "f")], schema)
    flat, parted = new_path(spark, "flat"), new_path(spark, "parted")
    for src in (day1, day2):
        upsert(spark, src, flat, ["k"])
    assert upsert(spark, day1, parted, ["k"], partition_by=["p"])[0] == "created"
    before = _folders(spark, parted)
    reader = read_table(spark, parted)
    action, n = upsert(spark, day2, parted, ["k"], partition_by=["p"])
    assert (action, n) == ("merged", 4)  # partitions p=1 (3 rows) and null (1 row)
    # untouched partitions keep their folders and files
    after = _folders(spark, parted)
    same = {f for f in before if after.get(f) == before[f]}
    assert {f.split("/")[0] for f in same} == {"p=2", "p=3"} and len(after) == 4
    assert reader.count() == 5  # a reader of the version before can end
    got = sorted(map(tuple, read_table(spark, parted).select("k", "p", "v").collect()),
                 key=repr)
    want = sorted(map(tuple, read_table(spark, flat).select("k", "p", "v").collect()), key=repr)
    assert got == want
    assert (4, None, "D") in got and (5, 3, "e") in got
    assert read_table(spark, parted).columns == ["k", "p", "v"]


def _bucket_of(spark, rows, schema, buckets):
    from pyspark.sql import functions as F

    return {r.k: r.b for r in spark.createDataFrame(rows, schema).select(
        "k", F.pmod(F.xxhash64("k"), F.lit(buckets)).alias("b")).collect()}


def test_bucketed_upsert_reads_and_writes_only_touched_buckets(spark, monkeypatch):
    from stratum.sources import sinks

    schema = "k int, v string"
    rows = [(i, "a") for i in range(200)] + [(None, "a")]
    path = new_path(spark, "t-buckets")
    assert upsert(spark, spark.createDataFrame(rows, schema), path, ["k"], buckets=32) == ("created", 201)
    before = _folders(spark, path)
    assert len(before) == 32
    bucket = _bucket_of(spark, rows, schema, 32)
    day2 = [(3, "b"), (None, "b"), (1000, "b")]
    touched = {f"__bucket={b}" for b in [bucket[3], bucket[None], _bucket_of(spark, day2, schema, 32)[1000]]}
    read, merge = [], sinks.merge_frames

    def watched(target, *rest):
        read.extend(target.inputFiles())
        return merge(target, *rest)

    monkeypatch.setattr(sinks, "merge_frames", watched)
    # the number of buckets is the table's, whatever is asked for later
    action, n = upsert(spark, spark.createDataFrame(day2, schema), path, ["k"], buckets=5)
    assert action == "merged"
    assert {f.split("/")[-3] for f in read} == touched
    after = _folders(spark, path)
    assert {f.split("/")[0] for f in set(after) - set(before)} == touched
    assert {f for f in before if f.split("/")[0] not in touched} <= set(after)
    assert n == 1 + sum(f"__bucket={b}" in touched for b in bucket.values())
    got = {r.k: r.v for r in read_table(spark, path).collect()}
    assert got == dict(rows) | dict(day2) and read_table(spark, path).columns == ["k", "v"]
    # only its own files are opened
    assert read_table(spark, path).count() == 202


def test_a_large_bucket_is_split_across_tasks(spark):
    """Three buckets of many rows: written in more files than buckets, none by one task."""
    keep = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        path = new_path(spark, "t-large")
        upsert(spark, spark.range(60_000).selectExpr("id AS k", "sha2(string(id), 256) AS v"), path, ["k"], buckets=3)
    finally:
        for c, v in keep.items():
            spark.conf.set(c, v)
    held = _folders(spark, path)
    assert len(held) == 3
    assert all(sum(n.endswith(".parquet") for n in files) > 3 for files in held.values())
    assert read_table(spark, path).count() == 60_000


def test_duplicate_source_keys_raise_and_change_nothing(spark):
    import pytest

    from stratum.sources.sinks import DuplicateKeyError
    from stratum.sources.versions import versions

    schema = "k int, p int, v string"
    rows = spark.createDataFrame([(1, 1, "a"), (None, 2, "a")], schema)
    twice = [spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (3, 1, "z")], schema),   # matched
             spark.createDataFrame([(7, 1, "x"), (7, 1, "x")], schema),                # not matched
             spark.createDataFrame([(None, 1, "x"), (None, 1, "y")], schema)]          # null keys
    for layout in ({}, {"partition_by": ["p"]}, {"buckets": 4}):
        path = new_path(spark, "t-twice")
        with pytest.raises(DuplicateKeyError, match="2 rows for one key"):
            upsert(spark, twice[0], path, ["k"], **layout)
        assert upsert(spark, rows, path, ["k"], **layout) == ("created", 2)
        for source in twice:
            with pytest.raises(DuplicateKeyError):
                upsert(spark, source, path, ["k"], **layout)
        assert len(versions(spark, path)) == 1
        assert {tuple(r) for r in read_table(spark, path).select("k", "p", "v").collect()} == {(1, 1, "a"), (None, 2, "a")}


def test_hot_duplicate_key_is_counted_before_the_shuffle(spark):
    """Half of a source's rows have one key: each task sends one row for it."""
    import pytest

    from stratum.sources.sinks import DuplicateKeyError, one_row_a_key

    rows = spark.range(0, 20_000, 1, 4).selectExpr("CASE WHEN id % 2 = 0 THEN 0 ELSE id END AS k", "id AS v")
    single, _ = one_row_a_key(rows, ["k"])
    plan = single._jdf.queryExecution().executedPlan().toString()
    assert "partial_first" in plan and "partial_count" in plan
    with pytest.raises(DuplicateKeyError, match="10000 rows"):
        upsert(spark, rows, new_path(spark, "t-hot"), ["k"])


def test_refined_rows_are_not_shuffled_again_to_check_their_keys(spark):
    from stratum.operators.refine import refine_sellers
    from stratum.sources.sinks import one_row_a_key

    raw = add_lineage(spark.range(10).selectExpr("string(id) AS seller_id", "id AS v"), "s.csv", "2026-01-01T06:00:00")
    single, _ = one_row_a_key(refine_sellers(raw), ["seller_id"])
    plan = single._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_a_first_load_that_failed_is_simply_run_again(spark):
    import pytest
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "k int, p int, v string")
    broken = rows.withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("lost")).cast("string")).otherwise("a"))
    for layout in ({}, {"partition_by": ["p"]}, {"buckets": 2}):
        path = new_path(spark, "t-retry")
        with pytest.raises(Exception, match="lost"):
            upsert(spark, broken, path, ["k"], **layout)
        # also where the failed run left a folder of data
        rows.write.mode("append").parquet(f"{path}/_data/__v=000000000001-deadbeef")
        assert upsert(spark, rows, path, ["k"], **layout) == ("created", 2)
        assert read_table(spark, path).count() == 2


def test_source_types_must_be_the_targets(spark):
    import pytest

    path = new_path(spark, "t-types")
    upsert(spark, spark.createDataFrame([(1, "a", 1)], "k int, v string, n int"), path, ["k"])
    with pytest.raises(ValueError, match=r"types: n \(bigint, not int\), v \(double, not string\)"):
        upsert(spark, spark.createDataFrame([(1, 0.5, 1)], "k int, v double, n long"), path, ["k"])
    assert upsert(spark, spark.createDataFrame([], "k int, v string, n int"), path, ["k"]) == ("merged", 0)
    assert read_table(spark, path).count() == 1


def test_newer_rows_stay_in_whatever_order_days_are_merged(spark):
    schema = "k int, v string, __landed int"
    days = [[(1, "a", 1), (2, "a", 1), (3, "a", 1)], [(2, "b", 2), (4, "b", 2)], [(2, "c", 3), (3, "c", 3)]]
    for layout in ({}, {"buckets": 3}):
        for order in ([0, 1, 2], [2, 1, 0], [1, 2, 0], [0, 1, 2, 0, 1]):
            path = new_path(spark, "t-newest")
            for d in order:
                upsert(spark, spark.createDataFrame(days[d], schema), path, ["k"], newest_by="__landed", **layout)
            got = {r.k: r.v for r in read_table(spark, path).collect()}
            assert got == {1: "a", 2: "c", 3: "c", 4: "b"}
            assert read_table(spark, path).columns == ["k", "v"]


def test_pending_versions_are_seen_by_their_audit_alone(spark):
    from stratum.sources.sinks import prepare_overwrite, prepare_upsert

    schema = "k int, v string"
    path = new_path(spark, "t-pending")
    upsert(spark, spark.createDataFrame([(i, "a") for i in range(20)], schema), path, ["k"], buckets=8)
    held = _folders(spark, path)
    made = prepare_upsert(spark, spark.createDataFrame([(1, "b"), (30, "b")], schema), path, ["k"])
    assert {r.k: r.v for r in made.frame().collect()} == {i: "a" for i in range(20)} | {1: "b", 30: "b"}
    assert read_table(spark, path).where("v = 'b'").count() == 0
    made.discard()
    assert _folders(spark, path) == held
    assert upsert(spark, spark.createDataFrame([(1, "c")], schema), path, ["k"])[0] == "merged"
    full = prepare_overwrite(spark.createDataFrame([(0, "z")], schema), path)
    assert read_table(spark, path).count() == 20 and full.frame().count() == 1
    assert full.publish() == ("overwritten", 1) and read_table(spark, path).count() == 1


def test_failed_write_leaves_the_table(spark):
    import pytest
    from pyspark.sql import functions as F

    from stratum.sources.sinks import overwrite
    from stratum.sources.versions import versions

    path = new_path(spark, "t-safe")
    rows = spark.createDataFrame([(i, "a") for i in range(3)], "k int, v string")
    upsert(spark, rows, path, ["k"])
    with pytest.raises(Exception, match="broken"):
        overwrite(rows.withColumn("v", F.raise_error(F.lit("broken")).cast("string")), path)
    assert read_table(spark, path).count() == 3
    assert upsert(spark, rows.where("k = 0").withColumn("v", F.lit("b")), path, ["k"]) == ("merged", 3)
    assert sorted(map(tuple, read_table(spark, path).collect())) == [(0, "b"), (1, "a"), (2, "a")]
    assert len(versions(spark, path)) == 2  # the current one and the one before
    with pytest.raises(ValueError, match="differ in columns: v"):
        upsert(spark, rows.drop("v"), path, ["k"])


def test_existing_folder_without_a_table_is_no_first_load(spark):
    import pytest

    path = new_path(spark, "t-empty")
    spark.range(3).write.parquet(path)
    for name in os.listdir(path.replace("file:", "")):
        os.remove(os.path.join(path.replace("file:", ""), name))
    with pytest.raises(RuntimeError, match="not taken for a first load"):
        upsert(spark, spark.range(1).toDF("id"), path, ["id"])


def test_keys_move_between_partitions(spark):
    path = new_path(spark, "t-moved")
    schema = "k int, p string, v string"
    upsert(spark, spark.createDataFrame([(1, None, "a"), (2, "x y", "a"), (3, "x y", "a"), (4, "z", "a")], schema),
           path, ["k"], partition_by=["p"])
    upsert(spark, spark.createDataFrame([(1, "z", "b"), (2, "w", "b"), (3, None, "b")], schema), path, ["k"],
           partition_by=["p"])
    got = {tuple(r) for r in read_table(spark, path).select("k", "p", "v").collect()}
    assert got == {(1, "z", "b"), (2, "w", "b"), (3, None, "b"), (4, "z", "a")}


def test_overwrite_of_partitions_is_full(spark):
    from stratum.sources.sinks import overwrite

    path = new_path(spark, "t-full")
    for n in (4, 2):
        overwrite(spark.range(n).selectExpr("id AS k", "id AS p"), path, partition_by=["p"])
    assert read_table(spark, path).count() == 2


def test_csv_columns_by_header(spark):
    import pytest

    d = tempfile.mkdtemp(prefix="csv-", dir="/tmp")
    path = os.path.join(d, "x.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("b,extra,a\n1,2,3\n")
    got = read_csv(spark, path, string_schema(["a", "b"]))
    assert [tuple(r) for r in got.collect()] == [("3", "1")]
    with pytest.raises(ValueError, match="lacks c"):
        read_csv(spark, path, string_schema(["a", "c"]))


def test_session_defaults_do_not_override(spark):
    from stratum.session import DEFAULT_CONF

    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert "spark.sql.sources.partitionOverwriteMode" not in DEFAULT_CONF


def test_malformed_lines_are_landed_and_counted(spark, tmp_path):
    path = str(tmp_path / "lines.csv")
    with open(path, "w") as f:
        f.write("a,n,b\nx,1,y\nshort\nlong,2,z,more\nbad,one,z\n\"quoted,\"\"1\"\"\",3,\n")
    schema = StructType([StructField("b", StringType()), StructField("n", IntegerType())])
    got = read_csv(spark, path, schema, malformed="bad").collect()
    assert sorted(r["bad"] for r in got if r["bad"]) == ["bad,one,z", "long,2,z,more", "short"]
    assert sorted((r["b"] or "", r["n"] or 0) for r in got if not r["bad"]) == [("", 3), ("y", 1)]
    text = string_schema(["a", "n", "b"])
    landed = ingest_bronze(spark, {"lines": Source(path, text, "lines.csv")}, Layout(str(tmp_path / "lake")),
                           "2026-01-01T06:00:00")
    assert landed == [("bronze", "lines", 5, "partition_replaced", 2)]
    held = read_bronze(spark, str(tmp_path / "lake/bronze/lines"))
    assert held.columns == ["a", "n", "b", "_ingested_at", "_source_file", "_ingestion_date"]
    assert held.where("n = 'one'").count() == 1  # the raw text stays


def test_checksum_is_of_contents_not_of_order(spark):
    df = spark.createDataFrame([(1, "x", 0.1, None), (2, None, 2.5, True), (2, None, 2.5, True)],
                               "k int, s string, d double, b boolean")
    rows = [(None, f"{10 ** 16}/{10 ** 17}", "1", "x"), ("true", f"{25 * 10 ** 14}/{10 ** 15}", "2", None)]
    texts = ["|".join("~" if v is None else f"{len(v)}:{v}" if v in ("x",) else v for v in r) for r in (rows[0], rows[1], rows[1])]
    halves = [[sum(ord(c) << 21 - 7 * i for i, c in enumerate(hashlib.md5(t.encode()).hexdigest()[at:at + 4])) for t in texts]
              for at in (0, 4)]
    want = str((sum(halves[0]) << 28) + sum(halves[1]))
    assert df.agg(checksum(df)).first()[0] == want
    moved = df.orderBy("d", ascending=False).select("s", "b", "d", "k").repartition(3)
    assert moved.agg(checksum(moved)).first()[0] == want
    none, other = df.where("k = 5"), df.where("k = 2").distinct()
    assert none.agg(checksum(none)).first()[0] == "0"
    assert other.agg(checksum(other)).first()[0] != want


def test_csv_files_of_a_folder_are_read_by_their_own_headers(spark, tmp_path):
    import gzip

    import pytest

    from stratum.sources.files import files_by_header

    folder = tmp_path / "in[1] {a}"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,2\n3,4\n")
    (folder / "2.csv").write_text("b,a\n6,5\nshort\n")
    (folder / "3.csv").write_text("")
    (folder / "_SUCCESS").write_text("")
    with gzip.open(folder / "4.csv.gz", "wt") as f:
        f.write("\nc,b,a\n0,8,7\n")
    pattern = str(tmp_path / "in*")
    assert sorted(len(g) for g in files_by_header(spark, pattern).values()) == [1, 1, 1]
    got = read_csv(spark, pattern, string_schema(["a", "b"]), malformed="bad").collect()
    assert sorted((r.a, r.b) for r in got if not r.bad) == [("1", "2"), ("3", "4"), ("5", "6"), ("7", "8")]
    assert [r.bad for r in got if r.bad] == ["short"]
    with pytest.raises(ValueError, match=r"1\.csv: the header lacks c|2\.csv: the header lacks c"):
        read_csv(spark, pattern, string_schema(["a", "c"]))
    with pytest.raises(ValueError, match="no file with a header"):
        read_csv(spark, str(folder / "3.csv").replace("[", "?").replace("]", "?").replace("{", "?").replace("}", "?"),
                 string_schema(["a"]))


def test_quoted_names_over_several_lines(spark, tmp_path):
    for n, text in enumerate(('id,"a\nname"\n1,"x\ny"\n', '"a\nname",id\nz,2\n')):
        (tmp_path / f"{n}.csv").write_text(text)
    got = read_csv(spark, str(tmp_path), string_schema(["id", "a\nname"]), multi_line=True)
    assert sorted(map(tuple, got.collect())) == [("1", "x\ny"), ("2", "z")]


def test_bronze_dates_with_other_columns(spark):
    import pytest

    path = new_path(spark, "t-evolved")
    days = {"01": ("a int, b int", (1, 1)), "02": ("a bigint, c string", (2 ** 40, "x")), "03": ("b double, a int", (0.5, 3))}
    for day, (schema, row) in days.items():
        df = spark.createDataFrame([row], schema)
        write_partitioned(add_lineage(df, "f.csv", f"2026-01-{day}T06:00:00"), path)
    got = read_bronze(spark, path)
    assert got.columns == ["a", "b", "_ingested_at", "_source_file", "c", "_ingestion_date"]
    assert {(r.a, r.b, r.c) for r in got.collect()} == {(1, 1.0, None), (2 ** 40, None, "x"), (3, 0.5, None)}
    one = read_bronze(spark, path, ["2026-01-01"])  # as that date has them
    assert dict(one.dtypes)["a"] == "int" and "c" not in one.columns
    assert read_bronze(spark, path, since="2026-01-02").count() == 2
    assert read_bronze(spark, path, ["2027-01-01"]).count() == 0
    write_partitioned(add_lineage(spark.createDataFrame([("t",)], "a string"), "f.csv", "2026-01-04T06:00:00"), path)
    with pytest.raises(ValueError, match="column a is bigint in _ingestion_date=2026-01-0[12] but string in _ingestion_date=2026-01-04"):
        read_bronze(spark, path)


def test_malformed_lines_in_quarantine(spark, tmp_path):
    from stratum.plans.pipeline import read_quarantine

    path, layout = tmp_path / "lines.csv", Layout(str(tmp_path / "lake"))
    source = {"lines": Source(str(path), string_schema(["a", "b"]), "lines.csv")}

    def land(text, day):
        path.write_text(text)
        return ingest_bronze(spark, source, layout, f"2026-01-0{day}T06:00:00", quarantine=True)[0][2:]

    assert read_quarantine(spark, layout, "lines").count() == 0
    assert land('a,b\n1,2\nshort\n"q,",3\nlong,2,3\n', 1) == (2, "partition_replaced", 2)
    assert land("a,b\n5,6\nonly\n", 2) == (1, "partition_replaced", 1)

    def held():
        bad = {(r.line, str(r._ingestion_date)) for r in read_quarantine(spark, layout, "lines").collect()}
        rows = {(r.a, r.b) for r in read_bronze(spark, layout.bronze("lines")).collect()}
        return rows, bad
    assert held() == ({("1", "2"), ("q,", "3"), ("5", "6")},
                      {("short", "2026-01-01"), ("long,2,3", "2026-01-01"), ("only", "2026-01-02")})
    # the date mended and landed again: its quarantine is empty, the other date's stays
    assert land("a,b\n1,2\n", 1) == (1, "partition_replaced", 0)
    assert held() == ({("1", "2"), ("5", "6")}, {("only", "2026-01-02")})
    assert read_bronze(spark, layout.bronze("lines")).columns == ["a", "b", "_ingested_at", "_source_file", "_ingestion_date"]
    assert os.listdir(tmp_path / "lake/_landing") == [] and read_quarantine(spark, layout, "lines", ["2026-01-01"]).count() == 0


def test_checksums_tell_texts_and_digits_apart(spark):
    def of(rows, schema):
        df = spark.createDataFrame(rows, schema)
        return df.agg(checksum(df)).first()[0]
    two = "a string, b string"
    assert len({of([r], two) for r in (("x|1:y", None), ("x", "y"), ("~", "x"), (None, "x"), ("", "x"), ("x", ""))}) == 6
    numbers = [0.5, 50.0, 0.1, 0.1 + 1e-16, 1e-9, 2e-9, 123.4567890123, 123.4567890124, 1e17, 1e18, 1e300, -0.5]
    assert len({of([(x,)], "x double") for x in numbers}) == len(numbers)
    df = spark.createDataFrame([(1, 2)], "k int, __landed int")
    assert df.agg(checksum(df)).first()[0] == of([(1,)], "k int")


def test_checksums_are_taken_by_the_write(spark):
    from stratum.sources.sinks import prepare_overwrite, prepare_upsert

    rows = spark.createDataFrame([(i, i / 3, None) for i in range(50)], "k int, v double, __landed int")
    shown = rows.drop("__landed")
    want = shown.agg(checksum(shown)).first()[0]
    for made in (prepare_overwrite(rows, new_path(spark, "t-sum"), summed=True),
                 prepare_upsert(spark, rows, new_path(spark, "t-sum"), ["k"], buckets=3, summed=True)):
        assert (made.rows, made.checksum) == (50, want)
    assert prepare_overwrite(rows.where("k < 0"), new_path(spark, "t-sum"), summed=True).checksum == "0"


def test_rows_ahead_are_written_before_the_merge(spark):
    """Keys whose target row is newer come from a small table of known size; the result is the same."""
    schema = "k int, v string, d int"
    t = spark.createDataFrame([(1, "t", 1), (2, "t", 3), (None, "t", 3), (4, "t", None), (4, "u", None)], schema)
    s = spark.createDataFrame([(1, "s", 2), (2, "s", 2), (None, "s", None), (5, "s", None)], schema)
    merged = merge_frames(t, s, ["k"], "d")
    assert any("/ahead-" in f for f in merged.inputFiles())
    got = sorted((r.k is None, r.k or 0, r.v) for r in merged.collect())
    assert got == [(False, 1, "s"), (False, 2, "t"), (False, 4, "t"), (False, 4, "u"), (False, 5, "s"), (True, 0, "t")]


def test_versions_are_packed(spark, tmp_path):
    from stratum.sources.sinks import overwrite

    path = f"{tmp_path}/t"
    assert overwrite(spark.range(9), path) == 9
    files = read_table(spark, path).inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_a_source_as_large_as_its_table_becomes_the_next_version(spark, monkeypatch):
    """Its rows are written once, and of the table's rows only those it has no row for are read whole."""
    from stratum.sources import sinks

    schema, old = "k int, p int, v string, __landed int", [(i, i % 3, "a", 1) for i in range(12)] + [(None, None, "a", 1)]
    new = [(i, i % 2, "b", 2) for i in range(4, 16)] + [(None, 0, "b", 2)]
    want = {r[0]: r[:3] for r in old} | {r[0]: r[:3] for r in new}
    shown = spark.createDataFrame(list(want.values()), "k int, p int, v string")
    full = shown.agg(checksum(shown)).first()[0]

    def whole_merge(*_):
        raise AssertionError("the rows of both sides are merged")

    for layout in ({}, {"partition_by": ["p"]}, {"buckets": 3}):
        path = new_path(spark, "t-adopt")
        upsert(spark, spark.createDataFrame(old, schema), path, ["k"], newest_by="__landed", **layout)
        with monkeypatch.context() as patch:
            patch.setattr(sinks, "merge_frames", whole_merge)
            made = sinks.prepare_upsert(spark, spark.createDataFrame(new, schema), path, ["k"], newest_by="__landed", summed=True)
        assert (made.action, made.rows, made.checksum) == ("merged", len(want), full)
        assert read_table(spark, path).where("v = 'b'").count() == 0
        made.publish()
        assert {r.k: (r.k, r.p, r.v) for r in read_table(spark, path).collect()} == want
        # an older day again: its rows give way, those of new keys come in
        upsert(spark, spark.createDataFrame([(i, 1, "c", 1) for i in range(8, 30)], schema), path, ["k"], newest_by="__landed")
        held = {r.k: r.v for r in read_table(spark, path).collect()}
        assert held == {k: r[2] for k, r in want.items()} | {i: "c" for i in range(16, 30)}
        # most of the table's rows stay
        with monkeypatch.context() as patch:
            patch.setattr(sinks, "merge_frames", whole_merge)
            upsert(spark, spark.createDataFrame([(i, 2, "d", 3) for i in range(28, 60)], schema), path, ["k"], newest_by="__landed")
        assert {r.k: r.v for r in read_table(spark, path).collect()} == held | {i: "d" for i in range(28, 60)}


def test_landing_files_are_packed_and_small(spark, tmp_path, monkeypatch):
    from stratum.sources import files

    monkeypatch.setattr(files, "FILE_LINES", 40)
    rows = spark.range(0, 100, 1, 1).selectExpr("id AS k", "concat('a, \"b\" ', id) AS v", "IF(id % 7 = 0, null, id / 3) AS d")
    files.write_csv(rows, f"{tmp_path}/f")
    made = [f for f in os.listdir(tmp_path / "f") if not f.startswith((".", "_"))]
    assert len(made) == 3 and all(f.endswith(".csv.gz") for f in made)
    assert sorted(map(tuple, read_csv(spark, f"{tmp_path}/f", rows.schema).collect())) == sorted(map(tuple, rows.collect()))


def test_a_landing_goes_to_one_folder_unsorted(spark, tmp_path, monkeypatch):
    """Only with a quarantine are rows told apart by folder, which sorts them."""
    from pyspark.sql import DataFrameWriter

    def sorting(self, *_):
        raise AssertionError("rows are sorted by folder")

    monkeypatch.setattr(DataFrameWriter, "partitionBy", sorting)
    (tmp_path / "l.csv").write_text("a,b\n1,2\n3\n")
    (tmp_path / "e.csv").write_text("a,b\n")
    lake, text = Layout(str(tmp_path / "lake")), string_schema(["a", "b"])
    landed = ingest_bronze(spark, {n: Source(f"{tmp_path}/{n}.csv", text, f"{n}.csv") for n in "le"}, lake, "2026-01-01T06:00:00")
    assert [r[2:] for r in landed] == [(2, "partition_replaced", 1), (0, "partition_replaced", 0)]
    files = os.listdir(tmp_path / "lake/bronze/l/_ingestion_date=2026-01-01")
    assert any(f.endswith(".zstd.parquet") for f in files) and not os.path.exists(tmp_path / "lake/bronze/e")
    assert sorted((r.a, r.b, str(r._ingestion_date)) for r in read_bronze(spark, lake.bronze("l")).collect()) \
        == [("1", "2", "2026-01-01"), ("3", None, "2026-01-01")]


def test_few_buckets_are_written_without_a_shuffle(spark, monkeypatch):
    from stratum.sources import versions

    plans = []
    for buckets in (versions.FEW_BUCKETS, versions.FEW_BUCKETS + 1):
        path, hints = new_path(spark, "t-few"), []
        df = spark.range(500).selectExpr("id AS k", "id % 7 AS v")

        def watched(self, name, *columns, hints=hints):
            hints.append((name, *columns))
            return self

        with monkeypatch.context() as patch:
            patch.setattr(type(df), "hint", watched)
            upsert(spark, df, path, ["k"], buckets=buckets)
        plans.append(hints)
        assert read_table(spark, path).count() == 500 and len(_folders(spark, path)) == buckets
    assert plans == [[], [("rebalance", "__bucket")]]
