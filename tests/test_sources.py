"""Readers, writers and streams."""

import bz2
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import features, impute
from millrace.plans.fitted import FittedPlan
from millrace.sources import readers, writers
from millrace.streaming import apply as stream

DOCS = {
    "records": '[{"a": 1, "b": "x"}, {"a": 2, "b": "y"}]',
    "index": '{"0": {"a": 1, "b": "x"}, "1": {"a": 2, "b": "y"}}',
    "columns": '{"a": {"0": 1, "1": 2}, "b": {"0": "x", "1": "y"}}',
    "lines": '{"a": 1, "b": "x"}\n{"a": 2, "b": "y"}\n',
}


@pytest.mark.parametrize("orient", sorted(DOCS))
def test_json_layouts(spark, tmp_path, orient):
    path = tmp_path / f"{orient}.json"
    path.write_text(DOCS[orient])
    for how in ("auto", orient):
        got = readers.read_json(spark, str(path), how)
        assert sorted(tuple(r) for r in got.select("a", "b").collect()) == [(1, "x"), (2, "y")]
        assert dict(got.dtypes)["a"] == "bigint"


def test_json_values(spark, tmp_path):
    path = tmp_path / "v.json"
    path.write_text('[[1, "x"], [2, "y"]]')
    assert sorted(tuple(r) for r in readers.read_any(spark, str(path)).collect()) == [(1, "x"), (2, "y")]


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
def test_delimiter_is_sniffed(spark, tmp_path, sep):
    path = tmp_path / "d.csv"
    path.write_text(sep.join(["id", "name"]) + "\n" + sep.join(["1", "x y"]) + "\n")
    assert [tuple(r)[:2] for r in readers.read_csv(spark, str(path)).collect()] == [(1, "x y")]


@pytest.mark.parametrize("encoding,java", [("utf-8", "UTF-8"), ("latin-1", "ISO-8859-1")])
def test_encoding_is_detected(spark, tmp_path, encoding, java):
    path = tmp_path / "e.csv"
    path.write_bytes("id,name\n1,café\n".encode(encoding))
    assert readers.detect_encoding(spark, str(path)) == java
    assert readers.read_any(spark, str(path)).head()["name"] == "café"


def test_bad_rows(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text("id,name\n1,a\n2,b,extra,more\n3,c\n")
    kept = readers.read_csv(spark, str(path), bad_rows="keep").cache()
    assert kept.count() == 3 and kept.where("_corrupt_record is not null").count() == 1
    assert sorted(r[0] for r in readers.read_csv(spark, str(path), bad_rows="drop").select("id", "name").collect()) == [1, 3]


def test_unknown_extension(spark, tmp_path):
    path = tmp_path / "table.dat"
    path.write_text("a,b\n1,2\n")
    assert readers.read_any(spark, str(path)).count() == 1
    with pytest.raises(ValueError):
        readers.read_any(spark, str(path), fallback=None)
    df = spark.range(2)
    assert readers.read_any(spark, df) is df


def test_inventory(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_bytes(b"abc")
    (tmp_path / "sub" / "b.txt").write_bytes(b"")
    flat = readers.file_inventory(spark, str(tmp_path), "*.txt").collect()
    assert [(r["name"], r["size"], r["digest"]) for r in flat] == [("a.txt", 3, "900150983cd24fb0d6963f7d28e17f72")]
    assert readers.file_inventory(spark, str(tmp_path), "*.txt", True, "sha256").count() == 2


def test_inventory_holds_no_large_file(spark, tmp_path, monkeypatch):
    mark, noise = b"\xef\xbb\xbf", random.Random(1).randbytes(30_000)
    wanted = {
        "noise.bin": noise, "noise 2%20+.bin": noise[:20_000] + b"\n", "zeros.bin": bytes(9_000), "breaks.csv": b"\n\r\n" * 2_000,
        "mark.csv": mark + b"a,b\n" * 2_000, "mark_open.csv": mark + b"a,b\n" * 2_000 + b"1", "mark_line.csv": mark + b"\n",
        "packed.gz": gzip.compress(noise), "false.gz": noise[:10_000], "packed.bz2": bz2.compress(noise), "x.tar.gz": mark + noise,
        "bare": noise + b"\n" * 5_000, "bare_ü [1]": noise[::-1], "dot.": noise[5:], "small.bin": mark, "empty.bin": b"",
    }
    for name, data in wanted.items():
        (tmp_path / name).write_bytes(data)
    expected = {k: (len(v), hashlib.md5(v).hexdigest()) for k, v in wanted.items()}
    got = lambda: {r["name"]: (r["size"], r["digest"]) for r in readers.file_inventory(spark, str(tmp_path)).collect()}
    paths = lambda: {r["path"] for r in readers.file_inventory(spark, str(tmp_path)).collect()}
    assert got() == expected
    before = paths()
    monkeypatch.setattr(readers, "WHOLE_FILE", 3)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.sources.binaryFile.maxLength")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    # the reader of whole files now refuses every file that is to be followed
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "3")
    try:
        assert got() == expected
        assert paths() == before
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_inventory_reads_whole_what_has_long_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "WHOLE_FILE", 1_000)
    monkeypatch.setattr(readers, "LONG_LINE", 1_000)
    short = b"x" * 998 + b"\n"
    wanted = {"zeros.bin": bytes(4_000), "last.bin": short * 2 + bytes(2_000), "bare": short + bytes(1_001), "bare2": short * 3 + bytes(1_000), "no.bin": short * 9, "no": short * 9 + bytes(990)}
    for name, data in wanted.items():
        (tmp_path / name).write_bytes(data)
    kept = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "4000")
    try:
        got = readers.file_inventory(spark, str(tmp_path), digest="sha1").collect()
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", kept)
    assert {r["name"]: (r["size"], r["digest"]) for r in got} == {k: (len(v), hashlib.sha1(v).hexdigest()) for k, v in wanted.items()}


def test_split_dataset_round_trip(spark, tmp_path):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 3, "test").otherwise("train"))
    back, meta = writers.read_split_dataset(spark, writers.write_split_dataset(df, str(tmp_path / "s"), "y", ["id"]))
    assert back.count() == 10 and meta == {"target": "y", "features": ["id"], "rows": {"test": 3, "train": 7}}


def test_stream_equals_batch(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "case when id % 4 = 0 then null else cast(id as double) end as x")
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    fill = impute.fit_impute(df, {"x": "median"})
    plan = FittedPlan([fill, features.fit_scale(fill.transform(df), ["x"], "minmax")])
    live = stream.read_stream(spark, str(tmp_path / "in"), maxFilesPerTrigger="1")
    got = stream.run_to_table(stream.apply_fitted(live, plan))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plan.transform(df).collect()))
