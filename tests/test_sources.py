"""Readers and writers on temp files."""

import os

import pytest
from pyspark.sql import types as T

from statflow import sinks, sources
from statflow.operators import aggregates as A
from statflow.operators import rows as R


def test_read_csv_declared_schema(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text("a,b,c\n1,NA,x\nNA,2.5,NA\n3,4.0,y,extra\n5\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType()),
                           T.StructField("c", T.StringType())])
    rows = sources.read_csv(spark, str(path), schema).collect()
    assert [tuple(r) for r in rows] == [(1, None, "x"), (None, 2.5, "NA"), (3, 4.0, "y"),
                                        (5, None, None)]
    assert R.drop_null_any(sources.read_csv(spark, str(path), schema)).count() == 1


def test_read_paragraphs_drops_blank_lines(spark, tmp_path):
    path = tmp_path / "p.txt"
    path.write_bytes(b"first, para\r\n\r\n   \r\n\tsecond\r\nthird\n \n")
    rows = [r.paragraph for r in sources.read_paragraphs(spark, str(path)).collect()]
    assert rows == ["first, para", "\tsecond", "third"]


def test_read_records_arity_and_quotes(spark, tmp_path):
    names = [f"c{i}" for i in range(66)]
    good = ['"a, with comma"', '"line\nbreak"', '"say ""hi"""'] + ["v"] * 63
    lines = [",".join(names), ",".join(good), ",".join(["x"] * 65), ",".join(["y"] * 67),
             ",".join(["z"] * 66)]
    path = tmp_path / "r.csv"
    path.write_text("\n".join(lines) + "\n")
    df = sources.read_records(spark, str(path), names, header=True, multiline=True)
    assert df.count() == 2  # a bare count must not touch only the corrupt-record column
    rows = df.select("c0", "c1", "c2").collect()
    assert [tuple(r) for r in rows] == [("a, with comma", "line\nbreak", 'say "hi"'),
                                        ("z", "z", "z")]


def test_split_fields_and_profile(spark, tmp_path):
    path = tmp_path / "l.txt"
    path.write_text("a,1,2\nb,3\n")
    lines = sources.read_lines(spark, str(path))
    df = sources.split_fields(lines, ["k", "x", "y"], types={"x": "int", "y": "int"})
    assert [tuple(r) for r in df.collect()] == [("a", 1, 2), ("b", 3, None)]
    prof = A.record_profile(lines).first()
    assert tuple(prof) == (2, 2, 3)
    empty = spark.createDataFrame([], "value string")
    assert tuple(A.record_profile(empty).first()) == (0, 0, 0)


def test_write_tsv_and_format(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5, 2)], "k string, v double, n long")
    out = tmp_path / "out"
    sinks.write_tsv(sinks.format_line(df, [("k", "%s"), ("v", "%f"), ("n", "%d")]), str(out))
    assert os.path.exists(out / "_SUCCESS")
    text = "".join(p.read_text() for p in out.glob("part-*"))
    assert text == "a\t1.500000\t2\n"


def test_head_needs_order(spark):
    df = spark.range(10)
    assert [r.id for r in sinks.head(df, 3, ["id"]).collect()] == [0, 1, 2]
    with pytest.raises(ValueError):
        sinks.head(df, 3, [])


def test_partition_settings():
    from statflow.session import partition_settings
    big = partition_settings(100 << 40)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    assert partition_settings(1 << 20)["spark.sql.shuffle.partitions"] == "8"


def test_read_csv_null_token(spark, tmp_path):
    path = tmp_path / "n.csv"
    path.write_text("a,c\n1,NA\nNA,x\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("c", T.StringType())])
    rows = sources.read_csv(spark, str(path), schema, null_value="NA").collect()
    assert [tuple(r) for r in rows] == [(1, None), (None, "x")]


def test_records_of_headerless_files_are_all_read(spark, tmp_path):
    for f in range(3):
        (tmp_path / f"part{f}.csv").write_text("".join(f'{f}{r},"a, b",x\n' for r in range(4)))
    df = sources.read_records(spark, str(tmp_path), ["id", "text", "z"])
    assert sorted(r.id for r in df.collect()) == sorted(f"{f}{r}" for f in range(3) for r in range(4))


def test_one_file_of_records_is_read_by_several_tasks(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text("".join(f"{i},some text,{i * i}\n" for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = sources.read_records(spark, str(path), ["id", "text", "sq"])
        assert df.rdd.getNumPartitions() > 3 and df.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def _records_by_python(path, n, header=False):
    import csv
    with open(path, newline="") as f:
        rows = list(csv.reader(f))
    return sorted(tuple(v or None for v in r) for r in rows[1 if header else 0:] if len(r) == n)


@pytest.fixture
def split_bytes(spark):
    """Sets the size of a file's splits for one test."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


NASTY = ['1,"x\ny",z', '2,"a, ""b"",\n\n""\nc",z', '3,plain,z', '4,5" pipe,z', '5,"",z', '6,"q" tail"s,z',
         '7,too,many,fields', '8,few', '', '9,"line one\r\nline two",z', '10,"long ' + 'word\n' * 60 + '",z',
         '11,"ends with quote""",z', '12,"""",z', '13,"\n",z', '14,\u00e9"\u00e9,z', '15,"\n""\n",z', '"16",x,z']


@pytest.mark.parametrize("size,end", [(30, "\n"), (100, "\r\n"), (1 << 20, "\n")])
def test_records_across_splits(spark, tmp_path, split_bytes, size, end):
    """Every split size gives the rows of one reader over the whole file."""
    path = tmp_path / "r.csv"
    path.write_text(end.join(NASTY * 2) + end, newline="")
    split_bytes(size)
    df = sources.read_records(spark, str(path), ["id", "text", "z"])
    if size < 300:
        assert df.rdd.getNumPartitions() > 8
    want = _records_by_python(path, 3)
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
    assert df.count() == df.select("z").count() == len(want)


@pytest.mark.parametrize("broadcast", [10, 0])
def test_records_of_random_text(spark, tmp_path, split_bytes, monkeypatch, broadcast):
    """Random fields over a nasty alphabet, several files, with and without a broadcast."""
    import csv
    import random

    from statflow.sources import records
    monkeypatch.setattr(records, "BROADCAST_SPLITS", broadcast)
    rng, want = random.Random(7), []
    for f in range(3):
        with open(tmp_path / f"f{f}.csv", "w", newline="") as out:
            w = csv.writer(out, lineterminator="\n")
            w.writerow(["head\ner", "b", "c"])
            for _ in range(100):
                row = ["".join(rng.choice('ab,"\n ') for _ in range(rng.randrange(12)))
                       for _ in range(rng.choice([3, 3, 3, 2, 4]))]
                w.writerow(row)
                if len(row) == 3:
                    want.append(tuple(v or None for v in row))
    split_bytes(150)
    df = sources.read_records(spark, str(tmp_path), ["a", "b", "c"], header=True)
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
    narrow = sources.read_records(spark, str(tmp_path), ["a", "b", "c"], header=True, columns=["c"])
    assert sorted(str(r.c) for r in narrow.collect()) == sorted(str(r[2]) for r in want)


@pytest.mark.parametrize("multiline", [True, False])
def test_arity_holds_however_few_columns_are_read(spark, tmp_path, multiline):
    path = tmp_path / "w.csv"
    path.write_text("".join(",".join([str(r)] * n) + "\n" for r, n in enumerate([66] * 5 + [65] * 3 + [67] * 2)))
    df = sources.read_records(spark, str(path), [f"c{i}" for i in range(66)], multiline=multiline)
    assert len(df.collect()) == df.count() == df.select("c7").count() == len(df.select("c0", "c65").collect()) == 5


def test_lines_as_records(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('h,i\n1,"a, b"\n2,"open\n3,c\n\n')
    df = sources.read_records(spark, str(path), ["k", "v"], header=True, multiline=False)
    assert [tuple(r) for r in df.collect()] == [("1", "a, b"), ("3", "c")]


def test_unclosed_quote(spark, tmp_path):
    path = tmp_path / "u.csv"
    path.write_text("1,a\n2,\"" + "text\n" * 50)
    rows = sources.read_records(spark, str(path), ["k", "v"]).collect()
    assert sorted((r.k, len(r.v)) for r in rows) == [("1", 1), ("2", 250)]
    with pytest.raises(Exception, match="quote"):
        sources.read_records(spark, str(path), ["k", "v"], max_record_chars=100).collect()
    with pytest.raises(ValueError):
        sources.read_records(spark, str(path), ["k", "v"], columns=["x"])


def test_no_records(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    assert sources.read_records(spark, str(tmp_path), ["k", "v"]).count() == 0
