"""Folders, files and report documents."""

import json

import pytest
from pyspark.sql import functions as F

from gaugeloom import session
from gaugeloom.sources import tables as io


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "mill").mkdir()
    for name, rows in {"01": ["0,1.5,a", "1,2.5,b"], "02": ["0,3.5,c"], "10": ["0,,d"]}.items():
        (tmp_path / "mill" / f"{name}.csv").write_text("\n".join(["idx,x,label", *rows]) + "\n")
    (tmp_path / "mill" / "notes.txt").write_text("no data\n")
    return str(tmp_path)


def test_read_series(spark, folder):
    df = io.read_series(spark, folder, dataset="mill", drop_index=True, file_column="file")
    assert df.columns == ["x", "label", "file"]
    assert sorted((r.file, r.label) for r in df.collect()) == [
        ("01.csv", "a"),
        ("01.csv", "b"),
        ("02.csv", "c"),
        ("10.csv", "d"),
    ]
    assert dict(df.dtypes)["x"] == "double"


def test_list_files_by_name(spark, folder):
    files = io.list_files(spark, f"{folder}/mill", ".csv").collect()
    assert [r.file for r in files] == ["01.csv", "02.csv", "10.csv"]


def test_read_clean(spark, folder):
    schema = "idx int, x double, label string"
    assert io.read_clean(spark, f"{folder}/mill", schema=schema).count() == 3
    assert io.read_clean(spark, f"{folder}/mill", ["x"], schema=schema).count() == 4


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3,)], "x int")
    assert sorted(map(tuple, io.union_by_name([a, b]).collect()), key=str) == [(1, 2), (3, None)]


@pytest.mark.parametrize("name", ["messages", "alerts"])
def test_report_under_either_name(spark, tmp_path, name):
    path = tmp_path / "report.json"
    path.write_text(json.dumps({name: ["[ZEROS] x"], "variables": {}}, indent=1))
    assert [r.message for r in io.read_report(spark, str(path)).collect()] == ["[ZEROS] x"]


def test_write_series_makes_one_folder_each(spark, tmp_path):
    df = spark.range(20).withColumn("s", F.col("id") % 3)
    io.write_series(df, str(tmp_path / "out"), "s", "csv", folders=True)
    assert sorted(p.name for p in (tmp_path / "out").glob("s=*")) == ["s=0", "s=1", "s=2"]


def test_series_names_stay_text_with_a_schema(spark, tmp_path):
    df = spark.createDataFrame([("01", 1.0), ("10", 2.0)], "s string, x double")
    io.write_series(df, str(tmp_path / "out"), "s", folders=True)
    back = io.read_series(spark, str(tmp_path / "out"), "parquet", "x double, s string")
    assert sorted((r.s, r.x) for r in back.collect()) == [("01", 1.0), ("10", 2.0)]


def test_staged_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, [[1.0, 2.0]], None)], "a long, X array<array<double>>, gap double")
    back = session.staged(df, "check")
    assert back.dtypes == df.dtypes and back.collect() == df.collect()


def test_csv_files_are_united_by_name(spark, tmp_path):
    (tmp_path / "1.csv").write_text("i,a,b\n0,1,2.5\n1,3,\n")
    (tmp_path / "2.csv").write_text("i,b,a\n0,20,10\n")
    (tmp_path / "3.csv").write_text("i,a\n0,100\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "other name.csv").write_text("i,c\n0,x\n")
    rows = [(1, 2.5), (3, None), (10, 20.0), (100, None), (None, None)]
    given = io.read_series(spark, str(tmp_path), "csv", "i int, a int, b double", drop_index=True)
    assert sorted(map(tuple, given.collect()), key=str) == sorted(rows, key=str)
    found = io.read_series(spark, str(tmp_path), "csv", drop_index=True, file_column="file")
    assert dict(found.dtypes) == {"a": "int", "b": "double", "c": "string", "file": "string"}
    assert sorted(((r.a, r.b) for r in found.collect()), key=str) == sorted(rows, key=str)
    assert {r.file for r in found.collect()} >= {"1.csv", "other name.csv"} or found.count() == 5


def test_stage_tables_are_deleted_with_their_scope(spark):
    outer = session.staged(spark.range(3), "outer")
    with session.stages(spark):
        inner = session.staged(spark.range(4), "inner")
        path = inner.inputFiles()[0]
        assert inner.count() == 4 and io.list_files(spark, path).count() == 1
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
    assert outer.count() == 3


def test_write_series_makes_no_more_files_than_tasks(spark, tmp_path):
    df = spark.range(3_000).select((F.col("id") % 700).cast("string").alias("s"), "id")
    io.write_series(df, str(tmp_path / "out"), "s")
    files = io.list_files(spark, str(tmp_path / "out"), ".parquet")
    assert files.count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert io.read_series(spark, str(tmp_path / "out"), "parquet").exceptAll(df).count() == 0


def test_headers_of_files_in_many_pieces(spark, tmp_path):
    """Files cut into pieces: every header is found, whichever task its file begins in."""
    for i in range(6):
        names = ["a", "b", "c"][: 1 + i % 3]
        lines = [",".join(names), *(",".join([str(k)] * len(names)) for k in range(4000 if i < 4 else 3))]
        (tmp_path / f"f{i}.csv").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        spark.conf.set("spark.sql.files.openCostInBytes", "64")
        groups = io._files_by_header(spark, str(tmp_path))
        rows = io.read_series(spark, str(tmp_path), "csv").count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert [[p[-6:] for p in g] for g in groups] == [["f0.csv", "f3.csv"], ["f1.csv", "f4.csv"], ["f2.csv", "f5.csv"]]
    assert rows == 4 * 4000 + 2 * 3


def test_a_whole_piece_is_left_after_its_first_batch():
    import pyarrow as pa

    def batch(start, length, size, lines, path="p"):
        n = len(lines)
        return pa.RecordBatch.from_arrays(
            [pa.array(lines), pa.array([path] * n), pa.array([start] * n), pa.array([length] * n), pa.array([size] * n)],
            names=["value", "path", "start", "length", "size"],
        )

    def pulled(batches):
        taken = []

        def feed():
            for b in batches:
                taken.append(b)
                yield b

        return [r for out in io.first_lines(feed()) for r in out.to_pylist()], len(taken)

    rows, n = pulled([batch(0, 10, 100, ["head", "x"]), batch(0, 10, 100, ["y"])])
    assert rows == [{"path": "p", "head": "head"}] and n == 1
    assert pulled([batch(10, 10, 100, ["x"]), batch(10, 10, 100, ["y"])]) == ([], 1)
    mixed = [batch(0, 5, 5, ["h1", "x"], "a"), batch(0, 5, 5, ["y"], "a"), batch(90, 10, 100, ["z"], "p"), batch(0, 4, 4, ["h2"], "b")]
    rows, n = pulled(mixed)
    assert rows == [{"path": "a", "head": "h1"}, {"path": "b", "head": "h2"}] and n == 4


def test_types_are_found_without_failing_casts(spark, monkeypatch):
    """The types are those of plain casts over all values; the other types are tried on columns without numbers only."""
    cells = {
        "int": ["1", " 2 ", "+3", "-0004", None],
        "bigint": ["1", "2147483648", "-9223372036854775808", None],
        "double": ["1", ".5", "-1e3", "NaN", "Infinity", "0x1p3", "2.5d", "9223372036854775808", "1."],
        "boolean": ["t", " YES ", "0", "False", "n"],
        "timestamp": ["2001", "2001-02-03", "2001-02-03 04:05:06.7", " 2001-02 "],
        "string": ["1", "2020-01-01", "x", "", "1 2", "--1", "1e", "+", "true"],
    }
    tried = []
    taken = io._taken
    monkeypatch.setattr(io, "_taken", lambda c, kind: tried.append((c, kind)) or taken(c, kind))
    longest = max(map(len, cells.values()))
    rows = [tuple((values + [None] * longest)[n] for values in cells.values()) for n in range(longest)]
    df = spark.createDataFrame(rows, ", ".join(f"as_{kind} string" for kind in cells))
    found = dict(io._typed(df, df.columns).dtypes)
    assert found == {f"as_{kind}": kind for kind in cells}
    assert {c for c, kind in tried if kind in ("boolean", "timestamp")} == {"as_boolean", "as_timestamp", "as_string"}
    for kind in ("int", "bigint", "double", "boolean", "timestamp"):
        for c in df.columns:
            same = df.where(f"{c} IS NOT NULL").select(taken(c, kind).alias("a"), F.expr(f"try_cast({c} AS {kind}) IS NOT NULL").alias("b"))
            assert same.where("a <> b").count() == 0, (c, kind)
