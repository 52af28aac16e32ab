import gzip
import json
import os
import subprocess
import sys
import zlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType, StructField, StructType

from ledgerloom import session
from ledgerloom.sources import delimited
from ledgerloom.sources.delimited import locate_input, read_delimited, write_delimited
from ledgerloom.sources.schemas import RAW_SCHEMAS
from ledgerloom.sources.tables import in_parallel, read_table, stored, write_table

SCHEMA = StructType(
    [
        StructField("id", LongType()),
        StructField("amount", DecimalType(12, 2)),
        StructField("k_symbol", StringType()),
        StructField("n", IntegerType()),
    ]
)
TWO_COLUMNS = StructType([StructField("a", IntegerType()), StructField("b", StringType())])


def write(path, text):
    path.write_text(text)
    return str(path)


def test_reading_binds_by_name_and_keeps_blanks(spark, tmp_path):
    path = write(tmp_path / "t.asc", '"k_symbol";"ID";"extra";"n";"amount"\n" ";1;x;5;"700.5"\n"";2;y;;12\n" SIPO ";3;;-1;0\nNA;4;z;7;\n')
    rows = read_delimited(spark, path, SCHEMA).orderBy("id").collect()
    assert [r.k_symbol for r in rows] == [" ", None, " SIPO ", "NA"]
    assert [r.n for r in rows] == [5, None, -1, 7]
    assert [r.amount and float(r.amount) for r in rows] == [700.5, 12.0, 0, None]


def test_reading_stops_at_a_bad_value(spark, tmp_path):
    path = write(tmp_path / "t.asc", "id;amount;k_symbol;n\n1;2.5;a;5\n2;x;b;6\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_delimited(spark, path, SCHEMA).collect()


def test_reading_names_missing_columns(spark, tmp_path):
    path = write(tmp_path / "t.asc", "id;amount;n\n1;2.5;5\n")
    with pytest.raises(ValueError, match="k_symbol"):
        read_delimited(spark, path, SCHEMA)


def test_locating_the_input(spark, tmp_path):
    assert locate_input(spark, "/given/", []) == "/given"
    with pytest.raises(FileNotFoundError, match="trans.asc"):
        locate_input(spark, None, [str(tmp_path)])
    write(tmp_path / "trans.asc", "trans_id\n")
    assert locate_input(spark, None, [str(tmp_path / "other"), str(tmp_path)]) == str(tmp_path)


def test_text_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, None, " ", 5), (2, None, None, None), (3, None, ' a;"b" ', 7)], SCHEMA)
    write_delimited(df, str(tmp_path / "out"), sep=";")
    back = read_delimited(spark, str(tmp_path / "out"), SCHEMA)
    assert sorted(back.collect()) == sorted(df.collect())


def test_tables_are_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(10), path)
    assert write_table(spark.range(3), path).count() == 3
    with pytest.raises(Exception, match="(?i)divi"):
        write_table(spark.range(3).selectExpr("1 div (id - id) as id"), path)


def test_stored_rows_live_in_the_shared_folder(spark):
    df = stored(spark.range(5), "five")
    assert df.count() == 5
    assert df.inputFiles()[0].removeprefix("file://").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_cluster_needs_the_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Cluster:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster())


def test_parallel_actions_raise(spark):
    done = []
    with pytest.raises(ZeroDivisionError):
        in_parallel([lambda: done.append(1), lambda: 1 / 0, lambda: done.append(2)])
    assert sorted(done) == [1, 2]


def test_schemas_cover_the_files():
    assert {name: len(schema) for name, schema in RAW_SCHEMAS.items()} == {
        "account": 4, "client": 3, "disp": 4, "card": 4, "loan": 7, "order": 6, "district": 16, "trans": 10}
    assert issubclass(AnalysisException, Exception)


def test_parts_are_bound_by_their_own_headers(spark, tmp_path):
    parts = tmp_path / "t.asc"
    parts.mkdir()
    write(parts / "part-0", "id;amount;k_symbol;n\n1;2.5;a;5\n")
    write(parts / "part-1", '"n";"extra";"k_symbol";"amount";"ID"\n7;x;b;3;2\n')
    write(parts / "part-2", "")
    rows = read_delimited(spark, str(parts), SCHEMA).orderBy("id").collect()
    assert [(r.id, float(r.amount), r.k_symbol, r.n) for r in rows] == [(1, 2.5, "a", 5), (2, 3.0, "b", 7)]


def test_a_part_with_a_foreign_header_is_an_error(spark, tmp_path):
    parts = tmp_path / "t.asc"
    parts.mkdir()
    write(parts / "part-0", "id;amount;k_symbol;n\n1;2.5;a;5\n")
    write(parts / "part-1", "client;type\n1;x\n")
    with pytest.raises(ValueError, match="amount"):
        read_delimited(spark, str(parts), SCHEMA)


def test_a_failed_rebuild_keeps_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    bad = spark.range(5).selectExpr("IF(id = 4, raise_error('no'), id) AS id")
    with pytest.raises(Exception, match="no"):
        write_table(bad, path)
    assert read_table(spark, path).count() == 3
    reader = read_table(spark, path)
    write_table(spark.range(7), path)
    assert (reader.count(), read_table(spark, path).count()) == (3, 7)
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "none"))


def test_headers_of_many_parts_are_read_in_tasks(spark, tmp_path, monkeypatch):
    folder = tmp_path / "many parts %41"
    folder.mkdir()
    for k in range(150):
        header, row = ("a;b", f"{k};x{k}") if k % 3 else ("b;more;a", f"x{k};?;{k}")
        text = f"{header}\r\n{row}\r\n".encode()
        if k % 5 == 0:
            (folder / f"part {k}.csv.gz").write_bytes(gzip.compress(text))
        else:
            (folder / f"part {k}.csv").write_bytes(text)
    (folder / "empty.csv").write_bytes(b"")
    (folder / "long.csv").write_bytes(b"\xef\xbb\xbfa;b;" + b"z" * 100_000 + b"\n150;x150;1\n")
    with monkeypatch.context() as patch:
        patch.setattr(delimited, "_first_line", None)
        got = read_delimited(spark, str(folder), TWO_COLUMNS)
    expected = [(k, f"x{k}") for k in range(151)]
    assert sorted(map(tuple, got.collect())) == expected
    (folder / "packed.csv.deflate").write_bytes(zlib.compress(b"b;a\nx151;151\n"))
    got = read_delimited(spark, str(folder), TWO_COLUMNS)
    assert sorted(map(tuple, got.collect())) == [*expected, (151, "x151")]
    (folder / "wrong.csv").write_bytes(b"a;c\n1;2\n")
    with pytest.raises(ValueError, match="wrong.csv lacks the columns"):
        read_delimited(spark, str(folder), TWO_COLUMNS)


def test_a_partitioned_write_sorts_nothing(spark, tmp_path):
    """In a session of its own that logs its plans; the rows of each task go to folders in turn."""
    program = f"""
from pyspark.sql import functions as F
from ledgerloom.session import build_session
from ledgerloom.sources.tables import replace_partitions, write_table
spark = build_session("log", "local[2]", spark__eventLog__enabled="true", spark__eventLog__dir={str(tmp_path)!r},
                      spark__eventLog__rolling__enabled="false", spark__eventLog__compress="false",
                      spark__checkpoint__dir={str(tmp_path / "shared")!r})
df = spark.range(0, 600, 1, 2).select("id", (F.col("id") % 7).cast("int").alias("part"))
table = write_table(df, {str(tmp_path / "table")!r}, ["part"])
assert sorted(map(tuple, table.collect())) == [(i, i % 7) for i in range(600)]
again = replace_partitions(df.where("part = 3").selectExpr("-id AS id", "part"), {str(tmp_path / "table")!r}, ["part"])
assert sorted(map(tuple, again.collect())) == sorted((-i if i % 7 == 3 else i, i % 7) for i in range(600))
assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
spark.stop()
"""
    (tmp_path / "program.py").write_text(program)
    env = {**os.environ, "PYTHONPATH": os.pathsep.join(sys.path)}
    subprocess.run([sys.executable, str(tmp_path / "program.py")], env=env, check=True, timeout=120)
    (log,) = [p for p in tmp_path.iterdir() if p.name.startswith(("local-", "app-"))]
    plans = [json.loads(line).get("physicalPlanDescription", "") for line in log.read_text().splitlines()]
    writes = [plan for plan in plans if "InsertIntoHadoopFsRelationCommand" in plan]
    assert len(writes) >= 2 and not any("Sort" in plan for plan in writes)
