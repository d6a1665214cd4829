"""Records that span lines and splits, against Python's csv module."""

import csv
import io
import random

import pytest

from shoptally import sources

HEADER = "ID;Fecha;Metodo_Pago;ID_Cliente;Total"


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "211")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _read(spark, path):
    return sorted((r.id, r.date or "", r.customer or "", r.total) for r in sources.read_sales(spark, path).collect())


def _field(rng):
    kind = rng.random()
    if kind < 0.15:
        return '"' + rng.choice(['x\ny', 'p;q', 'say ""hi""', '\n\n;"";', 'long ' * 30 + '\n' + 'tail ' * 30, '']) + '"'
    return rng.choice(['5" pipe', "a", "", "b c", 'inch"'])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_csv_module_over_many_splits(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    body = [f"{i};{_field(rng)};Yape;{_field(rng)};{i}.5" for i in range(60)]
    body.insert(30, HEADER)
    text = "﻿report;;;;\n;;;;\n" + HEADER + "\n" + "\n".join(body) + "\n"
    path = tmp_path / "ventas.csv"
    path.write_text(text, encoding="utf-8")
    rows = [r for r in csv.reader(io.StringIO("\n".join(body)), delimiter=";") if r[0] != "ID"]
    assert _read(spark, str(path)) == sorted((r[0], r[1], r[3], r[4]) for r in rows)


def test_one_field_over_whole_splits_and_an_unclosed_one(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i} of a long remark" for i in range(40))
    path = tmp_path / "ventas.csv"
    path.write_text(f'{HEADER}\n1;"{long}";Yape;c;1\n2;d;Yape;c;2\n3;"never closed;Yape;c;3\n4;d;Yape;c;4\n')
    got = _read(spark, str(path))
    assert got[:2] == [("1", long, "c", "1"), ("2", "d", "c", "2")]
    assert [g[0] for g in got] == ["1", "2", "3", "4"] and got[3] == ("4", "d", "c", "4")


def test_files_with_and_without_header(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text("junk;;;;\n" + HEADER + "\n" + "".join(f"{i};d;Yape;c;{i}\n" for i in range(30)))
    (tmp_path / "b.csv").write_text("".join(f"{i};d;Yape;c;{i}\n" for i in range(100, 130)))
    assert {g[0] for g in _read(spark, str(tmp_path))} == {str(i) for i in [*range(30), *range(100, 130)]}


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    path = tmp_path / "ventas.csv"
    path.write_text(HEADER + "\n" + "".join(f"{i};d;Yape;c;{i}\n" for i in range(500)))
    assert sources.read_sales(spark, str(path)).rdd.getNumPartitions() > 20


def test_lines_are_split_into_fields_only_where_the_header_may_be(spark, tmp_path):
    from shoptally.sources import readers

    text = '﻿;;\nI"D;" Fecha";Total\n1;"a\nID;b";2\n"ID";Fecha;Total\n3;c;4\n'
    (tmp_path / "a.csv").write_text(text, encoding="utf-8")
    names = {"ID": "id", "Fecha": "date", "Total": "total"}
    assert readers._header(spark, str(tmp_path), names, ";") == ["ID", "Fecha", "Total"]
    assert sorted(tuple(r) for r in readers._read(spark, str(tmp_path), names, ";").collect()) == [("1", "a\nID;b", "2"), ("3", "c", "4")]
    held = spark.read.text(str(tmp_path)).filter(readers._mentions(["ID", "Fecha"]))
    assert held.count() == 2
