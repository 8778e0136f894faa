"""Very many small files: written by the tasks themselves, replaced as a whole, read by few tasks."""

import os

import pytest
from test_files_and_runs import local

from pagesift.session import new_dir, tune
from pagesift.sinks import files, many_files
from pagesift.sources import csv_files, snapshots


def contents(path):
    """Bytes of the part files by folder."""
    found = {}
    for part in sorted(local(path).rglob("part-*")):
        name = str(part.parent.relative_to(local(path)))
        found[name] = found.get(name, b"") + part.read_bytes()
    return found


@pytest.fixture
def elsewhere(monkeypatch):
    """The paths of a test as if they were in another file system, which Spark writes to."""
    return lambda: monkeypatch.setattr(files, "local_path", lambda spark, path: None)


@pytest.mark.parametrize("encoding", ["UTF-8", "ISO-8859-1"])
def test_pages_as_spark_writes_them(spark, elsewhere, encoding):
    pages = spark.createDataFrame([(1, "<p>x é — </p>"), (2, ' a "\' '), (None, "q")], "page INT, html STRING")
    path = files.write_pages(pages, new_dir(spark, "pages"), encoding)
    assert not list(local(path).rglob(".part*"))  # neither checksums, which Hadoop's writer makes, nor what is unfinished
    elsewhere()
    there = files.write_pages(pages, new_dir(spark, "pages"), encoding)
    assert contents(path) == contents(there) and len(contents(path)) == 3


def test_folder_names(spark):
    for value in ["a b", "a/b:c=%", "'\"#*?\\{[]^", "\x01\x7f", "é"]:
        row = spark.createDataFrame([(value, "x")], "k STRING, v STRING")
        path = new_dir(spark, "names")
        row.write.partitionBy("k").text(path)
        assert many_files.folder_name("k", value) in os.listdir(local(path))
    assert many_files.folder_name("k", "") == many_files.folder_name("k", None) == "k=" + many_files.NO_NAME


def test_a_write_that_fails_leaves_what_was_there(spark):
    rows = spark.range(4).selectExpr("CAST(id AS STRING) AS k", "CAST(id AS STRING) AS line")
    path = new_dir(spark, "lines")
    assert many_files.write_lines(rows, path) == 4
    before = contents(path)
    with pytest.raises(Exception, match="cut"):
        many_files.write_lines(rows.selectExpr("k", "IF(k = '3', raise_error('cut'), 'new') AS line"), path)
    beside = [n for n in os.listdir(local(path).parent) if n.startswith(f".{local(path).name}")]
    assert contents(path) == before and beside == []
    assert many_files.write_lines(rows.where("k < '2'"), path) == 2
    assert contents(path) == {f"k={n}": f"{n}\n".encode() for n in range(2)}
    assert many_files.write_lines(rows.where("k > '8'"), path) == 0
    assert os.listdir(local(path)) and contents(path) == {}


def test_many_small_files_are_listed_and_read_by_few_tasks(spark, tmp_path):
    for n in range(1500):
        (tmp_path / f"{n}.html").write_text(f"<p>{n}</p>")
    pages = snapshots.read_html_files(spark, f"file:{tmp_path}")
    assert pages.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    assert {r.html for r in pages.select("html").collect()} == {f"<p>{n}</p>" for n in range(1500)}
    assert int(tune(spark).conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 256


ODD = ['a "b", c', None, " x ", "l1\nl2", "r\r\nn", "", "-", "é—﻿", ",", '"', "#x", "\t", "a\\b", "1'2"]


@pytest.mark.parametrize("to_a_folder", [1, 3])
def test_batches_as_spark_writes_them(spark, elsewhere, to_a_folder):
    labels = ["a/b:c=%", "", None]
    rows = [
        (i, f"batch_{i // 4}" if i < 20 else labels[i % 3], i // 4, ODD[i % len(ODD)], ODD[(i * 5 + 1) % len(ODD)], i * 1.5 if i % 3 else None)
        for i in range(40)
    ]
    batches = spark.createDataFrame(rows, "row_num LONG, batch_label STRING, batch_id LONG, npsn STRING, name STRING, x DOUBLE")
    path = files.write_batches(batches, new_dir(spark, "batches"), to_a_folder)
    assert not list(local(path).rglob(".part*"))
    elsewhere()
    there = files.write_batches(batches, new_dir(spark, "batches"), to_a_folder)
    assert contents(path) == contents(there) and len(contents(path)) == (7 if to_a_folder == 1 else 4)


def test_many_batch_files_are_read_by_few_tasks(spark):
    rows = spark.range(1500).selectExpr("id + 1 AS row_num", "id AS batch_id", "CAST(id AS STRING) AS batch_label", "CAST(id AS STRING) AS npsn")
    path = files.write_batches(rows, new_dir(spark, "batches"))
    read = csv_files.read_published_csv(spark, path, ["npsn", "batch"])
    assert read.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    assert sorted(map(tuple, read.collect())) == sorted((str(n), str(n)) for n in range(1500))


def test_cells_longer_than_the_readers_buffer(spark):
    cells = ["x" * 65_534 + '",\n"' + "y" * 200_000, ", ".join(["é\n"] * 70_000), "z"]
    rows = spark.createDataFrame([(str(n), cell) for n, cell in enumerate(cells)], "npsn STRING, name STRING").coalesce(1)
    path = files.write_csv(rows, new_dir(spark, "long"))
    assert {int(r.npsn): r.name for r in csv_files.read_published_csv(spark, path, ["npsn", "name"]).collect()} == dict(enumerate(cells))


@pytest.mark.parametrize("charset, text", [("ISO-8859-1", "é plain"), ("windows-1252", "\x80 € \x93"), ("latin1", "\x81\x9f")])
def test_characters_of_windows_1252(spark, tmp_path, charset, text):
    raw = text.replace("€", "\x80").encode("latin-1")
    (tmp_path / "1.html").write_bytes(f'<meta charset="{charset}">'.encode() + raw)
    kept = {0x81, 0x8D, 0x8F, 0x90, 0x9D}
    wanted = "".join(chr(b) if b in kept else bytes([b]).decode("cp1252") for b in raw)
    assert snapshots.read_html_files(spark, f"file:{tmp_path}").first().html.endswith(">" + wanted)
