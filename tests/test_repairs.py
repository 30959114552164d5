"""Cases that used to lose or hide rows."""

import gzip
import os
import shutil

import pytest
from pyspark.sql import functions as F

from caselake.functions import identity
from caselake.sources import csv_intake


def test_csv_files_below_a_folder_with_a_blank_are_read(spark, tmp_path):
    folder = tmp_path / "a b+c%20d"
    folder.mkdir()
    with gzip.open(folder / "x.csv.gz", "wt") as file:
        file.write("ID,DT\n1,2024-01-05\n")
    files = csv_intake.file_digests(spark, str(tmp_path)).select("file_sha256", "source_file")
    rows = csv_intake.read_drop(spark, str(tmp_path), ["ID", "DT"], files, "DT")
    assert rows.count() == 1


def test_files_load_once_and_known_ones_are_not_opened(spark, tmp_path):
    drop, root = tmp_path / "a b", str(tmp_path / "loaded")
    drop.mkdir()

    def put(name, *days):
        with gzip.open(drop / name, "wt") as file:
            file.write("".join(["ID,DT\n", *(f"{name[0]},{d}\n" for d in days)]))

    def load(number):
        return csv_intake.load_drop(spark, str(drop), ["ID", "DT"], "DT", root, f"l{number}")

    put("x.csv.gz", "2024-01-05", "2024-01-06")
    put("empty.csv.gz")
    assert load(1) == 2
    old = drop / "x.csv.gz"
    before = old.stat()
    shutil.copy(old, drop / "renamed.csv.gz")
    old.write_bytes(b"#" * before.st_size)  # would fail any reader
    os.utime(old, ns=(before.st_atime_ns, before.st_mtime_ns))
    put("y.csv.gz", "2024-02-01")
    assert load(2) == 1 and load(3) == 0
    assert sorted((r["id"], r["load_id"]) for r in csv_intake.loaded_rows(spark, root).collect()) == [("x", "l1"), ("x", "l1"), ("y", "l2")]
    ledger = {(r["source_file"].rpartition("/")[2], r["record_count"], r["load_id"]) for r in csv_intake.read_ledger(spark, root).collect()}
    assert ledger == {("x.csv.gz", 2, "l1"), ("empty.csv.gz", 0, "l1"), ("y.csv.gz", 1, "l2")}


def test_a_load_that_breaks_off_does_not_count(spark, tmp_path, monkeypatch):
    (tmp_path / "drop").mkdir()
    with gzip.open(tmp_path / "drop" / "x.csv.gz", "wt") as file:
        file.write("ID,DT\n1,2024-01-05\n")
    with monkeypatch.context() as patch:
        patch.setattr(csv_intake, "ledger_rows", lambda rows: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            csv_intake.load_drop(spark, str(tmp_path / "drop"), ["ID", "DT"], "DT", str(tmp_path / "out"), "l1")
    assert csv_intake.loaded_rows(spark, str(tmp_path / "out")).count() == 0
    assert csv_intake.load_drop(spark, str(tmp_path / "drop"), ["ID", "DT"], "DT", str(tmp_path / "out"), "l2") == 1
    assert [r["load_id"] for r in csv_intake.loaded_rows(spark, str(tmp_path / "out")).collect()] == ["l2"]


def test_unknown_key_version_fails(spark):
    ring = identity.keyring(spark, {"v1": b"k" * 32})
    people = spark.createDataFrame([("1",)], "number string")
    assert identity.with_fingerprint(people, "number", ring, "v1").where(F.col("fingerprint").isNotNull()).count() == 1
    with pytest.raises(Exception, match="no version v9"):
        identity.with_fingerprint(people, "number", ring, "v9").collect()
