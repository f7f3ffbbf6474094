"""The report sink: what is committed, replaced and taken away."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sievework.sources.reports import exit_code, read_findings, verdict, write_report

SCHEMA = "kind string, subject string, message string"


def made(spark, n, kind="a"):
    return spark.range(n).repartition(4).select(F.lit(kind).alias("kind"), F.col("id").cast("string").alias("subject"), F.concat(F.lit('é "x"\n'), "id").alias("message"))


def files(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names)


def test_findings_and_report(spark, tmp_path):
    folder = str(tmp_path / "r")
    rows = made(spark, 1000).unionByName(made(spark, 10, "b"))
    write_report(rows, spark.createDataFrame([(3, 4)], "files long, members long"), folder)
    assert sorted(map(tuple, read_findings(spark, folder).collect())) == sorted(map(tuple, rows.collect()))
    assert verdict(folder) == {"ok": False, "n_errors": 1010, "kinds": {"a": 1000, "b": 10}, "counts": {"files": 3, "members": 4}}
    assert exit_code(folder) == 1 and not [f for f in files(folder) if "pending" in f]


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_clean_and_replaced(spark, tmp_path, scheme):
    folder = scheme + str(tmp_path / "r")
    assert exit_code(folder) == 2
    with pytest.raises(FileNotFoundError):
        read_findings(spark, folder)
    write_report(made(spark, 5), None, folder)
    assert exit_code(folder) == 1
    write_report(spark.createDataFrame([], SCHEMA), None, folder)
    assert exit_code(folder) == 0 and read_findings(spark, folder).count() == 0
    assert verdict(folder) == {"ok": True, "n_errors": 0, "kinds": {}, "counts": {}}


def test_failed_write_leaves_the_old_report(spark, tmp_path):
    folder = str(tmp_path / "r")
    write_report(made(spark, 5), None, folder)
    before = {f: (tmp_path / "r" / f).read_bytes() for f in files(folder)}
    broken = made(spark, 100).withColumn("message", F.when(F.col("subject") == "77", F.raise_error(F.lit("stop"))).otherwise(F.col("message")))
    with pytest.raises(Exception, match="stop"):
        write_report(broken, None, folder)
    assert {f: (tmp_path / "r" / f).read_bytes() for f in files(folder)} == before and exit_code(folder) == 1


def test_nulls_and_extra_columns(spark, tmp_path):
    folder = str(tmp_path / "r")
    rows = spark.createDataFrame([(1, "m", None, "k"), (2, None, "s", None)], "kinds int, message string, subject string, kind string")
    write_report(rows, None, folder)
    lines = [json.loads(x) for f in files(folder) if f.endswith("jsonl") for x in open(os.path.join(folder, f), encoding="utf-8")]
    assert sorted(lines, key=str) == sorted([{"kind": "k", "subject": None, "message": "m"}, {"kind": None, "subject": "s", "message": None}], key=str)
    assert verdict(folder)["n_errors"] == 2
