"""Damaged files are left out whole and reported, never half-read."""

import os

import pytest

from racelens.session import scratch_path
from racelens.sources import wide as W


def _folder(spark, name):
    return scratch_path(spark, name).replace("file:", "")


def _write(spark, folder, first, n, column):
    spark.range(first, first + n, 1, 1).selectExpr("id", f"cast(id * 7919 % 10007 as double) as {column}").write.option(
        "parquet.block.size", 1 << 16).parquet(folder)
    return [f"{folder}/{f}" for f in os.listdir(folder) if f.endswith(".parquet")]


def test_damaged_files_are_reported_and_left_out(spark):
    base = _folder(spark, "damaged")
    _write(spark, f"{base}/a", 0, 1000, "km_5")
    _write(spark, f"{base}/b{{x}} 1%20", 1000, 500, "km_10")       # a name that globs and decoding would change
    (middle,) = _write(spark, f"{base}/c", 5000, 40_000, "km_5")
    (cut,) = _write(spark, f"{base}/d", 90_000, 1000, "km_5")
    with open(middle, "r+b") as f:                                # the footer stays as it was
        f.seek(os.path.getsize(middle) // 2)
        f.write(b"\xa5" * 64)
    os.truncate(cut, os.path.getsize(cut) - 20)
    os.makedirs(f"{base}/e")
    for name, content in (("junk", b"not parquet"), ("empty", b"")):
        with open(f"{base}/e/{name}", "wb") as f:
            f.write(content)
    report = _folder(spark, "report")
    got = W.recursive_load(spark, base, quarantine=report)
    assert set(got.columns) == {"id", "km_5", "km_10"}
    assert got.count() == 1500 and got.selectExpr("sum(id)").first()[0] == sum(range(1500))
    rows = {os.path.basename(os.path.dirname(r.path)) + ("/" + os.path.basename(r.path) if "/e/" in r.path else ""): r
            for r in spark.read.parquet(report).collect()}
    assert {k for k, r in rows.items() if r.reason is None} == {"a", "b{x} 1%20"}
    assert {k for k, r in rows.items() if r.reason} == {"c", "d", "e/junk"}           # a file of no bytes holds nothing and is not listed
    assert rows["a"].n_rows == 1000 and rows["c"].n_rows is None
    shallow = {os.path.basename(os.path.dirname(r.path)) for r in W.probe(spark, base, deep=False).collect() if r.reason is None}
    assert shallow == {"a", "b{x} 1%20", "c"}                     # its footer alone does not show the damage


def test_nothing_readable(spark):
    base = _folder(spark, "junk-only")
    os.makedirs(base)
    with open(f"{base}/junk", "w") as f:
        f.write("x")
    with pytest.raises(FileNotFoundError):
        W.recursive_load(spark, base)
