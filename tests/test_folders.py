"""A replaced folder survives a write that breaks off at any point."""

import shutil

import pytest

from helpers import rows
from zonarium.sources.folders import replace_folder, settle


def write(spark, value):
    return lambda path: spark.createDataFrame([(value,)], "x int").write.parquet(path)


def test_replaced_and_broken(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_folder(spark, path, write(spark, 1))
    replace_folder(spark, path, write(spark, 2))
    assert rows(spark.read.parquet(path)) == [(2,)]

    def broken(new):
        write(spark, 3)(new)
        (tmp_path / "t.new" / "_SUCCESS").unlink()
        raise OSError("lost")

    with pytest.raises(OSError):
        replace_folder(spark, path, broken)
    settle(spark, path)
    assert rows(spark.read.parquet(path)) == [(2,)]

    # Broken off between the two renames: the new content is complete.
    shutil.rmtree(tmp_path / "t.new")
    write(spark, 4)(f"{path}.new")
    (tmp_path / "t").rename(tmp_path / "t.old")
    settle(spark, path)
    assert rows(spark.read.parquet(path)) == [(4,)]

    # Broken off there with no complete new content: the old one comes back.
    (tmp_path / "t").rename(tmp_path / "t.old")
    settle(spark, path)
    assert rows(spark.read.parquet(path)) == [(4,)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]
