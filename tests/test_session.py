from pathlib import Path

import pytest

from meshfeed.session import stage, temporary_tables


def folders(spark):
    return {p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir()}


def test_tables_go_with_their_block(spark, tmp_path):
    before = folders(spark)
    with temporary_tables(spark):
        rows = stage(spark.range(5), "outer")
        with temporary_tables(spark):
            stage(rows, "inner").write.parquet(str(tmp_path / "out"))
        assert [n.split("-")[0] for n in folders(spark) - before] == ["outer"]
        assert rows.count() == 5
    assert folders(spark) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_tables_go_after_a_failure(spark):
    before = folders(spark)
    with pytest.raises(Exception, match="broken"), temporary_tables(spark):
        stage(spark.range(5), "whole")
        stage(spark.range(5).selectExpr("raise_error('broken') as id"), "half")
    assert folders(spark) == before


def test_tables_outside_a_block_stay(spark):
    before = folders(spark)
    assert stage(spark.range(3), "kept").count() == 3
    assert len(folders(spark) - before) == 1
