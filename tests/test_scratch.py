"""Scratch tables of a scope go at its end, and only those."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from seqrisk.operators.ranking import global_rank
from seqrisk.plans.scratch import scratch_dir
from seqrisk.session import cut_lineage, ensure_checkpoint_dir, scratch_scope


def tables(spark):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {p for kind in ("seqrisk-tables", "seqrisk-scratch") for p in glob.glob(f"{base}/{kind}/**/*.parquet", recursive=True)}


def test_scope_drops_its_own_tables(spark, tmp_path):
    kept = cut_lineage(spark.range(10))
    before = tables(spark)
    with scratch_scope(spark):
        ranked = global_rank(spark.range(50), ["id"], 1)
        outer = cut_lineage(spark.range(7))
        with scratch_scope(spark):
            inner = cut_lineage(spark.range(5))
            inner.write.parquet(scratch_dir(spark, "x"))
            assert len(tables(spark)) > len(before)
        assert outer.count() == 7                              # an inner scope leaves the outer one's tables
        ranked.write.parquet(str(tmp_path / "out"))
        assert tables(spark) > before
    assert tables(spark) == before and kept.count() == 10
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.max("rank")).first()[0] == 50
    assert os.path.dirname(scratch_dir(spark, "y")).endswith("seqrisk-scratch")


def test_scope_ends_after_an_error_and_when_empty(spark):
    before = tables(spark)
    with pytest.raises(ValueError):
        with scratch_scope(spark):
            cut_lineage(spark.range(3))
            raise ValueError("job failed")
    with scratch_scope(spark):
        pass
    assert tables(spark) == before
