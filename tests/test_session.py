"""Shared-storage helpers: the checkpoint folder comes from the session."""

from __future__ import annotations

import os

from ledgerline.session import ensure_checkpoint_dir, path_exists, scratch_path, shared_root


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    ckpt = ensure_checkpoint_dir(spark)
    assert ckpt == spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b  # a fresh folder per use
    assert a.startswith(shared_root(spark)) and shared_root(spark).startswith(ckpt.rstrip("/"))


def test_path_exists(spark, tmp_dir):
    assert not path_exists(spark, f"{tmp_dir}/nothing")
    os.makedirs(f"{tmp_dir}/empty")
    assert not path_exists(spark, f"{tmp_dir}/empty")  # an empty folder is not a table
    spark.range(3).write.parquet(f"{tmp_dir}/t")
    assert path_exists(spark, f"{tmp_dir}/t")
