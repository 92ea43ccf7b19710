"""Scratch locations under the shared checkpoint directory (never a
machine-local temp folder on a cluster)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from seqrisk.session import SCRATCH, scratch_path


def scratch_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, SCRATCH, f"{name}-{uuid.uuid4().hex[:12]}")
