from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tests"):
    sys.path.insert(0, str(folder))

from vigilake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(shuffle_partitions=4, checkpoint_dir=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def clean_events(spark):
    """100 clean events, two seconds apart, over three pods."""
    from pyspark.sql import functions as F

    from vigilake.operators.cleaning import add_severity_numeric

    i = F.col("id")

    def cycle(*values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (i % len(values) + 1).cast("int"))

    rows = spark.range(100).select(
        (F.lit("2026-03-23 10:00:00").cast("timestamp") + F.make_dt_interval(secs=i * 2)).alias("timestamp"),
        cycle("falco", "kubearmor").alias("source"),
        F.concat(F.lit("evt-"), F.lpad(i.cast("string"), 4, "0")).alias("event_id"),
        F.concat(F.lit("pod-"), (i % 3).cast("string")).alias("pod"),
        F.lit("test").alias("namespace"),
        cycle("LOW", "MEDIUM", "HIGH", "CRITICAL").alias("severity"),
        cycle("process_execution", "network_connection", "shell_execution", "file_access").alias("event_type"),
        cycle("execve", "connect", "read", "").alias("syscall"),
        cycle("python", "nginx", "bash").alias("process"),
        F.concat(F.lit("10.0.0."), (i % 5).cast("string")).alias("net_dst_ip"),
        cycle(80, 443, 8080, 0).alias("net_dst_port"),
        cycle("T1609", "T1611", "", None).alias("mitre_technique"),
    )
    return rows.transform(add_severity_numeric).cache()
