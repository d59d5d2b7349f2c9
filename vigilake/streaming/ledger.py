"""Which pods are isolated, kept beside the response ledger so that a micro-batch reads only what it asks about.

The ledger itself is an append-only audit log. Its state is one row per pod: the time of the latest isolation and of the
latest rollback. The state lies in ``_state`` below the ledger, which readers of the log skip:

* ``deltas/<run>@<batch>``: the rows of one batch, written after its log entries;
* ``base-<n>-<id>/bucket=<b>``: all older batches merged, by a hash of the pod;
* ``current-<n>``: a file with the name of base n; the highest number counts.

Both times are maxima, so merging a delta twice changes nothing and every step may be repeated after a crash: a base without
its pointer is not read, and deltas that outlive their merge are merged again. A batch that may still be replayed, the last
one of each run, stays a delta, so that a replay can leave out its own rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
MERGE_AT = 16           # deltas that are merged into a new base
ROLLBACK = "rollback-"  # runs that end with their only batch
STATE = "namespace string, pod string, isolated timestamp, undone timestamp"


def bucket_of() -> Column:
    return F.pmod(F.xxhash64("namespace", "pod"), F.lit(BUCKETS)).cast("int")


class Folder:
    """The state folder of a ledger in whatever store it lies."""

    def __init__(self, spark: SparkSession, ledger: str):
        self.spark, self.path = spark, f"{ledger.rstrip('/')}/_state"
        self._jvm = spark._jvm
        self.store = self._of(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _of(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, below: str = "") -> list[str]:
        where = self._of(f"{self.path}/{below}".rstrip("/"))
        return sorted(s.getPath().getName() for s in self.store.listStatus(where)) if self.store.exists(where) else []

    def current(self) -> tuple[int, str | None]:
        """(number, base) of the pointer with the highest number; (0, None) without one."""
        numbers = [int(name.split("-")[1]) for name in self.names() if name.startswith("current-")]
        if not numbers:
            return 0, None
        stream = self.store.open(self._of(f"{self.path}/current-{max(numbers)}"))
        try:
            return max(numbers), self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def point(self, number: int, base: str) -> bool:
        """Make ``base`` the one that is read; False if another writer was first. The name appears only with its content."""
        draft = self._of(f"{self.path}/draft-{uuid.uuid4().hex}")
        stream = self.store.create(draft)
        stream.write(bytearray(base.encode()))
        stream.close()
        target = self._of(f"{self.path}/current-{number}")
        if self.store.exists(target) or not self.store.rename(draft, target):
            self.store.delete(draft, False)
            return False
        return True

    def delete(self, name: str) -> None:
        self.store.delete(self._of(f"{self.path}/{name}"), True)


def changes(rows: DataFrame) -> DataFrame:
    """(namespace, pod, isolated, undone) of ledger rows (namespace, pod, action, ts)."""
    when = lambda action: F.max(F.when(F.col("action") == action, F.col("ts")))
    latest = rows.groupBy("namespace", "pod").agg(when("isolate_pod").alias("isolated"), when("rollback").alias("undone"))
    return latest.filter("isolated is not null or undone is not null")


def record(folder: Folder, rows: DataFrame, run: str, batch_id: int) -> None:
    """Write the delta of one batch; a replay replaces it."""
    changes(rows).write.mode("overwrite").parquet(f"{folder.path}/deltas/{run}@{batch_id}")


def read(folder: Folder, buckets: list[int] | None = None, without: str | None = None) -> DataFrame:
    """The state of the pods in ``buckets`` (all by default), leaving out the delta named ``without``."""
    spark = folder.spark
    parts = [f"{folder.path}/deltas/{name}" for name in folder.names("deltas") if name != without]
    out = spark.read.schema(STATE).parquet(*parts) if parts else spark.createDataFrame([], STATE)
    _, base = folder.current()
    if base:
        held = spark.read.schema(f"{STATE}, bucket int").parquet(f"{folder.path}/{base}")
        out = out.unionByName((held if buckets is None else held.filter(F.col("bucket").isin(buckets))).drop("bucket"))
    if buckets is not None:
        out = out.filter(bucket_of().isin(buckets))
    return out.groupBy("namespace", "pod").agg(F.max("isolated").alias("isolated"), F.max("undone").alias("undone"))


def isolated(state: DataFrame) -> DataFrame:
    """(namespace, pod) whose latest isolation was not rolled back since."""
    return state.filter("isolated is not null and (undone is null or undone < isolated)").select("namespace", "pod")


def settled_deltas(names: list[str]) -> list[str]:
    """Deltas whose batch can't be replayed any more: rollbacks, and all but the last batch of each run."""
    last: dict[str, int] = {}
    for name in names:
        run, batch = name.rsplit("@", 1)
        last[run] = max(last.get(run, -1), int(batch))
    return [n for n in names if n.startswith(ROLLBACK) or int(n.rsplit("@", 1)[1]) < last[n.rsplit("@", 1)[0]]]


def write_base(folder: Folder, merged: list[str], number: int) -> str:
    """Write the state of the current base and the deltas ``merged`` as a new base, which nobody reads yet."""
    kept = folder.spark.read.schema(STATE).parquet(*[f"{folder.path}/deltas/{name}" for name in merged])
    _, base = folder.current()
    if base:
        kept = kept.unionByName(folder.spark.read.schema(f"{STATE}, bucket int").parquet(f"{folder.path}/{base}").drop("bucket"))
    state = kept.groupBy("namespace", "pod").agg(F.max("isolated").alias("isolated"), F.max("undone").alias("undone"))
    name = f"base-{number}-{uuid.uuid4().hex}"
    state.withColumn("bucket", bucket_of()).repartition("bucket").write.partitionBy("bucket").parquet(f"{folder.path}/{name}")
    return name


def merge(folder: Folder, at: int = MERGE_AT) -> bool:
    """Merge the settled deltas into a new base once there are ``at`` of them; True if it became the current one."""
    merged = settled_deltas(folder.names("deltas"))
    if len(merged) < max(1, at):
        return False
    number, before = folder.current()
    name = write_base(folder, merged, number + 1)
    if not folder.point(number + 1, name):
        folder.delete(name)  # another writer was first; the deltas are in its base or stay
        return False
    for delta in merged:
        folder.delete(f"deltas/{delta}")
    # the base before may still be read by a batch under way; older ones and drafts go
    for old in folder.names():
        if (old.startswith("base-") and old not in (name, before)) or (old.startswith("current-") and int(old.split("-")[1]) < number):
            folder.delete(old)
    return True
