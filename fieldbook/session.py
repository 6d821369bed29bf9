"""Session construction and session-derived settings."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on.  Timestamps in the sources are zone-less; the
# calendar logic (``to_date``, ``date_trunc``) must not depend on the host zone.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", app: str = "fieldbook",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster the submitter provides the session."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names it.  Only a local master may leave it unset (tests): a
    private folder is created then; elsewhere executors could not share it.
    Lineage is cut by tables written there (``materialize``).
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="fieldbook-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # noqa: BLE001 - remote sessions take the folder from the conf
        pass
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Writes in this block delete their shuffle files when they end, not when
    the driver happens to collect its garbage.  Only for writes: each plans its
    own shuffles, so no later action asks for them."""
    conf = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(conf, None)
    spark.conf.set(conf, "true")
    try:
        yield
    finally:
        spark.conf.unset(conf) if before is None else spark.conf.set(conf, before)


def materialize(df, name: str = "table", codec: str | None = None):
    """Write ``df`` once as parquet under the shared checkpoint folder and
    continue from the written copy: a dataset read several times is computed
    once (one job, unlike an eager RDD checkpoint which computes its input
    twice), its lineage is cut, and a lost executor does not recompute it.
    ``codec``: of the parquet files, if not the session's."""
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, os.path.join("tables", f"{name}-{uuid.uuid4().hex}"))
    df.write.mode("overwrite").options(**({"compression": codec} if codec else {})).parquet(path)
    return spark.read.parquet(path)


def materialize_compact(df, name: str = "table"):
    """``materialize`` for rows as large as the input: the strongest of the
    quick codecs, and the shuffles that made them are released."""
    with shuffles_released(df.sparkSession):
        return materialize(df, name, "zstd")
