import os
import sys
import time

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fieldbook.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", app="fieldbook-tests", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, order=None):
    """Collected rows as tuples, sorted for order-free comparison."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=repr) if order is None else out


def shuffled_bytes(spark, most=None):
    """Bytes of shuffle files on disk; waits a while until they are ``most`` at most (files are deleted in the background)."""
    folders = [d.toString() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    for _ in range(40):
        n = sum(os.path.getsize(os.path.join(d, f)) for top in folders for d, _, names in os.walk(top) for f in names if f.startswith("shuffle_"))
        if most is None or n <= most:
            break
        time.sleep(0.25)
    return n
