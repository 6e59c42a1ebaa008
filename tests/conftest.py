import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from addrlink.session import _DEFAULTS, _LOCAL, ensure_checkpoint_dir
    b = SparkSession.builder.master("local[4]").appName("addrlink-tests")
    for k, v in (_DEFAULTS | _LOCAL | {"spark.addrlink.spread": "8"}).items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
    b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="addrlink-test-ckpt-"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


def col1(df):
    return [r[0] for r in df.collect()]
