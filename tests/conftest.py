import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from cohortlens.session import BASE_CONF, configure

    builder = (SparkSession.builder.master("local[4]").appName("cohortlens-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="cohortlens-test-warehouse-"))
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cohortlens-test-ckpt-")))
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s
    s.stop()
