import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from shelfwise.session import RECOMMENDED_CONF, ensure_checkpoint_dir
    builder = (SparkSession.builder.master("local[*]")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "4g"))
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="shelfwise-test-")


def rows(df, *cols):
    """Collect (ordered by the given columns) as plain tuples."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.orderBy(*sel.columns).collect()]
