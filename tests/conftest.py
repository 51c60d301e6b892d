import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from loanmart.session import apply_conf, checkpoint_root

    import tempfile
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="loanmart-warehouse-"))
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_conf(s)
    checkpoint_root(s)  # session setting if present, else a private folder (tests only)
    yield s


def rows(df, *cols):
    """Sorted list of tuples of the given columns."""
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
