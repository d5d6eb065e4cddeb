"""The library in sessions it did not build."""

import os
import subprocess
import sys

import pytest

from stayflow.session import REQUIRED, require
from stayflow.sources.scratch import shared_dir

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", REQUIRED)
def test_unset_settings_are_applied(spark, key):
    spark.conf.unset(key)
    require(spark)
    assert spark.conf.get(key).lower() == REQUIRED[key].lower()


def test_no_temporary_folder_on_a_cluster(spark, monkeypatch):
    class Session:
        conf = {}
        sparkContext = type("Context", (), {"master": "local-cluster[2,1,1024]"})

    with pytest.raises(ValueError):
        shared_dir(Session)
    Session.conf = {"spark.checkpoint.dir": "/shared"}
    assert shared_dir(Session).startswith("/shared/")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_entry_in_a_plain_session():
    code = (
        "from pyspark.sql import SparkSession; import __spark_entry__ as e; "
        "s = SparkSession.builder.master('local[4]').config('spark.sql.shuffle.partitions', '4').getOrCreate(); "
        "assert e.entry(s).count() > 0"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, capture_output=True, timeout=600)
