"""Sessions without any settings of the installation."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[1])

SCRIPT = """
from pyspark.sql import SparkSession
from logloom.session import cut_lineage, shared_dir
spark = SparkSession.builder.master("{master}").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0]
assert cut_lineage(spark.range(5), spark, "five").count() == 5
print("fine")
"""


def run(tmp_path, master):
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(master=master)], env=env, capture_output=True, text=True, timeout=300)
    return done.stdout.strip(), done.stderr


def test_a_local_session_needs_no_settings(tmp_path):
    for master in ("local", "local[2]"):
        out, err = run(tmp_path, master)
        assert out.endswith("fine"), err[-2000:]


def test_a_cluster_without_a_shared_folder_is_refused():
    import pytest

    from logloom import session

    class Conf:
        def get(self, name, default):
            return default

    class Context:
        master = "spark://host:7077"

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.shared_dir(Cluster(), "x")
