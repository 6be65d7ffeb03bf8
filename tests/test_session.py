import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PLAIN = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from msgloom.staging import Staging, shared_folder
from msgloom.session import local_session
assert shared_folder(spark) == shared_folder(spark.newSession())
work = Staging(spark)
assert work.write(spark.range(5), "five").count() == 5
work.drop()
from __spark_entry__ import queries
print("ROWS", queries()["user_text"](spark, "/root/testdata/sf0.001").count())
"""


def test_a_plain_local_session_needs_no_configuration(tmp_path):
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": ROOT}
    run = subprocess.run([sys.executable, "-c", PLAIN], env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    assert int(run.stdout.split("ROWS")[1]) > 0


def test_benchmark_ends_well_and_leaves_no_tables(tmp_path):
    env = os.environ | {"BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "2", "TMPDIR": str(tmp_path)}
    run = subprocess.run([sys.executable, "bench.py", "user_text", "filter_messages"], cwd=ROOT, env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    assert '"queries": {"user_text"' in run.stdout
    assert not list(tmp_path.glob("msgloom-bench-*/*"))
