"""The work folder in a session that names none."""
import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

BARE = """
from pyspark.sql import SparkSession
from martlight.session import configure, shared_dir, written
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
configure(spark)
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert written(spark.range(3), "rows").count() == 3
assert shared_dir(spark) == shared_dir(spark)
spark.range(2).checkpoint().count()
print("fine")
"""


def test_bare_session_gets_a_folder_of_its_own():
    env = os.environ | {"SPARK_CONF_DIR": tempfile.mkdtemp(prefix="martlight-conf-")}      # no defaults
    env.pop("PYSPARK_SUBMIT_ARGS", None)
    out = subprocess.run([sys.executable, "-c", BARE], cwd=ROOT, capture_output=True, text=True, timeout=300, env=env)
    assert out.stdout.strip().endswith("fine"), out.stderr[-2000:]
