"""The package reaches workers that do not have it on their path."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
JOB = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import functions as F
from stridelake.session import build_session, ship_package
spark = build_session("shipped", "local[1]", **{"spark.ui.enabled": "false"})
ship_package(spark)
from stridelake.functions.crc import crc16, crc16_arc
found = spark.createDataFrame([("123456789",)], "t string").select(crc16_arc(F.col("t").cast("binary"))).first()[0]
assert found == crc16(b"123456789") == 0xBB3D, found
print("shipped")
"""


def test_package_is_shipped(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", JOB, REPO], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "shipped" in done.stdout, done.stderr[-2000:]
