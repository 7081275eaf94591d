import os
import subprocess
import sys

from ledgermill.session import clear_scratch, scratch_path


def test_scratch_is_cleared(spark):
    clear_scratch(spark)
    kept, paths = spark.range(3), [scratch_path(spark, "one") for _ in range(3)]
    for path in paths[:2]:
        kept.write.parquet(path)
    assert clear_scratch(spark) == 2 and not any(map(os.path.exists, paths))
    assert clear_scratch(spark) == 0 and kept.count() == 3


def test_scratch_is_cleared_when_the_driver_ends(tmp_path):
    code = """
from checks.compare import local_session
from ledgermill.session import scratch_path
spark = local_session(1)
path = scratch_path(spark, "left")
spark.range(3).write.parquet(path)
print("wrote", path)
"""
    submit = f"--conf spark.checkpoint.dir={tmp_path} pyspark-shell"
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": submit}
    out = subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=300, env=env, text=True).stdout
    assert f"wrote {tmp_path}/left-" in out and not list(tmp_path.glob("left-*"))
