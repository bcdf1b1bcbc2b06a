"""Every corpus query with workers that cannot import the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

RUN = """
import sys
sys.path.insert(0, ROOT)  # of the driver only
from ledgerline.session import build_session
spark = build_session("local[4]", 4)

def found(_):
    import importlib.util
    yield importlib.util.find_spec("ledgerline") is not None

assert spark.sparkContext.parallelize([0], 1).mapPartitions(found).collect() == [False]
import corpus_pipeline
from ledgerline.llm.catalog import QUERIES
for name, query in {**QUERIES, "pipeline": corpus_pipeline.run}.items():
    try:
        query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    except Exception as e:
        print("FAILED", name, str(e)[-600:])
print("done")
spark.stop()
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = RUN.replace("ROOT", repr(ROOT))
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert "FAILED" not in out.stdout and out.stdout.strip().endswith("done"), out.stdout + out.stderr[-2000:]
