"""Every training-data query in a process outside the repository, with the package on the driver's path only."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

CODE = """
import sys
sys.path.insert(0, sys.argv[1])
from tillflow.session import build_session
spark = build_session(master="local[4]", shuffle_partitions=4)
import __spark_entry__ as entry

def seen(batches):
    import importlib.util
    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_pydict({"n": [int(importlib.util.find_spec("tillflow") is not None)]})

assert spark.range(1).mapInArrow(seen, "n long").first()[0] == 0, "workers see the package"
for name, job in entry.queries().items():
    if name.startswith("op") or name == "pipeline":
        print(name, len(job(spark, "/root/testdata/sf0.001").collect()), flush=True)
"""


def test_all_queries_without_the_package_on_workers(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", CODE, ROOT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    done = {x.split()[0] for x in run.stdout.splitlines() if x.startswith(("op", "pipeline"))}
    assert run.returncode == 0, run.stderr[-3000:]
    assert len(done) == 14 and "pipeline" in done
