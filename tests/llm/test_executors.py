"""All operators where the driver alone has the package."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from hostpulse.session import session
import __spark_entry__

spark = session("alone", **{{
    "spark.master": "local[2]", "spark.driver.memory": "3g", "spark.sql.shuffle.partitions": "2",
    "spark.ui.showConsoleProgress": "false"}})
spark.sparkContext.setLogLevel("ERROR")

def missing(_):
    try:
        import hostpulse
        return [True]
    except ImportError:
        return [False]

assert spark.sparkContext.parallelize([0], 1).mapPartitions(missing).collect() == [False]
found = __spark_entry__.queries()
for name in {names!r}:
    assert found[name](spark, "/root/testdata/sf0.001").toPandas().shape[0] > 0, name
    print("done", name, flush=True)
"""


@pytest.mark.parametrize(
    "names", [["op1_bpe", "op3_toxicity", "op8_packing", "op11_pii"], ["op12_divergence", "op13_centroids", "op9_simhash", "op6_lines", "pipeline"]]
)
def test_workers_without_the_package(tmp_path, names):
    script = tmp_path / "alone.py"
    script.write_text(SCRIPT.format(root=str(ROOT), names=names))
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert ran.stdout.split() == [word for name in names for word in ("done", name)], ran.stdout + ran.stderr[-2000:]
