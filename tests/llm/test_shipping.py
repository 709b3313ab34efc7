"""The workers find the package wherever the driver was started."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent.parent

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as contract
from flatloom.session import local_session
spark = local_session(2, **{"spark.checkpoint.dir": sys.argv[3]})
print("rows", contract.queries()["op1_quality_rules"](spark, sys.argv[2]).count())
"""


def test_from_another_folder(sf_dir, documents, tmp_path):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    command = [sys.executable, "-c", SCRIPT, str(ROOT), sf_dir, str(tmp_path / "scratch")]
    done = subprocess.run(command, cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert f"rows {len(documents)}" in done.stdout, done.stderr[-2000:]
