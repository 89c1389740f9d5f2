"""Workers that cannot import this repository run every operator all the same."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from tabwright.session import build_session

spark = build_session(
    "workers", "local[4]", spark__sql__shuffle__partitions="2", spark__ui__enabled="false",
    spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
)
spark.sparkContext.setLogLevel("ERROR")


def importable(batches):
    import importlib.util
    import pyarrow as pa

    for batch in batches:
        found = importlib.util.find_spec("tabwright") is not None
        yield pa.RecordBatch.from_pydict({{"found": [found]}})


assert not spark.range(1).mapInArrow(importable, "found boolean").first()[0]
queries = entry.queries()
for name in sorted(queries):
    if name.startswith("op") or name in ("pipeline", "forest_bagged", "correlation_wide", "ingest_bytes"):
        queries[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
        print("ran", name, flush=True)
"""


def test_workers_need_no_package(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=ROOT))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env["PYTHONPATH"] = os.pathsep.join(
        p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and os.path.realpath(p) != ROOT
    )
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900
    )
    assert done.returncode == 0, done.stderr[-3000:]
    ran = [x.split()[1] for x in done.stdout.splitlines() if x.startswith("ran ")]
    assert len([n for n in ran if n.startswith("op")]) == 13 and "pipeline" in ran
