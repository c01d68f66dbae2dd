"""The entry imports from any folder and without files beside the Spark installation."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_jar_files(tmp_path):
    code = """
import glob, zipfile, sys
glob.glob = lambda *a, **k: []
def closed(*a, **k): raise FileNotFoundError(a)
zipfile.ZipFile = closed
sys.path.insert(0, {root!r})
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
assert set(o) <= set(q) and len(o) > 60
""".format(root=ROOT)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]


def test_task_functions_travel_by_value():
    from pyspark import cloudpickle
    from termspark.operators import lexicon
    body = cloudpickle.dumps(lexicon.chunk_summary)
    code = "import sys, pickle; sys.path = [p for p in sys.path if 'repo' not in p]; f = pickle.loads(sys.stdin.buffer.read()); print(f.__name__)"
    done = subprocess.run([sys.executable, "-c", code], input=body, cwd="/", capture_output=True, timeout=120)
    assert done.stdout.strip() == b"chunk_summary", done.stderr[-2000:]
