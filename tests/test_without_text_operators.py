"""The banking part stands alone: a copy without the text operators imports, registers its queries and runs the flagship."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROGRAM = """
import __spark_entry__ as e
from workload.queries import QUERIES
assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) == set(QUERIES), set(e.queries()) ^ set(QUERIES)
from riskflow.session import build_session
spark = build_session("alone", "local[2]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"})
print("rows", e.entry(spark).count())
"""


def copy(tmp_path, *without):
    target = tmp_path / "copy"
    skip = lambda folder, names: [n for n in names if n in (".git", "__pycache__") or os.path.relpath(os.path.join(folder, n), ROOT) in without]
    shutil.copytree(ROOT, target, ignore=skip)
    return target


def python(folder, program):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", program], cwd=folder, env=env, capture_output=True, text=True, timeout=300)


def test_without_folders_and_pipeline(tmp_path):
    folder = copy(tmp_path, "riskflow/llm", "tests/llm", "corpus_pipeline.py")
    done = python(folder, PROGRAM)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split("rows")[1]) > 0


def test_pipeline_left_behind(tmp_path):
    folder = copy(tmp_path, "riskflow/llm", "tests/llm")
    done = python(folder, "import __spark_entry__ as e; assert 'pipeline' not in e.queries() and 'clean_city' in e.queries()")
    assert done.returncode == 0, done.stderr[-2000:]


def test_a_broken_text_operator_is_no_absent_one(tmp_path):
    folder = copy(tmp_path)
    if not os.path.exists(folder / "riskflow" / "llm" / "queries.py"):
        return
    (folder / "riskflow" / "llm" / "frames.py").write_text("import no_such_module\n")
    assert "no_such_module" in python(folder, "import __spark_entry__").stderr
