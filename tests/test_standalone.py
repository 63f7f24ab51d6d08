"""The library works in a copy that lacks the corpus operators."""

import os
import shutil
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROBE = """
import __spark_entry__ as entry
from lakejobs import registry
from lakejobs.session import build_session

assert set(entry.queries()) == set(registry.queries()), "queries"
assert set(entry.oracle_sql()) == set(registry.oracles()), "oracles"
spark = build_session("probe", "local[2]", spark__ui__enabled="false",
                      spark__sql__shuffle__partitions="2", spark__checkpoint__dir={work!r},
                      spark__sql__warehouse__dir={work!r})
assert entry.entry(spark).count() == 1
print("stands alone")
"""


def test_without_the_corpus_operators(tmp_path):
    copy = tmp_path / "copy"
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", "spark-warehouse")
    shutil.copytree(HERE, copy, ignore=left_out)
    # The pipeline is there still, but needs what is not.
    assert (copy / "corpus_pipeline.py").exists() and not (copy / "lakejobs" / "llm").exists()
    done = subprocess.run(
        [sys.executable, "-c", PROBE.format(work=str(tmp_path / "work"))], cwd=copy,
        capture_output=True, text=True, timeout=300,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert "stands alone" in done.stdout, done.stderr[-3000:]
