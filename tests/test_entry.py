import os
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_and_sql_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_works_without_the_subpackage(tmp_path):
    for name in ("mergeweave", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", f"{ROOT}/{name}", str(tmp_path)], check=True)
    subprocess.run(["rm", "-rf", str(tmp_path / "mergeweave/llm")], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 's2_pr_rows' in q and not any(k.startswith('op') for k in q) and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
