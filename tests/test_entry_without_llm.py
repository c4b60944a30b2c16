"""The entry module works where the llm subpackage and its pipeline are absent."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_llm(tmp_path):
    shutil.copytree(f"{ROOT}/barspan", tmp_path / "barspan", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert set(q) == set(e.oracle_sql()) and 'resample_week' in q"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)


def test_nothing_else_imports_llm():
    for folder, _, names in os.walk(f"{ROOT}/barspan"):
        if "llm" not in folder.split(os.sep):
            for name in (n for n in names if n.endswith(".py")):
                assert "barspan.llm" not in open(os.path.join(folder, name), encoding="utf-8").read()
