"""The entry file as the driver uses it: with all folders, and with those of the training-data operators gone."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

from tallylake.checks import QUERIES

ROOT = Path(__file__).resolve().parents[1]
LIST = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), 'pipeline' in q)"


def listed(folder: Path) -> list[str]:
    env = {**os.environ, "PYTHONPATH": "", "PYTHONDONTWRITEBYTECODE": "1"}
    return subprocess.run([sys.executable, "-c", LIST], cwd=folder, env=env, capture_output=True, text=True, check=True).stdout.split()


def test_the_entry_file_without_the_training_data_folders(tmp_path):
    gone = [ROOT / "tallylake/llm", ROOT / "tests/llm"]

    def skipped(folder, names):
        return [n for n in names if n in {".git", "__pycache__"} or Path(folder, n) in gone]

    for with_pipeline in (True, False):
        copy = tmp_path / str(with_pipeline)
        shutil.copytree(ROOT, copy, ignore=skipped)
        if not with_pipeline:
            (copy / "corpus_pipeline.py").unlink(missing_ok=True)
        assert listed(copy) == [str(len(QUERIES)), "False"]


def test_every_module_outside_leaves_that_folder_alone():
    files = [p for p in (ROOT / "tallylake").rglob("*.py") if "llm" not in p.parts] + [p for p in (ROOT / "tests").glob("*.py") if p != Path(__file__)]
    assert files and not [p for p in files if "tallylake.llm" in p.read_text()]
