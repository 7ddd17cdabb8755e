"""The entry without its optional part."""
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(q.startswith('op') or q == 'pipeline' for q in e.queries()))"


@pytest.mark.parametrize("gone", [("postlens/llm",), ("postlens/llm", "corpus_pipeline.py")])
def test_entry_without_the_corpus_folders(tmp_path, gone):
    copy = tmp_path / "copy"
    copy.mkdir()
    for part in ("postlens", "workload", "__spark_entry__.py", "corpus_pipeline.py"):
        if part in gone or not (ROOT / part).exists():
            continue
        if (ROOT / part).is_dir():
            shutil.copytree(ROOT / part, copy / part, ignore=lambda folder, names: [
                n for n in names if f"{Path(folder).relative_to(ROOT)}/{n}" in gone or n == "__pycache__"])
        else:
            shutil.copy(ROOT / part, copy)
    done = subprocess.run([sys.executable, "-c", COUNT], cwd=copy, capture_output=True, text=True, check=True, timeout=120)
    queries, oracles, corpus = done.stdout.split()
    assert int(queries) >= 84 and int(oracles) >= 84 and corpus == "False"
