"""Tasks need no package of this repository on their path."""

import os
import subprocess
import sys
from pathlib import Path

SF = "/root/testdata/sf0.001"
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from comarca.session import build_session
spark = build_session("elsewhere", "local[2]", spark__ui__enabled="false", spark__sql__shuffle__partitions="2")
from comarca.llm import entries
for key in ("op4_langid", "op9_toxicity_zstd", "op10_token_spans", "op11_piece_chunks", "op12_qd_whitening"):
    print("rows", key, entries.QUERIES[key](spark, {sf!r}).count())
"""


def test_queries_run_from_another_folder(tmp_path):
    root = str(Path(__file__).resolve().parents[2])
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    found = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=root, sf=SF)], cwd=tmp_path, env=environment,
        capture_output=True, text=True, timeout=300,
    )
    rows = [line.split() for line in found.stdout.splitlines() if line.startswith("rows")]
    assert len(rows) == 5 and all(int(n) > 0 for *_, n in rows), found.stderr[-2000:]
