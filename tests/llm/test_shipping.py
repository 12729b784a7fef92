"""Executors need no copy of the package: the driver alone has it on its path."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from roadlens.llm.queries import QUERIES
from roadlens.session import local_session
spark = local_session("2")
probe = spark.range(1).mapInArrow(lambda batches: (b for b in batches if __import__("importlib.util").util.find_spec("roadlens") is None), "id bigint")
assert probe.count() == 1, "the workers can import the package: this test shows nothing"
for name in ("op1_toxicity", "op2_token_counts", "op3_language_id", "op7_bpe_codec", "op11_whitening", "op12_alignment"):
    print(name, QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_without_the_package(tmp_path):
    script = tmp_path / "driver.py"
    script.write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert said.returncode == 0, said.stderr[-3000:]
    assert [line.split()[0] for line in said.stdout.split("\n") if line.startswith("op")] == ["op1_toxicity", "op2_token_counts", "op3_language_id", "op7_bpe_codec", "op11_whitening", "op12_alignment"]
