"""Workers need no copy of this package: a driver that has it on its own path alone."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from prefspark.session import local_session
from prefspark.llm import decontaminate, lm_score, minhash_dedup, prefix_trie, sentencepiece, simhash_dedup, spelling, substring_dedup

spark = local_session("workers-path")
docs = spark.createDataFrame([(1, "some words of a text that goes on " * 6), (2, "some words of a text that goes on " * 6 + "x"), (3, None)], "doc_id bigint, text string")
items = docs.where("doc_id = 1").selectExpr("doc_id as item_id", "text")
turns = docs.selectExpr("doc_id as conv_id", "1L as turn", "'user' as role", "text")
out = {{
    "lm": lambda: lm_score.score(docs, lm_score.train(docs)),
    "items": lambda: decontaminate.contaminated(docs, items),
    "pieces": lambda: sentencepiece.decode(sentencepiece.encode(docs, table_units=3, check=True)),
    "simhash": lambda: simhash_dedup.simhash_near_dups(docs),
    "minhash": lambda: minhash_dedup.minhash_near_dups(docs),
    "words": lambda: spelling.variants(spelling.count_words(docs, min_chars=2)),
    "substrings": lambda: substring_dedup.dedup(docs),
    "trie": lambda: prefix_trie.conversation_trie(turns),
}}
for name, f in out.items():
    print(name, f().count())
"""


def test_operators_run_without_the_package_on_the_workers_path(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=str(ROOT))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    counts = dict(line.rsplit(" ", 1) for line in done.stdout.splitlines() if line.count(" ") == 1)
    assert counts["lm"] == counts["simhash"] == counts["minhash"] == counts["pieces"] == counts["substrings"] == "3"
    assert int(counts["words"]) and int(counts["items"])
