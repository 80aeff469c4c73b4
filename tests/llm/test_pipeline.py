"""The pipeline's stages keep what they should, and the entry point works without the subpackage."""

from __future__ import annotations

import subprocess
import sys
from collections import Counter
from pathlib import Path

import corpus_pipeline
from candlelake.llm import quality, secrets, simhash, toxicity

SF_DIR = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[2]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF_DIR).cache()
        assert kept.columns == docs.columns
        had = {r["doc_id"]: r["text"] for r in before.collect()}
        has = {r["doc_id"]: r["text"] for r in kept.collect()}
        if name == "quality":
            want = {r["doc_id"] for r in quality.classify(before).where("keep").collect()}
        elif name == "toxicity":
            found = toxicity.classify(before, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
            want = {r["doc_id"] for r in found.where("predicted = 0").collect()}
        elif name == "near_duplicates":
            want = {r["component_id"] for r in simhash.near_duplicates(before).collect()}
        else:
            want = set(had)
            assert all(not secrets.Scanner().base(t) for t in has.values())
        assert set(has) == want and (name == "secrets" or all(has[i] == had[i] for i in has))
    rows = corpus_pipeline.packed(spark, kept, SF_DIR).collect()
    words = Counter()
    for r in rows:
        words[r["doc_id"]] += r["n_words"]
    assert dict(words) == {r["doc_id"]: len(r["text"].encode().split()) for r in kept.collect() if r["text"].split()}
    assert corpus_pipeline.run(spark, SF_DIR).count() == len(rows)


def test_entry_without_the_subpackage():
    code = ("import sys; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e; assert not any(n.startswith('op') for n in e.queries()); print(len(e.oracle_sql()))")
    hidden = code.replace("sys.modules['corpus_pipeline'] = None", (
        "import importlib.abc\n"
        "class Hide(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline': raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Hide())"))
    done = subprocess.run([sys.executable, "-c", hidden], cwd=REPO, capture_output=True, text=True, timeout=100)
    assert done.returncode == 0 and int(done.stdout) > 50, done.stderr
