"""The corpus pipeline: its stages on their own inputs, and the entry module's guard."""

import os
import shutil
import subprocess
import sys

import corpus_pipeline
from corpora import corpus, edges, empty, frame, linked
from paylens.llm import ngram_join
from paylens.llm.common import saved

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_on_a_corpus(spark):
    docs = frame(spark, corpus(77, 40, (20, 120)))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = saved(stage(spark, docs, None), name)
        assert docs.columns == columns
        if name == "ngram_jaccard_join":
            rows = sorted((r["doc_id"], r["text"]) for r in before.collect())
            component, _ = linked([t for _, t in rows])
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted({rows[c][0] for c in component})
            assert ngram_join.jaccard_components(docs).filter("component_id != doc_id").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, None).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.collect()}


def test_stages_on_edge_cases(spark):
    for docs in (edges(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = saved(stage(spark, docs, None), name)
            assert name == "best_fit_packing" or docs.columns == columns


def test_entry_works_without_the_subpackage(tmp_path):
    for name in ("paylens", "__spark_entry__.py"):
        source = os.path.join(REPO, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"],
                          cwd=tmp_path, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True)
    assert said.returncode == 0 and said.stdout.split()[-1] == "False", said.stderr
