"""The pipeline's stages against brute force, and the driver's guard."""

import os
import shutil
import subprocess
import sys
from collections import Counter

import pytest

import corpus_pipeline
from repforge.llm import queries
from repforge.llm.common import table
from tests.llm.conftest import frame, odd_rows
from tests.llm.test_operators import brute_components, rows_of

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_keep_columns_and_rows(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_small)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count(), name


def test_exact_stage(spark, odd):
    got = Counter(rows_of(corpus_pipeline.keep_owners(spark, odd, "")))
    best = {}
    for doc, text in odd_rows():
        have = best.get(text or "", (None,))[0]
        if (text or "") not in best or (doc is not None and (have is None or doc > have)):
            best[text or ""] = (doc, text)
    assert Counter((d, t or "") for d, t in got) == Counter((d, t or "") for d, t in best.values())
    assert set(got.values()) == {1}


def test_near_copy_stage(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    want = {d for d, _, c in brute_components(rows_of(docs)) if d == c}
    assert {r.doc_id for r in corpus_pipeline.keep_one_near_copy(spark, docs, sf_small).collect()} == want


def test_near_copies_with_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    other, lone = " ".join(f"v{i}" for i in range(60)), " ".join(f"u{i}" for i in range(60))
    rows = [(1, text), (7, text + " tail"), (7, lone), (4, other), (4, other), (4, other + " end"), (None, text + " x"),
            (None, "p " + lone + " q"), (8, ""), (8, ""), (None, None)]
    got = Counter(rows_of(corpus_pipeline.keep_one_near_copy(spark, frame(spark, rows), "")))
    fours = [r for r in got if r[0] == 4]
    assert len(fours) == 1 and got[fours[0]] == 1
    assert {r: n for r, n in got.items() if r[0] != 4} == Counter([(1, text), (7, lone), (8, ""), (8, ""), (None, None)])


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_and_empty_rows(spark, sf_small, odd, nothing, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, odd, sf_small)
    assert {r.doc_id for r in out.select("doc_id").collect()} <= {d for d, _ in odd_rows()}
    assert stage(spark, nothing, sf_small).count() == 0


def test_run_is_the_stages(spark, sf_small):
    got = corpus_pipeline.run(spark, sf_small)
    assert got.columns[:2] == ["doc_id", "start"] and got.count() > 0


def test_a_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_entry_without_the_operators(tmp_path):
    """The library's other queries work when these two folders and the
    pipeline are gone."""
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; n = e.queries(); assert n and not any(k.startswith('op1') for k in n), n"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-2000:]
