"""A worker holds few words and few bytes of texts or sets at once."""

import random
import tracemalloc

import pyarrow as pa
import pytest

import corpus_pipeline
from repforge.llm import ngram_join as n
from repforge.llm import toxicity
from repforge.llm.common import Scratch, table
from tests.llm.conftest import frame


def test_arrow_batches_are_small_while_sets_are_joined(spark, monkeypatch):
    name, seen, map_arrow = "spark.sql.execution.arrow.maxBytesPerBatch", [], n.map_arrow
    before = spark.conf.get(name)
    monkeypatch.setattr(n, "map_arrow", lambda *a: (seen.append(spark.conf.get(name)), map_arrow(*a))[1])
    assert n.joined(frame(spark, [(1, "a b c d e f"), (2, "a b c d e f g")])).count() == 2
    assert set(seen) == {"8m"} and spark.conf.get(name) == before


def test_a_worker_lets_words_go():
    texts = [" ".join(f"w{i}x{k}" for k in range(150_000)) for i in range(3)]
    list(n._sets(iter([pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(texts)], names=["doc_id", "text"])])))
    assert len(n._words().index) <= 250_000


def test_training_texts_are_held_as_numbers_of_words(monkeypatch):
    monkeypatch.setattr(toxicity, "CELLS", 20_000)
    rnd = random.Random(3)
    words = ["".join(rnd.choices("abcdefghij", k=9)) for _ in range(500)]
    texts = [" ".join(rnd.choices(words, k=1000)) for _ in range(300)]
    tracemalloc.start()
    try:
        toxicity.train(texts, [i % 2 for i in range(300)], epochs=0)
        assert tracemalloc.get_traced_memory()[1] < 30 * 300 * 1000  # bytes for each word
    finally:
        tracemalloc.stop()


def test_training_reads_texts_once():
    texts, labels = ["vile words here", "kind words here"] * 20, [1, 0] * 20
    a, b = toxicity.train(iter(texts), labels), toxicity.train(texts, labels)
    assert (a.words == b.words).all() and (a.document == b.document).all() and (a.words > 0).any()


@pytest.mark.parametrize("stage", ["toxicity", "quality"])
def test_arrow_batches_are_small_while_stages_score(spark, sf_small, monkeypatch, stage):
    name, seen, save = "spark.sql.execution.arrow.maxBytesPerBatch", [], Scratch.save
    before = spark.conf.get(name)
    monkeypatch.setattr(Scratch, "save", lambda *a: (seen.append(spark.conf.get(name)), save(*a))[1])
    dict(corpus_pipeline.STAGES)[stage](spark, table(spark, sf_small, "documents"), sf_small)
    assert seen == ["8m"] and spark.conf.get(name) == before
