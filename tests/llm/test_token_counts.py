"""op13 against the library on whole texts."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from repforge.llm import token_counts
from repforge.llm.queries import op13_token_counts
from tests.llm.conftest import frame, odd_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["don't we'll I'm you've it's they'd we're 'tis ''s 's", "a  b   c\n\n\nd \n e\t\tf ", "x<|endoftext|>y <|endoftext|>",
       "<|endoftext|>", " lead", "trail ", "  ", "\n", "1234 5a6 ½² ٣٤", "naïve café Ελληνικά русский 漢字かな 한국어",
       "emoji 😀👩‍👩‍👧 fl ag", "\x1c\x1d\x85\xa0​ 　|", "ᲀꟂ ՠ", "a" * 500 + " " * 300 + "!" * 400]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("frequent", [None, {}])
def test_counts_as_the_library(spark, library, frequent):
    rows = odd_rows() + [(100 + i, t) for i, t in enumerate(ODD)]
    got = token_counts.counted(frame(spark, rows), PATH, limit=200, frequent=frequent).collect()
    want = sorted((str(d), len((t or "").encode()), library(t or ""), library(t or "") > 200) for d, t in rows)
    assert sorted((str(r["doc_id"]), *tuple(r)[1:]) for r in got) == want


def test_empty_table(spark, nothing):
    assert token_counts.counted(nothing, PATH).count() == 0


def test_small_caches_and_runs_do_not_change_counts(library, monkeypatch):
    texts = ODD + [t or "" for _, t in odd_rows()]
    want = [library(t) for t in texts]
    counter = token_counts.TokenCounter(PATH, limit=7)
    counter.use({" the": 1, "alpha": library("alpha")})
    assert counter.counts(texts) == want and len(counter.known) <= 9
    monkeypatch.setattr(token_counts, "HELD_CHARS", 50)
    monkeypatch.setattr(token_counts, "RUN", 3)
    assert counter.counts(texts) == want


def test_pattern_splits_as_the_library_on_every_sure_character():
    counter = token_counts.TokenCounter(PATH)
    sure = [chr(p) for p in range(1, 0x10000) if not 0xD800 <= p < 0xE000 and counter.plain(chr(p))]
    assert len(sure) > 50_000
    for low in range(0, len(sure), 500):
        text = "".join(f"a{c}1{c}.{c} {c}{c}\n" for c in sure[low: low + 500])
        cuts = counter.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        assert [text[a:b] for _, (a, b) in cuts] == counter.pattern.findall(text)


def test_query(spark, sf_small, library):
    import pyarrow.parquet as pq

    rows = pq.read_table(f"{sf_small}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = sorted((r["doc_id"], len((r["text"] or "").encode()), library(r["text"] or "")) for r in rows)
    got = op13_token_counts(spark, sf_small).collect()
    assert sorted(tuple(r)[:3] for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)
