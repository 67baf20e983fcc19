"""Scalar functions against plain-Python definitions."""

import ast

from pyspark.sql import functions as F

from repforge.functions.coerce import sanitize_filename, sanitize_word
from repforge.functions.numbering import numbering_positions, parse_numbering
from repforge.functions.tokens import tokenize
from repforge.operators.masking import mlm_mask


def py_positions(text):
    try:
        d = ast.literal_eval(text.strip())
    except (SyntaxError, ValueError, AttributeError):
        return None
    keys = []
    for region in d.values():
        for k in region:
            digits = "".join(ch for ch in k.strip() if ch.isdigit())
            if digits:
                keys.append(int(digits))
    return sorted(keys)


def test_numbering_matches_literal_eval(spark):
    texts = ["{'fwh1': {'1 ': 'Q', '10A': 'X'}, 'cdrh1': {'27 ': 'G', '111B': 'A'}}",
             "{'a': {'5 ': 'Q', '5A': 'X', 'B': 'Y'}}",
             "{'a': {'1 ': 'Q'",
             "not a dict"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    out = df.select(numbering_positions(parse_numbering(F.col("t"))).alias("p")).collect()
    assert [r.p for r in out[:4]] == [py_positions(t) for t in texts]
    assert out[4].p is None


def _tok(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return df.select(tokenize(F.col("t")).alias("x")).collect()


def test_tokenize_edges(spark):
    rows = _tok(spark, ["ACXA", "", "acA", "A" * 148, "A" * 149])
    ids = [r.x.input_ids for r in rows]
    assert all(len(i) == 150 for i in ids)
    assert ids[0][:7] == [0, 5, 6, 3, 5, 2, 1]
    assert ids[1][:3] == [0, 2, 1]
    assert ids[2][:5] == [0, 3, 3, 5, 2]
    assert ids[3][-1] == 2 and ids[4][-1] == 2 and ids[4][-2] == 5
    assert rows[0].x.attention_mask[:7] == [1, 1, 1, 1, 1, 1, 0]
    assert rows[0].x.special_tokens_mask[:7] == [1, 0, 0, 0, 0, 1, 1]


def test_mlm_mask_deterministic_and_not_special(spark):
    t = tokenize(F.lit("ACDEFGHIKLMNPQRSTVWY" * 5))
    df = spark.range(200).select(F.col("id").alias("Sequence_ID"),
                                 t["input_ids"].alias("input_ids"),
                                 t["special_tokens_mask"].alias("special_tokens_mask"),
                                 t["input_ids"].alias("orig"))
    m = mlm_mask(df)
    a = sorted(m.collect())
    b = sorted(mlm_mask(df.repartition(3)).collect())
    assert a == b
    selected = total = 0
    for r in a:
        for x, lab, sp, orig in zip(r.input_ids, r.labels, r.special_tokens_mask, r.orig):
            if sp:
                assert lab == -100 and x == orig
            else:
                total += 1
                if lab != -100:
                    selected += 1
                    assert lab == orig
    assert 0.12 < selected / total < 0.18


def test_sanitize_unicode(spark):
    df = spark.createDataFrame([("Müller et al., 2020",)], "a string")
    r = df.select(sanitize_word(F.col("a")).alias("w"), sanitize_filename(F.col("a")).alias("f")).first()
    assert r.w == "Müller_et_al_2020"
    assert r.f == "Müller_et_al_2020"


def test_arrow_tokenizer_equals_expression(spark):
    from repforge.operators.encoding import tokenize_batches
    texts = ["ACXA", "", None, "acA", "A" * 148, "A" * 149, "WYÄß€", "KLM" * 70]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3)
    expr = {r.i: tuple(map(tuple, r.x)) for r in
            df.select("i", tokenize(F.col("t")).alias("x")).collect()}
    arrow = {r.i: (tuple(r.input_ids), tuple(r.attention_mask), tuple(r.special_tokens_mask))
             for r in tokenize_batches(df, "t", keep=["i"]).collect()}
    assert arrow == expr
