import math

from repforge.operators import assess


def test_loss_mean_of_rank_means(spark):
    rows = [("m", "t", 0, 1, 1.0), ("m", "t", 0, 2, 3.0), ("m", "t", 1, 3, 10.0),
            ("m", "t", 1, 4, float("nan")), ("m", "t", 1, 5, None)]
    df = spark.createDataFrame(rows, "model string, test_set string, rank int, batch long, loss double")
    r = assess.loss_by_test_set(df).first()
    assert r.eval_loss == 6.0 and r.n_batches == 3
    assert math.isclose(r.perplexity, math.exp(6.0), rel_tol=1e-9)
    w = assess.loss_by_test_set(df, weighted=True).first()
    assert math.isclose(w.eval_loss, 14 / 3, rel_tol=1e-6)


def test_infinite_loss_dominates(spark):
    inf = float("inf")
    rows = [("m", "a", 0, 0, inf), ("m", "a", 0, 1, 1.0), ("m", "a", 1, 0, 2.0), ("m", "b", 0, 0, 1.0),
            ("m", "b", 0, 1, float("nan")), ("m", "b", 0, 2, None)]
    df = spark.createDataFrame(rows, "model string, test_set string, rank int, batch int, loss double")
    from repforge.operators.assess import loss_by_test_set
    for weighted in (False, True):
        got = {r.test_set: (r.eval_loss, r.n_batches) for r in loss_by_test_set(df, weighted).collect()}
        assert got == {"a": (inf, 3), "b": (1.0, 1)}

