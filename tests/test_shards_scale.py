"""Token shards: texts are dealt out, not token arrays."""

from pyspark.sql import functions as F

from repforge.sources import corpus


def test_shards_are_dealt_out_before_they_are_tokenised(spark, tmp_path):
    rows = spark.createDataFrame([(i, "ACDK" * (i % 9), "test" if i % 3 else "train", i // 10) for i in range(60)],
                                 "Sequence_ID long, text string, split string, shard int")
    tokens = corpus.tokenize_corpus(corpus.deal_shards(rows, 60), keep=["Sequence_ID", "split", "shard"])
    path = str(tmp_path / "dealt")
    corpus.write_token_shards(tokens, path, dealt=True)
    files = spark.read.parquet(path).select("split", "shard", F.input_file_name().alias("file")).distinct()
    assert files.count() == files.select("split", "shard").distinct().count() > 6
    plain = str(tmp_path / "plain")
    corpus.write_token_shards(corpus.tokenize_corpus(rows, keep=["Sequence_ID", "split", "shard"]), plain)
    read = lambda p: sorted(map(repr, spark.read.parquet(p).collect()))
    assert read(path) == read(plain)


def test_a_task_gets_few_rows_whatever_the_size_of_the_texts(spark, monkeypatch):
    monkeypatch.setattr(corpus, "DEALT_ROWS", 10)
    rows = spark.range(600).selectExpr("id AS Sequence_ID", "'AC' AS text", "'test' AS split", "int(id div 5) AS shard")
    dealt = corpus.deal_shards(rows, 600)
    assert dealt.rdd.getNumPartitions() == 60
    sizes = [len(p) for p in dealt.select("shard").rdd.glom().collect()]
    assert sum(sizes) == 600 and max(sizes) < 60


def test_token_arrays_are_not_shuffled(spark, monkeypatch):
    """The query deals out texts: below the tokeniser, not above it."""
    from repforge.plans import queries as q
    plans = []
    write = corpus.write_token_shards
    monkeypatch.setattr(q.corpus, "write_token_shards", lambda df, path, **kw: (
        plans.append((df._jdf.queryExecution().analyzed().toString(), kw)), write(df, path, **kw))[1])
    monkeypatch.setattr(q, "_CORPUS_DIRS", {})
    q._token_files(spark, "/root/testdata/sf0.001")
    plan, options = plans[0]
    assert options == {"dealt": True} and plan.index("MapInArrow") < plan.index("RepartitionByExpression [split")
