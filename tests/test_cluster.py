"""Clustering: greedy rounds equal the sequential greedy; verified pairs
equal a brute-force check of every candidate; members lie within the
threshold of their representative."""

import random

from pyspark.sql import functions as F

from repforge.operators import cluster as clu


def best_alignment(c, m, diagonals):
    """Of the member's gapless alignments on these diagonals the verified one
    with most matches: (aligned, matches), or None."""
    found = []
    for d in diagonals:
        columns = [(c[i + d], m[i]) for i in range(len(m)) if 0 <= i + d < len(c)]
        matches = sum(x == y for x, y in columns)
        if len(columns) * 10 >= len(m) * 9 and matches * 10 >= len(columns) * 9:
            found.append((matches, -len(columns)))
    return (-max(found)[1], max(found)[0]) if found else None


def sequential_greedy(nodes, edges):
    """nodes: {id: len}; edges: (src, dst) with src higher priority."""
    prio = sorted(nodes, key=lambda i: (-nodes[i], i))
    inbound = {}
    for s, d in edges:
        inbound.setdefault(d, []).append(s)
    rep = {}
    for v in prio:
        reps = [u for u in inbound.get(v, []) if rep.get(u) == u]
        rep[v] = min(reps, key=lambda u: (-nodes[u], u)) if reps else v
    return rep


def test_greedy_rounds_equal_sequential(spark):
    rng = random.Random(11)
    for case in range(12):
        n = rng.randint(1, 40)
        nodes = {i: rng.randint(5, 9) for i in range(1, n + 1)}
        prio = sorted(nodes, key=lambda i: (-nodes[i], i))
        edges = set()
        for _ in range(rng.randint(0, 3 * n)):
            a, b = rng.sample(range(len(prio)), 2) if n > 1 else (0, 0)
            if a != b:
                hi, lo = prio[min(a, b)], prio[max(a, b)]
                edges.add((hi, lo))
        u = spark.createDataFrame([(i, "x", l) for i, l in nodes.items()],
                                  "rep_id long, sequence string, len int")
        e = spark.createDataFrame(sorted(edges) or [(0, 0)], "centre long, member long")
        if not edges:
            e = e.where("false")
        got = {r.id: r.rep for r in clu.greedy_cover(u, e).collect()}
        assert got == sequential_greedy(nodes, edges), case


def _fixture(spark):
    rng = random.Random(5)
    alphabet = "ACDEFGHIKLMNPQRSTVWY"
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(30, 60))) for _ in range(8)]
    rows, i = [], 1
    for b in base:
        for _ in range(rng.randint(1, 6)):
            s = list(b)
            for _ in range(rng.randint(0, 4)):
                s[rng.randrange(len(s))] = rng.choice(alphabet)
            rows.append((i, "".join(s)))
            i += 1
        rows.append((i, b))   # an exact copy of the base
        i += 1
    rows.append((i, "ACD"))  # shorter than k: its own cluster
    return spark.createDataFrame(rows, "Sequence_ID long, sequence string"), dict(rows)


def test_verified_pairs_equal_brute_force(spark):
    df, _ = _fixture(spark)
    u = clu.exact_duplicates(df)
    cand = clu.kmer_candidates(clu.kmer_sketch(u))
    useq = {r.rep_id: r.sequence for r in u.collect()}
    diagonals = {}
    for r in cand.collect():
        assert (r.c_len, r.m_len) == (len(useq[r.centre]), len(useq[r.member]))
        diagonals.setdefault((r.centre, r.member), set()).add(r.diagonal)
    expect = {}
    for (c, m), ds in diagonals.items():
        best = best_alignment(useq[c], useq[m], ds)
        if best:
            expect[c, m] = best
    got = {(r.centre, r.member): (r.aligned, r.matches) for r in clu.verified_pairs(cand, u).collect()}
    assert got == expect and got


def test_cluster_members_within_threshold(spark):
    df, seqs = _fixture(spark)
    a = {r.Sequence_ID: r.rep_id for r in clu.cluster(df).collect()}
    assert set(a) == set(seqs)
    for sid, rep in a.items():
        assert a[rep] == rep          # every rep is in its own cluster
        s, r = seqs[sid], seqs[rep]
        if s != r:
            assert len(r) >= len(s) and best_alignment(r, s, range(-len(s), len(r)))
    assert len(set(a.values())) < len(seqs)
    short = [k for k, v in seqs.items() if v == "ACD"][0]
    assert a[short] == short
    reps = {r.rep_id for r in clu.representative_ids(clu.cluster(df)).collect()}
    assert reps == set(a.values())


def test_fragment_joins_the_sequence_that_contains_it(spark):
    """Coverage is the target's: a fragment that lies wholly inside a longer
    sequence joins it; a sequence that overlaps it by half does not."""
    rng = random.Random(9)
    whole = "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(60))
    half = whole[30:] + "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(25))
    df = spark.createDataFrame([(1, whole), (2, whole[10:50]), (3, half)], "Sequence_ID long, sequence string")
    assert {r.Sequence_ID: r.rep_id for r in clu.cluster(df, m=50).collect()} == {1: 1, 2: 1, 3: 3}


def test_thresholds_keep_their_digits(spark):
    """187 of 200 equal residues are 0.935: below 0.936, at 0.935 and 0.9345."""
    rng = random.Random(2)
    a = "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(200))
    b = "".join(("A" if c != "A" else "C") if i % 16 == 9 else c for i, c in enumerate(a))
    equal = sum(x == y for x, y in zip(a, b))
    df = spark.createDataFrame([(1, a), (2, b)], "Sequence_ID long, sequence string")
    for similarity, merges in ((equal / 200, True), (equal / 200 - 0.0005, True), (equal / 200 + 0.0005, False)):
        got = {r.Sequence_ID: r.rep_id for r in clu.cluster(df, m=200, similarity=similarity).collect()}
        assert (got[2] == 1) == merges, similarity


def test_priority_key_covers_every_bigint_id(spark):
    rows = [(1, 49, 10 ** 15), (1, 49, 2 ** 62), (1, 12, 3), (2, 17538, 2 ** 63 - 1), (2, 17538, 0)]
    df = spark.createDataFrame(rows, "kmer long, len int, id long")
    g = (df.groupBy("kmer").agg(F.max(clu.priority_key()).alias("p"))
           .select("kmer", clu.centre_of(F.col("p")).alias("c"), clu.length_of(F.col("p")).alias("l")))
    assert sorted(tuple(r) for r in g.collect()) == [(1, 10 ** 15, 49), (2, 0, 17538)]


def test_long_chain_and_rounds_without_progress(spark):
    import pytest
    n = 24  # a chain needs a round for each node
    u = spark.createDataFrame([(i, "x", 100 - i) for i in range(1, n + 1)], "rep_id long, sequence string, len int")
    e = spark.createDataFrame([(i, i + 1) for i in range(1, n)], "centre long, member long")
    got = {r.id: r.rep for r in clu.greedy_cover(u, e).collect()}
    assert got == {i: i if i % 2 else i - 1 for i in range(1, n + 1)}
    circle = spark.createDataFrame([(1, 2), (2, 1)], "centre long, member long")
    with pytest.raises(RuntimeError, match="decided nothing"):
        clu.greedy_cover(u.where("rep_id < 3"), circle)


def test_read_errors_are_not_empty_results(spark, tmp_path):
    import pytest
    from repforge.sources import corpus, sinks
    from repforge.streaming import ingest
    bad = "nofs://host/path"
    for read in (lambda: sinks.cached(spark, bad, lambda: spark.range(1)), lambda: ingest._offset(spark, bad, 1),
                 lambda: corpus.read_tokenized_test(spark, bad)):
        with pytest.raises(Exception, match="nofs"):
            read()
    assert corpus.read_tokenized_test(spark, str(tmp_path / "none")) is None
    assert ingest._offset(spark, str(tmp_path / "none"), 1) == 0
