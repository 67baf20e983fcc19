"""End-to-end chain, streaming ingest and sinks on small gzip units."""

import gzip

import pytest
from pyspark.sql import functions as F

from repforge.plans.curate import CurateConfig, curate
from repforge.sources import sinks
from repforge.sources import units as U
from repforge.streaming.ingest import ingest_stream

ALPHA = "ACDEFGHIKLMNPQRSTVWY"


def _row(i, variant=0):
    import random
    rng = random.Random(i // 3)            # groups of three near copies
    regions = ["".join(rng.choice(ALPHA) for _ in range(n)) for n in (25, 8, 17, 8, 38, 14, 12)]
    if variant:
        r = list(regions[4])
        r[variant % len(r)] = "W"
        regions[4] = "".join(r)
    vals = {c: "" for c in U.UNIT_COLUMNS}
    vals.update(dict(zip(["fwr1_aa", "cdr1_aa", "fwr2_aa", "cdr2_aa", "fwr3_aa", "cdr3_aa",
                          "fwr4_aa"], regions)))
    vals.update({"locus": "H", "v_call": "IGHV1", "Redundancy": "1"})
    return ",".join(vals[c] for c in U.UNIT_COLUMNS)


def _units(d, n_units=4, per_unit=30):
    d.mkdir(parents=True, exist_ok=True)
    k = 0
    for u in range(1, n_units + 1):
        with gzip.open(d / f"{u}.csv.gz", "wt") as f:
            f.write('"{""Run"": ""r""}"\n' + ",".join(U.UNIT_COLUMNS) + "\n")
            for _ in range(per_unit):
                f.write(_row(k, k % 3) + "\n")
                k += 1


def test_curate_end_to_end(spark, tmp_path):
    _units(tmp_path / "u")
    cat = spark.createDataFrame(
        [(u, f"http://x/{u}.csv.gz", "human", "Heavy" if u != 4 else "Light", f"A{u % 2}", "no")
         for u in range(1, 5)],
        "File_index long, Download_Link string, Species string, Chain string, Author string, Subject string")
    paths = spark.createDataFrame([(u, f"file://{tmp_path}/u/{u}.csv.gz") for u in range(1, 5)],
                                  "File_index long, path string")
    cfg = CurateConfig(total_sequences=20, training=12, validation=4)
    out = curate(spark, cat, paths, cfg).collect()
    assert len(out) == 20
    assert {r.split for r in out} == {"train", "val", "test"}
    assert sum(r.split == "train" for r in out) == 12
    assert all(len(r.input_ids) == 150 for r in out)


def test_streaming_ingest_matches_batch(spark, tmp_path):
    _units(tmp_path / "s", n_units=3, per_unit=10)
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    q = ingest_stream(spark, str(tmp_path / "s"), sink, ck, ["fwr1_aa"], max_files_per_trigger=1)
    q.awaitTermination(300)
    got = spark.read.parquet(sink)
    ids = sorted(r.Sequence_ID for r in got.collect())
    assert ids == list(range(1, 31))
    batch = U.ingest(U.parse_units(U.number_lines(U.read_unit_lines(spark, str(tmp_path / "s")))),
                     ["fwr1_aa"])
    assert sorted((r.File_ID, r.fwr1_aa) for r in got.collect()) == \
        sorted((r.File_ID, r.fwr1_aa) for r in batch.collect())


def test_sinks_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "Sequence_ID long, x string")
    sinks.write_sequences(df, str(tmp_path / "p"))
    sinks.write_sequences(df, str(tmp_path / "c"), fmt="csv")
    sinks.write_report_csv(df, str(tmp_path / "r"))
    sinks.write_metrics(df, str(tmp_path / "j"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    calls = []
    t = sinks.cached(spark, str(tmp_path / "cache"), lambda: calls.append(1) or df)
    t2 = sinks.cached(spark, str(tmp_path / "cache"), lambda: calls.append(1) or df)
    assert t.count() == t2.count() == 2 and calls == [1]
