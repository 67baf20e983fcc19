"""Catalogue reading, filters, raw lines, statistics edge cases."""

import pytest
from pyspark.sql import functions as F

from repforge.operators import aggregates as agg
from repforge.operators.filters import select_units
from repforge.sources import catalogue as C

CSV = """File_index,Download_Link,Species,Author,BSource,BType,Longitudinal,Age,Disease,Subject,Vaccine,Chain,Isotype,Unique_sequences,Total_sequences,Size_MB
1,http://x/1.csv.gz,human,"Doe et al., 2019",PBMC,,no,30,None,no,None,Heavy,IGHG,100,200,1.5
2,http://x/2.csv.gz,human,"Roe et al., 2020",PBMC,,no,40,None,no,None,Light,,n/a,5,0.25
3,http://x/3.csv.gz,mouse,"Doe et al., 2019",PBMC,,no,no,None,S1,None,Heavy,IGHM,0,0,n/a
4,http://x/4.csv.gz,human,"Zoë et al., 2021",PBMC,,no,50,None,S1,None,Heavy,IGHM,1000,10,2
"""


@pytest.fixture
def cat(spark, tmp_path):
    p = tmp_path / "cat.csv"
    p.write_text(CSV, encoding="utf-8")
    return C.read_catalogue(spark, str(p))


def test_read_and_coerce(cat):
    rows = {r.File_index: r for r in cat.collect()}
    assert rows[1].Author == "Doe et al., 2019"
    assert rows[2].Unique_sequences is None and rows[3].Size_MB is None
    assert rows[4].Author == "Zoë et al., 2021"


def test_filters(cat):
    ids = lambda f: sorted(r.File_index for r in select_units(cat, f).collect())
    assert ids({"Species": ["human"], "Chain": ["Heavy"]}) == [1, 4]
    assert ids({"Species": []}) == []
    assert ids({"Species": None}) == [1, 2, 3, 4]
    assert ids({"Unique_sequences": {"min": 100, "max": 1000}}) == [1, 4]
    with pytest.raises(KeyError):
        select_units(cat, {"Nope": ["x"]})


def test_isotype_stats_and_histogram(cat):
    s = {r.Isotype: r for r in agg.isotype_stats(cat).collect()}
    assert set(s) == {"IGHG", "IGHM"}
    assert s["IGHM"].Total_Unique_Sequences == 1000
    assert abs(s["IGHG"].Percentage_Unique_Sequences - 100 * 100 / 1100) < 1e-6
    h = {r.bin: r.n_subjects for r in agg.subject_size_histogram(cat).collect()}
    # (no, Doe)=100 -> bin 0; (no, Roe)=0 -> outside; (S1, Doe)=0 outside; (S1, Zoe)=1000 -> bin 1
    assert h == {0: 1, 1: 1, 2: 0, 3: 0, 4: 0, 5: 0, 6: 0}
    many = agg.subjects_in_many_publications(cat).collect()
    assert {r.Subject for r in many} == {"no", "S1"}


def test_raw_lines(spark):
    lines = [
        'wget http://x/1.csv.gz, "{""Species"": ""human"", ""Author"": ""Doe et al., 2019"", ""New"": 1}", 12.5 MB',
        'wget http://x/2.csv.gz, "{""Species"": ""human""", 1 MB',
        'wget http://x/3.csv.gz, "{""Species"": ""mouse""}"',
    ]
    df = spark.createDataFrame([(l,) for l in lines], "value string")
    good = C.parse_catalogue_lines(df).collect()
    assert len(good) == 1 and good[0].Author == "Doe et al., 2019" and float(good[0].Size_MB) == 12.5
    bad = {r.reason for r in C.bad_catalogue_lines(df).collect()}
    assert bad == {"malformed json", "invalid line"}


def test_catalogue_binds_by_name(spark, tmp_path):
    import pytest
    names = [f.name for f in C.CATALOGUE_RAW_SCHEMA.fields]
    p = tmp_path / "moved.csv"
    row = {n: "" for n in names} | {"File_index": "7", "Species": "human", "Author": '"Doe et al., 2019"',
                                    "Unique_sequences": "12"}
    order = ["Extra", *reversed(names)]
    p.write_text(",".join(order) + "\n" + ",".join({**row, "Extra": "x"}[n] for n in order) + "\n")
    got = C.read_catalogue(spark, str(p)).collect()[0]
    assert (got.File_index, got.Species, got.Author, got.Unique_sequences) == (7, "human", "Doe et al., 2019", 12)
    p.write_text("File_index,Species\n1,human\n")
    with pytest.raises(ValueError, match="lacks the columns"):
        C.read_catalogue(spark, str(p))


def test_age_histogram_keeps_empty_bins(spark):
    from repforge.operators.aggregates import age_histogram
    df = spark.createDataFrame([("10", "3"), ("30", "4"), ("x", "5")], "Age string, Unique_sequences string")
    got = [(r.bin, r.unique_sequences) for r in age_histogram(df).orderBy("bin").collect()]
    assert got == [(0, 3), *[(i, 0) for i in range(1, 19)], (19, 4)]
    assert age_histogram(df.where("Age = 'x'")).count() == 0

