"""Unit lines of the residue view: the texts are derived once."""


def test_unit_lines_derive_the_view_once(spark, monkeypatch):
    from repforge.sources import units as U
    written = []
    monkeypatch.setattr(U, "materialize", lambda df, name: (written.append(name), df.cache())[1])
    from repforge.plans import queries as q
    lines = U.residue_unit_lines(q.views.residues(spark, "/root/testdata/sf0.001"))
    assert written == ["unit-rows", "unit-ids"] and lines.where("ord = -1").count() > 0
