from __future__ import annotations

from marmita.llm.line_dedup import remove_boilerplate

DDL = "doc_id LONG, text STRING, source STRING, n_lines STRING, __x INT"


def test_removes_lines_of_many_sites(spark):
    rows = [(i, f"own {i}\n  shared line \nfew\n\nend {i}", f"s{i % 7}", "n", 1) for i in range(40)]
    rows = [(i, t if i % 7 < 5 else t.replace("few", "other"), s, n, x) for i, t, s, n, x in rows]
    rows += [(100, None, "s1", "n", 1), (101, "", None, "n", 1), (102, "shared line", None, "n", 1),
             (None, "shared line\nx", "s1", "n", 1), (3, "again\nshared line", "s1", "n", 1)]
    rows += [(200 + i, "alone at home\n" * 3, "s0", "n", 1) for i in range(30)]
    got = {(r.doc_id, r.text, r.n_lines, r.n_removed) for r in
           remove_boilerplate(spark.createDataFrame(rows, DDL), min_sites=6).collect()}
    for i in range(40):
        word = "few" if i % 7 < 5 else "other"
        assert (i, f"own {i}\n{word}\n\nend {i}", 4, 1) in got
    assert {(100, None, 0, 0), (101, "", 0, 0), (102, "", 1, 1), (None, "x", 2, 1), (3, "again", 2, 1)} <= got
    assert (200, "alone at home\n" * 3, 3, 0) in got
    assert len(got) == 40 + 5 + 30


def test_threshold_is_exact_beyond_the_sketches(spark):
    rows = [(i, f"at {k}\nunder {k}" if i < 99 else f"at {k}", f"site {i}", "n", 1)
            for k in range(5) for i in range(100)]
    out = remove_boilerplate(spark.createDataFrame(rows, DDL), min_sites=100).collect()
    assert {r.text.split()[0] if r.text else "" for r in out} == {"under", ""}


def test_empty(spark):
    out = remove_boilerplate(spark.createDataFrame([], DDL))
    assert out.collect() == [] and out.columns == ["doc_id", "text", "source", "__x", "n_lines", "n_removed"]


def test_columns_of_any_name_stay(spark):
    """Also names that the operator uses itself, and a very long text."""
    ddl = "doc_id LONG, text STRING, source STRING, __id INT, __keys STRING, __kept STRING, line_key STRING, own_0 INT, hit_id INT, hit_keys STRING, sites INT, `a.b` INT"
    rows = [(i, f"own {i}\nshared", f"s{i}", 1, "k", "t", "l", 2, 3, "h", 4, 5) for i in range(8)]
    rows += [(99, "word " * 200_000 + "\nshared\n" + "line\n" * 50_000, "s1", 1, "k", "t", "l", 2, 3, "h", 4, 5)]
    out = remove_boilerplate(spark.createDataFrame(rows, ddl))
    assert out.columns == [p.split(" ")[0].strip("`") for p in ddl.split(", ")] + ["n_lines", "n_removed"]
    got = {r.doc_id: r for r in out.collect()}
    assert all(tuple(r)[3:12] == (1, "k", "t", "l", 2, 3, "h", 4, 5) for r in got.values())
    assert got[3].text == "own 3" and got[99].text == "word " * 200_000 + "\n" + "line\n" * 50_000
    assert (got[99].n_lines, got[99].n_removed) == (50_002, 1)
