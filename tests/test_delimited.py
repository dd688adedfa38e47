"""Delimited files: charsets, quoted newlines at any split size, rejects."""

import csv
import io
import os
import random

import pytest

from staffwise.sources import files as S
from staffwise.sources.delimited import load_delimited, scan


def put(folder, name, data, encoding="utf-8"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode(encoding))
    return os.path.join(folder, "*")


def split_size(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)


@pytest.fixture
def sizes(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: split_size(spark, size)
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_scan_follows_quotes():
    assert scan(b'1,"x', False) == (True, 1)
    assert scan(b'y",2', True) == (False, 1)
    assert scan(b'a "b,c" d,"e""f,",g', False) == (False, 3)  # a quote inside a bare cell is a letter
    assert scan(b'""', False) == (False, 0) and scan(b'"""', False) == (True, 0)
    assert scan(b'x;";";y', False, b";") == (False, 2)


def test_any_split_size_gives_what_one_task_gives(spark, tmp_dir, sizes):
    rng = random.Random(3)
    cell = lambda: rng.choice(["", "x", "né", "a,b", 'say "hi"', "two\nlines", "three\n\n\"q\",\nlines", "end\n", "x" * 40, '5" pipe'])
    want = {}
    for k in range(3):
        rows = [[str(i), cell(), cell()] for i in range(rng.randint(6, 14))]
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator="\n").writerows([["id", "a", "b"], *rows])
        put(tmp_dir, f"f{k}.csv", out.getvalue())
        want[f"f{k}.csv"] = [[c or None for c in r] for r in rows]
    for size in ("1g", "150b", "41b"):
        sizes(size)
        load = load_delimited(spark, tmp_dir + "/*.csv")
        got = load.rows.orderBy("_file", "_row").collect()
        for f, rows in want.items():
            assert [[r["id"], r["a"], r["b"]] for r in got if r["_file"] == f] == rows, size
        assert load.rejects.count() == 0
        lines = {r["file"]: r["n"] for r in load.counts.groupBy("file").agg({"lines": "sum"}).withColumnRenamed("sum(lines)", "n").collect()}
        assert lines == {f: open(os.path.join(tmp_dir, f), newline="").read().count("\n") for f in want}


def test_charsets_in_one_load(spark, tmp_dir, sizes):
    text = 'név,city\nJosé,"Köln\nSüd"\nZoë,Ōsaka\n'
    put(tmp_dir, "a.csv", text)
    put(tmp_dir, "b.csv", text, "utf-8-sig")
    put(tmp_dir, "c.csv", text, "utf-16")
    put(tmp_dir, "d.csv", text, "utf-16-le")
    put(tmp_dir, "e.csv", text.replace("Ō", "O"), "latin-1")
    put(tmp_dir, "f.csv", text.replace("\n", "\r\n"))
    for size in ("1g", "33b"):
        sizes(size)
        load = load_delimited(spark, tmp_dir + "/*.csv", fallback="latin-1", normalise=False)
        assert load.columns == ["név", "city"]
        got = {}
        for r in load.rows.orderBy("_file", "_row").collect():
            got.setdefault(r["_file"], []).append((r["név"], r["city"]))
        plain = [("José", "Köln\nSüd"), ("Zoë", "Ōsaka")]
        assert got == {"a.csv": plain, "b.csv": plain, "c.csv": plain, "d.csv": plain, "e.csv": [plain[0], ("Zoë", "Osaka")],
                       "f.csv": [("José", "Köln\r\nSüd"), plain[1]]}
        assert load.rejects.count() == 0
        assert {r["file"]: r["charset"] for r in load.files.collect()} == {
            "a.csv": "utf-8", "b.csv": "utf-8", "c.csv": "utf-16", "d.csv": "utf-16", "e.csv": "fallback", "f.csv": "utf-8"}


def test_rejects_are_kept_apart(spark, tmp_dir, sizes):
    put(tmp_dir, "a.csv", "id,x\n1,a\n2,b,c\n\n3\n4,\"o\nk\"\n5,d,\n6,\"never\nclosed,1\n7,e\n")
    put(tmp_dir, "b.csv", b"id,x\n1,\x81\n2,\x80\n")
    put(tmp_dir, "c.csv", 'id,"x\n')
    put(tmp_dir, "d.csv", "")
    put(tmp_dir, "e.csv", "x,id,more\nq,9,m\n")
    for size in ("1g", "25b"):
        sizes(size)
        load = load_delimited(spark, tmp_dir + "/*.csv")
        assert load.columns == ["id", "x", "more"]
        rows = [(r["_file"], r["id"], r["x"], r["more"]) for r in load.rows.orderBy("_file", "_row").collect()]
        assert rows == [("a.csv", "1", "a", None), ("a.csv", "3", None, None), ("a.csv", "4", "o\nk", None), ("b.csv", "2", "€", None), ("e.csv", "9", "q", "m")]
        bad = [(r["file"], r["row"], r["reason"]) for r in load.rejects.orderBy("file", "row").collect()]
        assert [b for b in bad if b[2] != "quote never closed"] == [
            ("a.csv", 3, "too many cells"), ("a.csv", 8, "too many cells"), ("b.csv", 2, "undecodable bytes"),
            ("c.csv", None, "no header record"), ("d.csv", None, "no header record")]
        open_ = load.rejects.filter("reason = 'quote never closed'").orderBy("row").collect()
        assert "\n".join(r["raw"] for r in open_) == '6,"never\nclosed,1\n7,e' and open_[0]["row"] == 9
        lines = {(r["file"], r["status"]): r["lines"] for r in load.counts.collect()}
        assert lines[("a.csv", "row")] == 4 and lines[("a.csv", "blank")] == 1 and lines[("a.csv", "header")] == 1
        assert sum(n for (f, _), n in lines.items() if f == "a.csv") == 11
    with pytest.raises(ValueError, match="c.csv"):
        S.read_delimited(spark, tmp_dir + "/*.csv")
    only = S.read_delimited(spark, tmp_dir + "/a.csv")
    assert only.count() == 3
    with pytest.raises(ValueError, match="a.csv, line"):
        S.read_delimited(spark, tmp_dir + "/a.csv", rejects="error")


def test_header_over_lines_after_a_title(spark, tmp_dir):
    put(tmp_dir, "t.csv", 'Report, of "May"\n"First\nname",Age\nAnn,3\n')
    got = load_delimited(spark, tmp_dir + "/*.csv", title_line=True)
    assert [tuple(r)[:2] for r in got.rows.collect()] == [("Ann", "3")] and got.rejects.count() == 0
