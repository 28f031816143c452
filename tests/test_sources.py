"""Sources, sinks and streaming ingest round trips in temp folders."""

import json
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from carewatch.sources import readers as RD
from carewatch.sources import sinks as SK
from carewatch.sources import versions as V
from carewatch.streaming import ingest_pages_stream
from conftest import rows


def tmp():
    return tempfile.mkdtemp(prefix="cw-test-")


def test_csv_roundtrip_blanks_and_encoding(spark):
    d = tmp()
    with open(os.path.join(d, "a.csv"), "w", encoding="cp1252") as f:
        f.write("id,name,amt\n1,Café, \n2,,$5\n")
    df = RD.read_text_table(spark, os.path.join(d, "a.csv"), encoding="windows-1252")
    assert dict(df.dtypes) == {"id": "string", "name": "string", "amt": "string"}
    assert rows(df) == [("1", "Café", None), ("2", None, "$5")]
    out = os.path.join(d, "out")
    SK.write_table(df, out, "csv")
    assert RD.read_text_table(spark, out).count() == 2
    SK.write_scoped(df.withColumn("state", F.lit("HI")), os.path.join(d, "scoped"))
    assert os.path.isdir(os.path.join(d, "scoped", "state=HI"))


def test_preamble_csv(spark):
    d = tmp()
    with open(os.path.join(d, "ccsr.csv"), "w") as f:
        f.write("Disclaimer line\nMore text, with comma\n'ICD-10-CM CODE','DESCRIPTION'\n'A000','Cholera'\n'E1165','Diabetes'\n")
    df = RD.read_csv_with_preamble(spark, os.path.join(d, "ccsr.csv"), "ICD-10-CM CODE")
    assert rows(df, "ICD-10-CM CODE", "DESCRIPTION") == [("'A000'", "'Cholera'"), ("'E1165'", "'Diabetes'")]


def put(d, name, text, encoding="utf-8"):
    import gzip
    data = text.encode(encoding)
    with (gzip.open if name.endswith(".gz") else open)(os.path.join(d, name), "wb") as f:
        f.write(data)


def test_files_of_different_headers(spark):
    """A1: every file is bound by its own header."""
    d = tmp()
    put(d, "2021 a.csv", "a,b\n1,2\n3,\n")
    put(d, "2022.csv", "\ufeffb,a\n20,10\n")
    put(d, "2023.csv.gz", 'a,"c, d"\n100,"x, ""y"""\n')
    put(d, "2024.csv", "a,b\n5,6\n")
    put(d, "empty.csv", "")
    df = RD.read_text_table(spark, d)
    assert df.columns == ["a", "b", "c, d"]
    assert rows(df) == sorted([("1", "2", None), ("3", None, None), ("10", "20", None), ("100", None, 'x, "y"'), ("5", "6", None)], key=repr)
    heads = RD.file_headers(spark, d)
    assert [(h.names, len(h.files)) for h in heads] == [(("a", "b"), 2), (("b", "a"), 1), (("a", "c, d"), 1)]
    one = tmp()
    put(one, "x.csv", "n\u00e4me;b;b;\n\u00e9;2;3;4\n", "cp1252")
    put(one, "y.csv", "b;n\u00e4me\n7;\u00fc\n", "cp1252")
    got = RD.read_text_table(spark, one, sep=";", encoding="windows-1252")
    assert got.columns == ["n\u00e4me", "b1", "b2", "_c3", "b"]
    assert rows(got, "n\u00e4me", "b1", "b") == [("\u00e9", "2", None), ("\u00fc", None, "7")]
    scoped = tmp()
    for st, text in (("HI", "a,b\n1,2\n"), ("CA", "b,a\n4,3\n")):
        os.makedirs(os.path.join(scoped, f"state={st}"))
        put(scoped, f"state={st}/x.csv", text)
    assert rows(RD.read_text_table(spark, scoped), "a", "b", "state") == [("1", "2", "HI"), ("3", "4", "CA")]


def test_preamble_csv_in_splits(spark):
    """A4: a file larger than a split is read by several tasks, each file by its own header."""
    d = tmp()
    put(d, "a.csv", "Note\nk,v in text\n'KEY','v'\n" + "".join(f"'{i}','{i * i}'\n" for i in range(20_000)) + "\n")
    put(d, "b.csv", "'v','KEY','more'\n'x','y','z'\nKEY,again,data\n")
    put(d, "c.csv", "'KEY','v'\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        df = RD.read_csv_with_preamble(spark, d, "KEY")
        assert df.rdd.getNumPartitions() > 4
        got = df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    a = sorted((r["_seq"], r["KEY"], r["v"], r["more"]) for r in got if r["_source_file"].endswith("a.csv"))
    assert [r[1:] for r in a] == [(f"'{i}'", f"'{i * i}'", None) for i in range(20_000)]
    assert len({r[0] for r in a}) == 20_000
    b = sorted((r["_seq"], r["KEY"], r["v"], r["more"]) for r in got if not r["_source_file"].endswith("a.csv"))
    assert [r[1:] for r in b] == [("'y'", "'x'", "'z'"), ("again", "KEY", "data")]
    put(d, "d.csv", "no header here\n")
    try:
        RD.read_csv_with_preamble(spark, d, "KEY")
        raise AssertionError("a file without the marker passed")
    except ValueError as e:
        assert "d.csv" in str(e)


def test_array_rows_by_their_own_header(spark):
    """Two files of different column order, one without a column."""
    d = tmp()
    put(d, "a.json", json.dumps([["x", "y", "zip"], ["1", 2, "96701"], [None, "-3", "96702"]]))
    put(d, "b.json", json.dumps([["zip", "x"], ["96703", 4.5], ["short"]]))
    df = RD.read_array_rows(spark, d)
    assert df.columns == ["x", "y", "zip", "_source_file", "_pos"]
    assert rows(df, "x", "y", "zip", "_pos") == sorted([("1", "2", "96701", 1), (None, "-3", "96702", 2), ("4.5", None, "96703", 1),
                                                        (None, None, "short", 2)], key=repr)
    assert rows(RD.read_array_rows(spark, d, ["zip", "none"]), "zip", "none")[0] == ("96701", None)


def test_pages_wrapped_and_bare(spark):
    d = tmp()
    os.makedirs(os.path.join(d, "w"))
    os.makedirs(os.path.join(d, "b"))
    for off in (0, 2):
        with open(os.path.join(d, "w", f"p{off}.json"), "w") as f:
            json.dump({"count": 3, "results": [{"ccn": f"{off + i}", "v": "x"} for i in range(2 if off == 0 else 1)]}, f)
    with open(os.path.join(d, "b", "p.json"), "w") as f:
        json.dump([{"ccn": "9", "v": "y"}], f)
    sch = T.StructType([T.StructField("ccn", T.StringType()), T.StructField("v", T.StringType())])
    w = RD.read_pages(spark, os.path.join(d, "w"), "results", sch)
    assert rows(w, "ccn", "_declared") == [("0", 3), ("1", 3), ("2", 3)]
    b = RD.read_pages(spark, os.path.join(d, "b"), None, sch)
    assert rows(b, "ccn") == [("9",)]


def test_array_rows(spark):
    d = tmp()
    with open(os.path.join(d, "c.json"), "w") as f:
        json.dump([["B01001_001E", "zip code tabulation area"], ["100", "96701"], ["-666666666", "96702"]], f)
    df = RD.read_array_rows(spark, os.path.join(d, "c.json"))
    assert rows(df, "B01001_001E", "zip code tabulation area") == [("-666666666", "96702"), ("100", "96701")]


def test_streaming_ingest_is_incremental(spark):
    d = tmp()
    land, out, ck = (os.path.join(d, x) for x in ("land", "out", "ck"))
    os.makedirs(land)
    sch = T.StructType([T.StructField("ccn", T.StringType())])
    with open(os.path.join(land, "p0.json"), "w") as f:
        json.dump({"count": 3, "results": [{"ccn": "1"}, {"ccn": "2"}]}, f)
    r1 = ingest_pages_stream(spark, land, out, ck, sch)
    with open(os.path.join(land, "p1.json"), "w") as f:
        json.dump({"count": 3, "results": [{"ccn": "3"}]}, f)
    r2 = ingest_pages_stream(spark, land, out, ck, sch)
    r3 = ingest_pages_stream(spark, land, out, ck, sch)
    assert (r1["pages"], r2["pages"], r3["pages"]) == (1, 1, 0)
    assert rows(spark.read.parquet(out), "ccn") == [("1",), ("2",), ("3",)]


def test_split_sink_refuses_leak(spark):
    d = tmp()
    df = spark.createDataFrame([("e1", "Owner Name", 2)], "eid string, name string, n int")
    SK.write_split(df, os.path.join(d, "r"), lambda x: x.drop("name"), os.path.join(d, "p"), ["name"])
    assert rows(spark.read.parquet(os.path.join(d, "p"))) == [("e1", 2)]
    try:
        SK.write_split(df, os.path.join(d, "r2"), lambda x: x, os.path.join(d, "p2"), ["Name"])
        raise AssertionError("leak not refused")
    except ValueError:
        assert not os.path.exists(os.path.join(d, "p2"))


def test_split_sink_refuses_values(spark):
    """A restricted value inside a public text is found as whole words, in any case and punctuation."""
    held = spark.createDataFrame([("e1", "Anne-Marie O'Neil", "0012345678"), ("e2", "Bo", None), ("e3", "  ", "7"), ("e4", "Zoë Ärm", None)],
                                 "eid string, name string, id string")
    def found(*texts):
        pub = spark.createDataFrame([(t, 1) for t in texts], "note string, n int")
        return rows(SK.leaked_cells(held, pub, ["name", "id"]))
    assert found("run by ANNE MARIE, O NEIL (since 2001)") == [("note", 1, 1)]
    assert found("id:0012345678.", "x 0012345678", "ZOË ärm") == [("note", 3, 2)]
    assert found("Anne Marie Neil", "00123456789", "Bo", "7", "annemarie oneil", "e1", "", None) == []
    pub = spark.createDataFrame([(1,)], "n int")
    assert SK.leaked_cells(held, pub, ["name"]).count() == 0


def test_published_versions(spark):
    d = os.path.join(tmp(), "x")
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    try:
        V.current(spark, d)
        raise AssertionError("nothing is published yet")
    except FileNotFoundError:
        pass
    assert V.publish(a, d) == 1
    assert V.publish(V.current(spark, d).where("k = 1"), d) == 2  # from itself
    for bad in (V.current(spark, d).withColumn("v", F.raise_error(F.lit("x")).cast("string")), a.where("false"), a.select("k"),
                a.withColumn("k", F.col("k").cast("long"))):
        try:
            V.publish(bad, d)
            raise RuntimeError("published")
        except RuntimeError:
            raise
        except Exception:  # noqa: BLE001
            pass
        assert rows(V.current(spark, d)) == [(1, "a")]
    assert rows(V.current(spark, d, seq=1)) == [(1, "a"), (2, "b")]
    assert V.publish(a.select("k"), d, same_fields=False) == 3 and V.current(spark, d).columns == ["k"]
    V.publish(a.limit(0), os.path.join(d, "none"), min_rows=0)
    assert V.current(spark, os.path.join(d, "none")).dtypes == [("k", "int"), ("v", "string")]


def test_replaced_tables(spark):
    name = "cw_replaced"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    SK.replace_table(a, name)
    SK.replace_table(spark.table(name).where("k = 2"), name)  # a table computed from itself
    assert rows(spark.table(name)) == [(2, "b")]
    try:
        SK.replace_table(spark.table(name).withColumn("v", F.raise_error(F.lit("x")).cast("string")), name)
        raise RuntimeError("replaced")
    except RuntimeError:
        raise
    except Exception:  # noqa: BLE001
        assert rows(spark.table(name)) == [(2, "b")]
    SK.replace_table(a.select("k"), name)
    assert rows(spark.table(name)) == [(1,), (2,)]
    spark.sql(f"DROP TABLE {name}")


def test_scope_report(spark):
    df = spark.createDataFrame([("HI", f"f{i}", float(i)) for i in range(8)], "state string, name string, s double")
    rep = SK.scope_report(df, "state", "s", "name", n=2)
    lines = [r["text"] for r in rep.orderBy("line_no").collect()]
    assert lines[0] == "Facilities: 8 (scored 8)" and lines[1].startswith("Quartiles: Q1=1.8")
    assert "Bottom 1: f0 (0.0)" in lines and "Top 1: f7 (7.0)" in lines
