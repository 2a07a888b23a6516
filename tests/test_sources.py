"""Sources: dirty-line parsing and file round trips in fresh temp folders."""

import os

from pyspark.sql import functions as F

from tabulon.sources import files, text


def _lines(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "value STRING")


def test_id_name_rules(spark):
    got = sorted(map(tuple, text.parse_id_name(_lines(spark, ["12\t Foo Bar ", "x1\tbad", "13", "", "14\ta\tb"])).collect()))
    assert got == [(12, "Foo Bar"), (14, "a\tb")]


def test_alias_rules(spark):
    got = sorted(map(tuple, text.parse_alias(_lines(spark, ["1\t2", "3", "a\t4", "5\tz", "6\t7\t8"])).collect()))
    assert got == [(1, 2), (6, 7)]


def test_trip_lines(spark):
    good = ",".join(["m", "L1", "x", "x", "x", "2013-01-01 10:00:00", "2013-01-01 10:30:00", "x", "x", "x",
                     "-73.9", "40.7", "-73.8", "40.6"])
    bad_pt = good.replace("-73.8", "nope")
    bad_ts = good.replace("2013-01-01 10:00:00", "soon")
    header = "medallion," + ",".join(f"h{i}" for i in range(13))
    lines = _lines(spark, [good, bad_pt, bad_ts, header, good + ",extra", ",".join(good.split(",")[:13]), ""])
    rows = text.parse_trips(lines).collect()
    assert len(rows) == 2
    pts = sorted((r["pickup_lon"], r["dropoff_lon"]) for r in rows)
    assert pts == [(-73.9, -73.8), (0.0, 0.0)]


def test_price_tsv(spark):
    got = text.parse_price_tsv(_lines(spark, ["Oct 24, 2014    81.01", "bad    1", "Jan 02, 2009    x"])).collect()
    assert [(str(r["dt"]), r["value"]) for r in got] == [("2014-10-24", 81.01)]


def test_wordlist_splits_on_whitespace(spark):
    got = sorted(r["word"] for r in text.parse_wordlist(_lines(spark, ["a", "The\tand", "  x  ", ""])).collect())
    assert got == ["a", "and", "the", "x"]


def test_price_csv_dir_rejects_html(spark, tmpdir_fresh):
    with open(os.path.join(tmpdir_fresh, "AAA.csv"), "w") as f:
        f.write("Date,Open\n2014-10-23,10.5\n2014-10-22,10.0\n")
    with open(os.path.join(tmpdir_fresh, "BBB.csv"), "w") as f:
        f.write("<html>not found</html>\n2014-10-23,1.0\n")
    got = sorted((r["series"], str(r["dt"]), r["value"]) for r in files.read_price_csv_dir(spark, tmpdir_fresh).collect())
    assert got == [("AAA", "2014-10-22", 10.0), ("AAA", "2014-10-23", 10.5)]


def test_price_csv_dir_stray_line_and_same_names(spark, tmpdir_fresh):
    """Only a first line of html condemns a file, and only that file."""
    os.makedirs(os.path.join(tmpdir_fresh, "x"))
    with open(os.path.join(tmpdir_fresh, "AAA.csv"), "w") as f:
        f.write("Date,Open\n2014-10-23,10.5\n<html>stray</html>\n2014-10-22,10.0\n")
    with open(os.path.join(tmpdir_fresh, "x", "AAA.csv"), "w") as f:
        f.write("<HTML>\n2014-10-23,7.0\n")
    with open(os.path.join(tmpdir_fresh, "x", "B.v2.csv"), "w") as f:
        f.write("2014-10-23,3.0\n")
    got = sorted((r["series"], str(r["dt"]), r["value"]) for r in files.read_price_csv_dir(spark, tmpdir_fresh).collect())
    assert got == [("AAA", "2014-10-22", 10.0), ("AAA", "2014-10-23", 10.5), ("x/B.v2", "2014-10-23", 3.0)]


def test_geojson_holes_and_parts(spark, tmpdir_fresh):
    import json
    from tabulon.operators.geo import point_in_polygon
    sq = lambda x, y, d: [[x, y], [x + d, y], [x + d, y + d], [x, y + d], [x, y]]
    feats = [("Polygon", [sq(0, 0, 10), sq(2, 2, 3)], "holed"),
             ("MultiPolygon", [[sq(20, 0, 4)], [sq(30, 0, 2), sq(30.5, 0.5, 1)]], "parts"), ("Point", [0, 0], "none")]
    p = os.path.join(tmpdir_fresh, "h.geojson")
    with open(p, "w") as f:
        json.dump({"type": "FeatureCollection", "features": [
            {"type": "Feature", "properties": {"boroughCode": str(i), "borough": n}, "geometry": {"type": t, "coordinates": c}}
            for i, (t, c, n) in enumerate(feats)]}, f)
    g = files.read_geojson(spark, p)
    assert {r["name"]: r["area"] for r in g.collect()} == {"holed": 91.0, "parts": 16.0 + 3.0}
    pts = [(1.0, 1.0, "holed"), (3.0, 3.0, None), (9.0, 9.0, "holed"), (21.0, 1.0, "parts"), (30.2, 0.2, "parts"), (31.0, 1.0, None), (50.0, 50.0, None)]
    df = spark.createDataFrame(pts, "lon DOUBLE, lat DOUBLE, want STRING")
    for cell in (None, 1.0):
        out = point_in_polygon(df, "lon", "lat", g, [-F.col("area")], cell=cell)
        assert all(r["region"] == r["want"] for r in out.collect())


def test_xml_round_trip(spark, tmpdir_fresh):
    df = spark.createDataFrame([(1, "A", 0, "text one"), (2, "B (disambiguation)", 1, "#REDIRECT x")],
                               "doc_id BIGINT, title STRING, ns BIGINT, text STRING")
    out = os.path.join(tmpdir_fresh, "x")
    files.write_xml(df, out, "pages", "page")
    back = files.read_xml(spark, out, "page", "doc_id BIGINT, title STRING, ns BIGINT, text STRING")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_xml_nested_attributes(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "m.xml")
    with open(p, "w") as f:
        f.write("<root><MedlineCitation><MeshHeadingList><MeshHeading><DescriptorName MajorTopicYN=\"Y\">HIV</DescriptorName>"
                "</MeshHeading><MeshHeading><DescriptorName MajorTopicYN=\"N\">Rats</DescriptorName></MeshHeading>"
                "</MeshHeadingList></MedlineCitation><MedlineCitation></MedlineCitation></root>")
    from tabulon.operators.clean import major_topics
    df = files.read_xml(spark, p, "MedlineCitation")
    got = [r[0] for r in df.select(major_topics(F.col("MeshHeadingList.MeshHeading.DescriptorName"))).collect()]
    assert sorted(map(tuple, got)) == [(), ("HIV",)]


def test_geojson_round_trip(spark, tmpdir_fresh):
    from tabulon.plans.fixtures import REGIONS
    p = os.path.join(tmpdir_fresh, "r.geojson")
    files.write_geojson(REGIONS, p)
    g = files.read_geojson(spark, p).orderBy("code", F.desc("area")).collect()
    assert [r["name"] for r in g] == ["west", "west-core", "triangle", "ell"]
    assert [r["area"] for r in g] == [40.0, 4.0, 12.0, 5.0]


def test_csv_sink_round_trip(spark, tmpdir_fresh):
    df = spark.createDataFrame([("a", 1), ("b\tc", 2)], "term STRING, df BIGINT")
    out = os.path.join(tmpdir_fresh, "tsv")
    files.write_delimited(df, out, sep="\t")
    back = spark.read.schema("term STRING, df BIGINT").option("sep", "\t").csv(out)
    assert sorted(map(tuple, back.collect())) == [("a", 1), ("b\tc", 2)]


CITATIONS = """<?xml version="1.0"?><MedlineCitationSet>
<MedlineCitation Status="ok"><PMID Version="1"> 12 </PMID><MeshHeadingList>
 <MeshHeading><DescriptorName MajorTopicYN="Y">Heart &amp; blood</DescriptorName><Other>x</Other></MeshHeading>
 <MeshHeading><DescriptorName MajorTopicYN="N">Lung</DescriptorName></MeshHeading></MeshHeadingList></MedlineCitation>
<MedlineCitation><PMID Version="2">13</PMID><MeshHeadingList><MeshHeading><DescriptorName>Bare</DescriptorName></MeshHeading></MeshHeadingList></MedlineCitation>
<MedlineCitation><PMID Version="x">14</PMID></MedlineCitation>
<MedlineCitation><PMID Version="3">16</PMID></MedlineCitation>
<MedlineCitation><PMID Version="1">15</PMID><MeshHeadingList><MeshHeading></MedlineCitation>
</MedlineCitationSet>"""
CITATION_SCHEMA = ("PMID STRUCT<_VALUE: BIGINT, _Version: INT>, MeshHeadingList STRUCT<MeshHeading: ARRAY<STRUCT<DescriptorName: "
                   "STRUCT<_VALUE: STRING, _MajorTopicYN: STRING>>>>")


def test_nested_xml_with_attributes_and_broken_records(spark, tmpdir_fresh):
    with open(os.path.join(tmpdir_fresh, "c.xml"), "w") as f:
        f.write(CITATIONS)
    got = files.read_xml(spark, tmpdir_fresh, "MedlineCitation", CITATION_SCHEMA)
    name = F.col("MeshHeadingList.MeshHeading.DescriptorName")
    rows = {r["id"]: (r["v"], r["n"], r["m"]) for r in got.select(
        F.col("PMID._VALUE").alias("id"), F.col("PMID._Version").alias("v"), name["_VALUE"].alias("n"), name["_MajorTopicYN"].alias("m")).collect()}
    assert rows == {12: (1, ["Heart & blood", "Lung"], ["Y", "N"]), 13: (2, ["Bare"], [None]), 16: (3, None, None)}
    kept = files.read_xml(spark, tmpdir_fresh, "MedlineCitation", CITATION_SCHEMA, broken="keep").cache()
    bad = [r[0] for r in kept.where(f"{files.BROKEN} is not null").select(files.BROKEN).collect()]
    assert kept.count() == 5 and len(bad) == 2 and all("14" in b or "15" in b for b in bad)
    kept.unpersist()


def test_nested_xml_round_trip(spark, tmpdir_fresh):
    df = spark.createDataFrame([(1, ("a <b> & c", True), [("x", "Y"), ("y", "N")]), (2, None, []), (3, ("", False), [("z", None)])],
                               "id BIGINT, body STRUCT<_VALUE: STRING, _flag: BOOLEAN>, tag ARRAY<STRUCT<_VALUE: STRING, _m: STRING>>")
    out = os.path.join(tmpdir_fresh, "x")
    files.write_xml(df, out, "all", "one")
    back = files.read_xml(spark, out, "one", "id BIGINT, body STRUCT<_VALUE: STRING, _flag: BOOLEAN>, tag ARRAY<STRUCT<_VALUE: STRING, _m: STRING>>")
    rows = {r["id"]: r for r in back.collect()}
    assert len(rows) == 3 and tuple(rows[1]["body"]) == ("a <b> & c", True) and [tuple(t) for t in rows[1]["tag"]] == [("x", "Y"), ("y", "N")]
    assert rows[2]["body"] is None and not rows[2]["tag"] and [tuple(t) for t in rows[3]["tag"]] == [("z", None)]


def test_xml_files_are_bounded(spark, tmpdir_fresh, monkeypatch):
    """One task's records go to files of a bounded number of records, as a
    file is read back whole by one task."""
    import glob

    from tabulon.sources import files

    monkeypatch.setattr(files, "RECORDS_A_FILE", 3)
    out = f"{tmpdir_fresh}/x"
    files.write_xml(spark.range(10).coalesce(1), out, "all", "one")
    assert len(glob.glob(f"{out}/part-*")) == 4
    assert sorted(r[0] for r in files.read_xml(spark, out, "one", "id BIGINT").collect()) == list(range(10))
