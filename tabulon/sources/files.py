"""File sources and sinks: XML, GeoJSON, CSV directories, delimited text.

All are Spark's built-in data sources (``xml``, ``json``, ``csv``, ``text``),
so reads are split across tasks and schemas are given explicitly where the
shape is known (no inference pass over the data)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.geometry import ring_area


BROKEN = "_corrupt_record"
RECORDS_A_FILE = 50_000


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str | None = None, broken: str = "drop") -> DataFrame:
    """Rows by ``row_tag``; attributes arrive as ``_name``, element text next
    to attributes as ``_VALUE``, repeated elements as arrays, and nested
    elements as structs. Without a schema it is inferred (one extra pass).

    ``broken`` says what becomes of records that are no well-formed XML or
    whose values do not fit the schema: "drop" leaves them out, "keep" keeps
    their text in the column ``_corrupt_record`` (a schema is needed), "fail"
    ends the job. The parser can't tell where a record that is not well-formed
    ends: the rest of its file goes with it. Elements that the schema does not
    name are left out."""
    mode = {"drop": "DROPMALFORMED", "keep": "PERMISSIVE", "fail": "FAILFAST"}[broken]
    r = spark.read.format("xml").option("rowTag", row_tag).option("mode", mode)
    if schema:
        r = r.schema(f"{schema}, {BROKEN} STRING" if broken == "keep" else schema)
    elif broken == "keep":
        raise ValueError("broken records are kept under an explicit schema only")
    return r.option("columnNameOfCorruptRecord", BROKEN).load(path)


def write_xml(df: DataFrame, path: str, root_tag: str, row_tag: str) -> None:
    """One or more files a task, of ``RECORDS_A_FILE`` records at most: a file
    is read back whole by one task."""
    df.write.format("xml").option("rootTag", root_tag).option("rowTag", row_tag).option("maxRecordsPerFile", RECORDS_A_FILE).save(path)


def read_geojson(spark: SparkSession, path: str, code_prop: str = "boroughCode",
                 name_prop: str = "borough") -> DataFrame:
    """A GeoJSON FeatureCollection to one row per feature: (code, name, area,
    min_x, min_y, max_x, max_y, edges) -- the shape
    ``operators.geo.point_in_polygon`` consumes. Polygon and MultiPolygon
    features are read with their holes; each file is parsed by a task."""
    schema = ("type STRING, features ARRAY<STRUCT<type: STRING, properties: MAP<STRING, STRING>, "
              "geometry: STRUCT<type: STRING, coordinates: STRING>>>")
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    f = raw.select(F.explode("features").alias("f"))
    g = f.select(F.col("f.properties")[code_prop].cast("int").alias("code"),
                 F.col("f.properties")[name_prop].alias("name"),
                 F.col("f.geometry.type").alias("gtype"), F.col("f.geometry.coordinates").alias("coords"))
    # a polygon is a list of rings (outer, then holes), a multipolygon a list
    # of polygons; both become one region per feature
    polys = F.when(F.col("gtype") == "Polygon", F.array(F.from_json("coords", "ARRAY<ARRAY<ARRAY<DOUBLE>>>"))) \
             .when(F.col("gtype") == "MultiPolygon", F.from_json("coords", "ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>"))
    return polygons_to_regions(g.select("code", "name", polys.alias("polys")).where("polys is not null"))


def _ring_edges(ring) -> Column:
    n = F.size(ring)
    return F.transform(ring, lambda p, i: F.struct(
        p[0].alias("x1"), p[1].alias("y1"), ring[(i + 1) % n][0].alias("x2"), ring[(i + 1) % n][1].alias("y2")))


def _shoelace(edges) -> Column:
    s = F.aggregate(edges, F.lit(0.0), lambda a, e: a + e["x1"] * e["y2"] - e["x2"] * e["y1"])
    return F.abs(s) / 2.0


def polygons_to_regions(df: DataFrame, polys: str = "polys") -> DataFrame:
    """Arrays of polygons (arrays of rings [[x, y], ...], the first one the
    outer ring, the rest holes) to area, bounding box and edge list of the
    whole feature. The edges of all rings lie in one list: counting crossings
    over it leaves holes outside and joins the parts."""
    r = df.withColumn("_rings", F.transform(polys, lambda p: F.transform(p, _ring_edges)))
    own = F.transform("_rings", lambda p: F.aggregate(F.transform(p, lambda e, i: F.when(i == 0, _shoelace(e)).otherwise(-_shoelace(e))),
                                                      F.lit(0.0), lambda a, x: a + x))
    r = r.select("code", "name", F.aggregate(own, F.lit(0.0), lambda a, x: a + x).alias("area"),
                 F.flatten(F.flatten("_rings")).alias("edges"))
    xs, ys = F.transform("edges", lambda e: e["x1"]), F.transform("edges", lambda e: e["y1"])
    return r.select("code", "name", "area", F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"),
                    F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y"), "edges")


def read_price_csv_dir(spark: SparkSession, path: str) -> DataFrame:
    """A directory of 'date,value,...' files, one per instrument, also in
    sub-directories (see ``parse_price_csv``)."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    # a file's lines keep their order within a split, splits go by offset
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"),
                         F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"))
    base = F.lit(path.rstrip("/").split("/")[-1] + "/")
    return parse_price_csv(lines, at="at", name=F.element_at(F.split("file", base), -1))


def parse_price_csv(lines: DataFrame, col: str = "value", file: str = "file", at: str | None = None, name=None) -> DataFrame:
    """(series, dt, value) from 'date,value,...' lines tagged with their file
    and, in ``at``, their order in it. Series = file (or ``name``) without
    extension; header lines fail the date parse and drop out; a file whose
    first line holds html (an error page saved as data) is dropped whole, a
    later stray line alone. Only the first value column is kept."""
    f = F.split(F.col(col), ",")
    first = F.min_by(F.lower(F.col(col)).contains("html"), at) if at else F.first(F.lower(F.col(col)).contains("html"))
    bad = lines.groupBy(F.col(file).alias("_bad")).agg(first.alias("html")).where("html").select("_bad")
    rows = lines.join(bad, F.col(file) == F.col("_bad"), "left_anti").select(
        F.regexp_replace(F.col(file) if name is None else name, r"\.[^./]*$", "").alias("series"),
        F.to_date(F.try_to_timestamp(f[0], F.lit("yyyy-MM-dd"))).alias("dt"),
        F.try_element_at(f, F.lit(2)).try_cast("double").alias("value"))
    return rows.where(F.col("dt").isNotNull() & F.col("value").isNotNull())


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = False) -> None:
    """CSV / TSV sink (one part file per task)."""
    df.write.option("sep", sep).option("header", header).csv(path)


def write_geojson(regions: list[tuple[int, str, list]], path: str) -> None:
    """Write a small FeatureCollection (test helper for the GeoJSON reader)."""
    import json
    feats = [{"type": "Feature", "properties": {"boroughCode": str(c), "borough": n},
              "geometry": {"type": "Polygon", "coordinates": [[list(p) for p in ring]]}}
             for c, n, ring in regions]
    with open(path, "w") as fh:
        json.dump({"type": "FeatureCollection", "features": feats}, fh)


__all__ = ["read_xml", "write_xml", "read_geojson", "polygons_to_regions", "read_price_csv_dir",
           "parse_price_csv", "write_delimited", "write_geojson", "ring_area"]
