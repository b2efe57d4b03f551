"""GeoJSON collections feature by feature, and the space-ordered layout's skipped files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, base_row, catalog_rows
from quakescope.schema import CATALOG_COLUMNS
from quakescope.session import scratch_path
from quakescope.sources import geojson, layout
from quakescope.sources.fixture import quakes


def rows_of(df):
    return sorted(str([r[c] for c in CATALOG_COLUMNS]) for r in df.collect())


@pytest.mark.parametrize("lines", [False, True])
def test_round_trip(spark, lines):
    raw, path = quakes(spark, SF_SMALL), scratch_path(spark, "geojson")
    geojson.write_geojson(raw.repartition(3), path, per_file=100, lines=lines)
    assert rows_of(geojson.read_geojson(spark, path, lines)) == rows_of(raw)


def test_files_are_collections_of_bounded_size(spark):
    path = scratch_path(spark, "geojson")
    geojson.write_geojson(quakes(spark, SF_SMALL).limit(250), path, per_file=40)
    local = path.removeprefix("file://")
    files = [os.path.join(d, f) for d, _, names in os.walk(local) for f in names if f.endswith(".txt")]
    found = [json.load(open(f)) for f in files]
    assert all(c["type"] == "FeatureCollection" and 0 < len(c["features"]) <= 40 for c in found)
    assert sum(len(c["features"]) for c in found) == 250
    assert all(f["type"] == "Feature" and f["geometry"]["type"] == "Point" and len(f["geometry"]["coordinates"]) == 3 for c in found for f in c["features"])


FEATURES = [
    {"type": "Feature", "id": "a", "properties": {"mag": 4.5, "time": 1714557600123, "updated": "2024-05-02", "place": "here", "extra": {"x": [1]}}, "geometry": {"type": "Point", "coordinates": [100.5, -3.25, 12]}},
    {"type": "Feature", "id": "b", "properties": {"mag": None, "time": -1}, "geometry": None},
    {"type": "Feature", "id": "c", "properties": {"mag": "strong"}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
    {"type": "Feature", "id": "d", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [[1, 2]]}},
    {"type": "Other", "id": "e"},
    "text", None, 7,
    {"type": "Feature", "id": "f", "properties": {"mag": 1}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
]


def test_one_bad_feature_costs_one_row(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"type": "FeatureCollection", "metadata": {"count": 9}, "features": FEATURES}, indent=1))
    (tmp_path / "b.json").write_text("{ no json")
    (tmp_path / "c.json").write_text('{"type": "FeatureCollection", "features": []}')
    (tmp_path / "d.json").write_text('{"type": "FeatureCollection"}')
    rows = geojson.read_features(spark, str(tmp_path)).collect()
    good = {r["id"]: r for r in rows if r["bad"] is None}
    assert set(good) >= {"a", "b", "f"} and not set(good) & {"c", "d", "e"}
    a, b, f = good["a"], good["b"], good["f"]
    assert (a["mag"], a["time"], a["updated"], a["place"], a["longitude"], a["latitude"], a["depth"]) == (4.5, "2024-05-01T10:00:00.123Z", "2024-05-02", "here", 100.5, -3.25, 12.0)
    assert (b["mag"], b["time"], b["latitude"]) == (None, "1969-12-31T23:59:59.999Z", None)
    assert (f["longitude"], f["latitude"], f["depth"]) == (1.0, 2.0, None)
    bad = [r["bad"] for r in rows if r["bad"] is not None]
    assert sum('"c"' in t or '"d"' in t or '"e"' in t for t in bad) == 3 and any("no json" in t for t in bad)
    assert all(r["id"] is None and r["mag"] is None for r in rows if r["bad"] is not None)


def test_a_collection_is_read_about_once(spark, tmp_path):
    feature = {"type": "Feature", "id": "a", "properties": {"mag": 1.5, "place": "x" * 300}, "geometry": {"type": "Point", "coordinates": [1, 2, 3]}}
    text = json.dumps({"type": "FeatureCollection", "features": [feature] * 2000}, indent=1)
    (tmp_path / "a.json").write_text(text)
    read = lambda: sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    before = read()
    assert len(geojson.read_geojson(spark, str(tmp_path)).collect()) == 2000
    assert read() - before < 4 * len(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")  # its splits still give each feature once
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        frame = geojson.read_geojson(spark, str(tmp_path))
        assert frame.rdd.getNumPartitions() > 1 and frame.filter("id = 'a' AND mag = 1.5").count() == 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_empty_collections(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"type": "FeatureCollection", "features": []}')
    assert geojson.read_geojson(spark, str(tmp_path)).columns == CATALOG_COLUMNS
    assert geojson.read_geojson(spark, str(tmp_path)).count() == 0


def test_a_small_box_reads_few_files(spark):
    raw, path = quakes(spark, SF_SMALL), scratch_path(spark, "ordered")
    layout.write_space_ordered(raw, path, 32)
    whole = layout.files_of_box(spark, path, (-90, 90), (-180, 180))
    at = raw.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).orderBy("id").first()
    box = ((at["latitude"] - 4, at["latitude"] + 4), (at["longitude"] - 4, at["longitude"] + 4))
    some = layout.files_of_box(spark, path, *box)
    assert len(whole) > 16 and 0 < len(some) <= len(whole) // 3
    inside = raw.filter(F.col("latitude").between(*box[0]) & F.col("longitude").between(*box[1]))
    back = layout.read_box(spark, path, *box)
    assert rows_of(back) == rows_of(inside) and inside.count() > 0
    assert {r[0] for r in back.select("_metadata.file_path").distinct().collect()} <= set(some)
    assert rows_of(spark.read.parquet(path)) == rows_of(raw)


def test_layout_of_odd_rows(spark):
    rows = [base_row(id=str(i)) for i in range(300)]  # one place
    rows += [base_row(id="n", latitude=None), base_row(id="m", longitude=float("nan")), base_row(id="p", latitude=90.0, longitude=180.0), base_row(id="q", latitude=-90.0, longitude=-180.0)]
    raw, path = catalog_rows(spark, rows), scratch_path(spark, "ordered")
    layout.write_space_ordered(raw, path, 8)
    assert rows_of(spark.read.parquet(path)) == rows_of(raw)
    assert layout.read_box(spark, path, (1.0, 1.0), (2.0, 2.0)).count() == 300
    assert {r["id"] for r in layout.read_box(spark, path, (90.0, 90.0), (180.0, 180.0)).collect()} == {"p"}
    assert layout.read_box(spark, path, (50.0, 51.0), (50.0, 51.0)).count() == 0
    key = raw.select(layout.space_key().alias("k")).agg(F.min("k"), F.max("k")).first()
    assert key[0] == 0 and key[1] == 2**32 - 1
    empty = scratch_path(spark, "ordered")
    layout.write_space_ordered(raw.limit(0), empty, 4)
    assert layout.read_box(spark, empty, (0, 1), (0, 1)).count() == 0
