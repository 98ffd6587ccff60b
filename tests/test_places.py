"""Map and list exports through the whole place build."""

import zipfile

import pytest

from shelfwise.plans import jobs
from shelfwise.sources.maps import read_maps, read_saved_lists, unreadable_maps

def placemark(name: str, shape: str = "", **data: str) -> str:
    extended = "".join(f'<Data name="{k}"><value>{v}</value></Data>' for k, v in data.items())
    return f"<Placemark><name>{name}</name>{f'<ExtendedData>{extended}</ExtendedData>' if extended else ''}{shape}</Placemark>"


def point(lat: float, lon: float) -> str:
    return f"<Point><coordinates>{lon},{lat}</coordinates></Point>"


# Two loose points, a layer with a polygon between points, a layer of one, and an empty one.
KML = (
    '<kml xmlns="http://www.opengis.net/kml/2.2"><Document><name>Alpine huts</name>'
    + placemark("Lake hut", point(46.5, 9.25), beds="24", open="June") + placemark("Mill", point(46.75, 9.5))
    + "<Folder><name>North</name>" + placemark("Pass refuge", point(47.0, 9.75)) + placemark("Reserve", "<Polygon/>")
    + placemark("LAKE HUT", point(46.5, 9.25)) + placemark("Summit", point(47.25, 9.875)) + "</Folder>"
    + "<Folder><name>South</name>" + placemark("Pass refuge", point(47.0, 9.75)) + "</Folder><Folder><name>Later</name></Folder>"
    + "</Document></kml>"
)
CSV = (
    "URL,Comment,Title,Note\n"
    '"https://maps.example.net/search/47.25,9.875",steep,Summit,with rope\n'
    "https://maps.example.net/x?q=1,,Somewhere below,\n"
    ",,,\n"
    '"https://maps.example.net/place/Y/@46.125,9.125,14z/data=!4m2!1s0x1:0xabc",,"Cellar, old","two\nlines"\n'
    '"https://maps.example.net/place/Y/@46.125,9.125,14z/data=!4m2!1s0x1:0xabc",again,Cellar by the church,\n'
    "https://maps.example.net/place/Z/data=!4m2!1s0x2:0xdef,,By reference,\n"
)


@pytest.fixture()
def exports(tmp_path):
    folder = tmp_path / "exports"
    (folder / "drawn").mkdir(parents=True)
    (folder / "drawn" / "huts.kml").write_text(KML, encoding="utf-8")
    (folder / "Someday.csv").write_text(CSV, encoding="utf-8")
    for i in range(12):
        (folder / f"stray{i:02d}.txt").write_text("x")
    return folder


def test_build_worked_out_by_hand(spark, exports, tmp_path):
    """Six points on the map and five saved rows: Lake hut, Pass refuge, Summit and Cellar occur twice."""
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    first = jobs.build_places(spark, str(exports), out, state).first().asDict()
    rows = {r["name"]: r for r in spark.read.parquet(f"{out}/places").collect()}
    assert set(rows) == {"Lake hut", "Mill", "Pass refuge", "Summit", "Somewhere below", "Cellar, old", "By reference"}
    assert (first["occurrences"], first["merged"], first["new_places"], first["places"]) == (11, 4, 7, 7)
    assert (first["skipped_tracks"], first["resolved"], first["unresolved"], first["refs"]) == (1, 5, 2, 2)
    assert (first["lists"], first["map_lists"], first["saved_lists"]) == (5, 4, 1)
    assert (first["links"], first["in_several_lists"]) == (10, 3)
    assert rows["Lake hut"]["id"] == "P6-PLC-000001"
    assert rows["Lake hut"]["extra"] == '{"beds":"24","open":"June"}'
    assert rows["Pass refuge"]["norm_name"] == "passrefuge"
    assert rows["By reference"]["lat"] is None and rows["By reference"]["geohash"] is None
    ids = {n: r["id"] for n, r in rows.items()}
    again = jobs.build_places(spark, str(exports), out, state).first().asDict()
    assert (again["new_places"], again["new_lists"], again["places"]) == (0, 0, 7)
    assert {r["name"]: r["id"] for r in spark.read.parquet(f"{out}/places").collect()} == ids
    assert jobs.places_totals(spark, out).first()["links"] == 10
    notes = {r["note"] for r in spark.read.parquet(f"{out}/list_places").collect()}
    assert "two\nlines" in notes and "with rope — steep" in notes


def test_inventory(spark, exports):
    found = jobs.inventory(spark, str(exports))
    maps = {r["map"]: r for r in found["maps"].collect()}
    assert (maps["Alpine huts"]["points"], maps["Alpine huts"]["tracks"]) == (6, 1)
    assert "North:4" in maps["Alpine huts"]["layers"] and "South:1" in maps["Alpine huts"]["layers"]
    got = {r["list"]: r for r in found["lists"].collect()}["Someday"]
    assert (got["n_rows"], got["with_coords"], got["reference_only"], got["name_only"]) == (5, 3, 1, 1)
    assert [r["path"].rsplit("/", 1)[1] for r in found["other"].collect()] == [f"stray{i:02d}.txt" for i in range(12)]


def test_a_build_does_not_lose_an_unreadable_map(spark, exports, tmp_path):
    (exports / "drawn" / "torn.kml").write_text("<kml><Document><Placemark>")
    with pytest.raises(ValueError, match="torn.kml"):
        jobs.build_places(spark, str(exports), str(tmp_path / "out"), str(tmp_path / "state"))


def test_lists_of_any_width(spark, tmp_path):
    """Forty columns with the title last, beside a narrow list."""
    extra = ",".join(f"f{i}" for i in range(39))
    (tmp_path / "wide.csv").write_text(f"{extra},Title\n{',' * 39}the last one\n")
    (tmp_path / "narrow.csv").write_text("Title\nfirst\n")
    assert {(r["list"], r["title"]) for r in read_saved_lists(spark, str(tmp_path)).collect()} == {("wide", "the last one"), ("narrow", "first")}


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "utf-16", "latin-1"])
def test_archives_of_any_declared_encoding(spark, tmp_path, encoding):
    declared = f'<?xml version="1.0" encoding="{encoding.removesuffix("-sig")}"?>'
    with zipfile.ZipFile(tmp_path / "A.kmz", "w") as archive:
        archive.writestr("doc.kml", (declared + KML.replace("Mill", "Mühle é")).encode(encoding))
    assert "Mühle é" in {r["name"] for r in read_maps(spark, str(tmp_path), strict=True).collect()}


def test_archives_loose_placemarks_and_broken_maps(spark, tmp_path):
    loose = (
        '<kml xmlns="http://www.opengis.net/kml/2.2"><Document><Placemark><name> A </name><Point><coordinates>1,2'
        "</coordinates></Point></Placemark><Folder><name>Empty</name></Folder></Document></kml>"
    )
    with zipfile.ZipFile(tmp_path / "Packed.kmz", "w") as archive:
        archive.writestr("doc.kml", loose)
    (tmp_path / "Root.kml").write_text(loose.replace("<Document>", "").replace("</Document>", ""))
    (tmp_path / "Broken.kmz").write_bytes(b"no archive")
    rows = {(r["map"], r["layer"], r["name"], r["lat"], r["lon"], r["pos"]) for r in read_maps(spark, str(tmp_path)).collect()}
    assert rows == {
        (m, *row) for m in ("Packed", "Root") for row in [("", "A", 2.0, 1.0, 0), ("Empty", "", None, None, None)]
    }
    assert [r["path"].rsplit("/", 1)[1] for r in unreadable_maps(spark, str(tmp_path)).collect()] == ["Broken.kmz"]


def test_list_headers_vary_and_the_last_duplicate_wins(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Comment,Title,Titre,URL\nc,old,new,u\n")
    (tmp_path / "b.CSV").write_text("URL,TITLE\nhttps://x/@1.5,-2.5,\n")
    rows = {r["list"]: r for r in read_saved_lists(spark, str(tmp_path)).collect()}
    assert (rows["a"]["title"], rows["a"]["comment"], rows["a"]["note"]) == ("new", "c", "")
    assert rows["b"]["url"] == "https://x/@1.5"
