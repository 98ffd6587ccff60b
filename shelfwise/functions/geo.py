"""Coordinates, place references, geohash cells and place identity keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.text import norm_place

# The URL shapes that carry coordinates or a place reference, the geometry
# classes in the order they are looked for, and the geohash alphabet.
SEARCH_COORDS = r"/search/\+?(-?\d+\.\d+),\s*\+?(-?\d+\.\d+)"
AT_COORDS = r"@(-?\d+\.\d+),(-?\d+\.\d+)"
PLACE_REFERENCE = r"(0x[0-9a-fA-F]+:0x[0-9a-fA-F]+)"
GEOMETRIES = ("Point", "LineString", "Polygon", "MultiGeometry")
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"


def url_coords(url: Column) -> tuple[Column, Column]:
    """(lat, lon) from a search URL, else from an ``@lat,lon`` URL, else nulls."""

    def part(group: int) -> Column:
        found = [F.regexp_extract(url, rx, group).try_cast("double") for rx in (SEARCH_COORDS, AT_COORDS)]
        return F.when(url.rlike(SEARCH_COORDS), found[0]).otherwise(found[1])

    return part(1), part(2)


def url_reference(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, PLACE_REFERENCE, 1), F.lit(""))


def point_coords(text: Column) -> tuple[Column, Column]:
    """(lat, lon) of a ``lon,lat[,alt]`` text; both null when either is unreadable."""
    parts = F.split(F.trim(text), ",")
    lon, lat = (F.trim(F.get(parts, F.lit(i))).try_cast("double") for i in (0, 1))
    both = lon.isNotNull() & lat.isNotNull()
    return F.when(both, lat), F.when(both, lon)


def _cell(value: Column, low: float, span: float, bits: int) -> Column:
    """Index of the cell holding ``value`` among 2^bits equal cells, clamped to the range.

    The division can be one cell off at an edge, so the result is checked against the cell
    edges, which are exact doubles.
    """
    cells = 1 << bits
    guess = F.least(
        F.greatest(F.floor((value - low) / span * cells), F.lit(0)), F.lit(cells - 1)
    ).cast("bigint")
    width = span / cells
    below = (value < guess * width + low) & (guess > 0)
    above = (value >= (guess + 1) * width + low) & (guess < cells - 1)
    return F.when(below, guess - 1).when(above, guess + 1).otherwise(guess)


def _letters(first_bits: int) -> str:
    """Alphabet indexed by the two bit runs of a letter: ``first_bits`` of one axis that
    take its odd bits (1st, 3rd, 5th or 2nd, 4th), then the rest of the other axis."""
    table = []
    for index in range(32):
        leading, trailing = index >> (5 - first_bits), index & ((1 << (5 - first_bits)) - 1)
        runs = (f"{leading:0{first_bits}b}", f"{trailing:0{5 - first_bits}b}")
        mixed = "".join((runs[0] if i % 2 == 0 else runs[1])[i // 2] for i in range(5))
        table.append(BASE32[int(mixed, 2)])
    return "".join(table)


def geohash(lat: Column, lon: Column, precision: int = 7) -> Column:
    """Geohash of a point, exact on cell edges; null when a coordinate is missing.

    Even letters take three longitude and two latitude bits, odd letters the reverse, so a
    letter is one lookup. The one-element arrays bind a value so that it is computed once.
    """
    total = 5 * precision
    lon_bits, lat_bits = (total + 1) // 2, total // 2
    table = F.lit(_letters(3))

    def text(cells: Column) -> Column:
        left = {"lon": lon_bits, "lat": lat_bits}
        out = []
        for i in range(precision):
            three, two = ("lon", "lat") if i % 2 == 0 else ("lat", "lon")
            left[three] -= 3
            left[two] -= 2
            high = F.shiftright(cells[three], left[three]).bitwiseAND(F.lit(7))
            low = F.shiftright(cells[two], left[two]).bitwiseAND(F.lit(3))
            out.append(F.substring(table, (high * 4 + low + 1).cast("int"), F.lit(1)))
        return F.concat(*out)

    def cells(point: Column) -> Column:
        return F.struct(
            _cell(point["lat"], -90.0, 180.0, lat_bits).alias("lat"),
            _cell(point["lon"], -180.0, 360.0, lon_bits).alias("lon"),
        )

    point = F.array(F.struct(lat.alias("lat"), lon.alias("lon")))
    coded = F.get(F.transform(F.transform(point, cells), text), F.lit(0))
    return F.when(lat.isNotNull() & lon.isNotNull(), coded)


def place_keys(name: Column, lat: Column, lon: Column, reference: Column, list_key: Column) -> Column:
    """Identity keys in priority order: reference, name at a cell, or name in its list."""
    norm = norm_place(name)
    has_coords = lat.isNotNull() & lon.isNotNull()
    by_reference = F.when(reference.isNotNull(), F.concat(F.lit("cid:"), reference))
    by_cell = F.when(has_coords, F.concat(F.lit("geo:"), norm, F.lit("|"), geohash(lat, lon)))
    by_list = F.when(
        reference.isNull() & ~has_coords, F.concat(F.lit("raw:"), norm, F.lit("|"), list_key)
    )
    return F.array_compact(F.array(by_reference, by_cell, by_list))


def join_note(note: Column, comment: Column) -> Column:
    """The two free texts joined by a dash, blanks dropped; null when both are blank."""
    joined = F.concat_ws(" — ", F.nullif(note, F.lit("")), F.nullif(comment, F.lit("")))
    return F.nullif(joined, F.lit(""))
