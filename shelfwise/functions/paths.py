"""Path expressions: drive conversion, names, suffixes, guesses from file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.text import digits_only, strip

# Suffixes of audio files and the quarantine folder that is never re-read.
AUDIO_EXTENSIONS = (".mp3", ".flac", ".m4a", ".aac", ".wav", ".ogg", ".wma", ".aiff", ".alac")
QUARANTINE = "_a_trier"

_MOUNT = r"(?s)^/mnt/([a-z])/(.*)$"


def win_path(path: Column) -> Column:
    """``/mnt/m/x/y`` to ``M:\\x\\y``; other paths are unchanged."""
    drive = F.upper(F.regexp_extract(path, _MOUNT, 1))
    rest = F.translate(F.regexp_extract(path, _MOUNT, 2), "/", "\\")
    return F.when(path.rlike(_MOUNT), F.concat(drive, F.lit(":\\"), rest)).otherwise(path)


def filename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Lower-case suffix with its dot; a leading or trailing dot is no suffix."""
    return F.lower(F.regexp_extract(filename(path), r"[^.].*?(\.[^.]+)$", 1))


def stem(path: Column) -> Column:
    name = filename(path)
    return F.substring(name, F.lit(1), F.char_length(name) - F.char_length(extension(path)))


def in_folder(path: Column, folder: str = QUARANTINE) -> Column:
    """True when ``folder`` is one of the path's parts."""
    return F.array_contains(F.split(path, "/"), folder)


def contains_any(path: Column, parts: list[str]) -> Column:
    """True when any of the substrings occurs in the path."""
    hit = F.lit(False)
    for part in parts:
        hit = hit | F.contains(path, F.lit(part))
    return hit


def file_kind(path: Column) -> Column:
    """``my_maps`` for map exports, ``saved`` for list exports, else ``other``."""
    ext = extension(path)
    return (
        F.when(ext.isin(".kml", ".kmz"), "my_maps").when(ext == ".csv", "saved").otherwise("other")
    )


def guess_artist_title(name: Column) -> Column:
    """``struct(artist, title)`` read from "NN - Artist - Title" style names.

    A leading part made of digits and dots is a track number. With fewer than two parts
    left the title is the whole name, number included.
    """
    parts = F.filter(F.transform(F.split(name, " - "), lambda p: strip(p)), lambda p: p != "")
    numbered = digits_only(F.replace(F.get(parts, F.lit(0)), F.lit("."), F.lit("")))
    parts = F.when(
        F.coalesce(numbered, F.lit(False)), F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    ).otherwise(parts)
    rest = F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), " - ")
    guessed = F.size(parts) >= 2
    return F.struct(
        F.when(guessed, F.get(parts, F.lit(0))).otherwise("").alias("artist"),
        F.when(guessed, rest).otherwise(name).alias("title"),
    )
