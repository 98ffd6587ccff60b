"""Text keys as native column expressions: accent fold, match keys, case fold, weak keys.

Folding is done per code point, so it is a character substitution and needs no Python
worker: the substitution tables are derived on the driver from ``unicodedata`` and handed
to ``translate``. The few characters that expand to several letters take a second branch
that only rows containing one of them enter.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The match-key patterns. (?d) lets "." stop at a line feed only.
FEATURING = r"(?d)\b(feat\.?|featuring|ft\.?)\b.*"
BRACKETED = r"[\(\[][^)\]]*[\)\]]"
NOT_ALNUM = r"[^a-z0-9]+"
# White space other than the plain blank; runs of any of it.
_SPACES = r"\t-\r\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
UNEVEN_SPACE = rf"[ {_SPACES}]{{2,}}|[{_SPACES}]"

_SEPARATOR = "\t"


def strip(x: Column) -> Column:
    """Without the white space of any kind at either end."""
    return F.regexp_replace(x, rf"^[ {_SPACES}]+|[ {_SPACES}]+$", "")


@lru_cache(maxsize=None)
def digit_class() -> str:
    """A pattern class of every character that counts as a digit, superscripts and the like included."""
    codes = {c for c in range(sys.maxunicode + 1) if chr(c).isdigit()}
    starts = sorted(c for c in codes if c - 1 not in codes)
    ends = sorted(c for c in codes if c + 1 not in codes)
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in zip(starts, ends)) + "]"


def _substitutions(rule: Callable[[str], str], first: int) -> tuple[str, str, dict[str, str]]:
    """One-to-one pairs and expansions of ``rule`` over all code points from ``first``."""
    source, target, expand = [], [], {}
    for code in range(first, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        mapped = rule(char)
        if mapped == char or not mapped:
            continue
        if len(mapped) == 1:
            source.append(char)
            target.append(mapped)
        else:
            expand[char] = mapped
    return "".join(source), "".join(target), expand


def _ascii_part(char: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", char) if c < "\x80")


@lru_cache(maxsize=None)
def _ascii_table() -> tuple[str, str, dict[str, str]]:
    return _substitutions(_ascii_part, 0x80)


@lru_cache(maxsize=None)
def _casefold_table() -> tuple[str, str, dict[str, str]]:
    return _substitutions(str.casefold, 0x41)


def _bind(x: Column, use: Callable[[Column], Column]) -> Column:
    """``use(x)`` with ``x`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(x), lambda bound: use(bound)), F.lit(0))


def _is_ascii(x: Column) -> Column:
    return F.octet_length(x) == F.char_length(x)


def _expand(x: Column, expand: dict[str, str]) -> Column:
    """Replace the characters that become several; other rows pass after one check.

    Only the distinct characters outside ASCII that a row holds are looked up, so the work does not
    grow with the size of the table.
    """
    table = F.str_to_map(F.lit("\n".join(c + _SEPARATOR + t for c, t in expand.items())), F.lit("\n"), F.lit(_SEPARATOR))
    present = F.array_distinct(F.split(F.regexp_replace(x, r"[\x00-\x7F]+", ""), ""))
    known = F.filter(present, lambda c: F.element_at(table, c).isNotNull())
    expanded = F.aggregate(known, x, lambda acc, c: F.replace(acc, c, F.element_at(table, c)))
    return F.when(F.translate(x, "".join(expand), "") != x, expanded).otherwise(x)


def fold_ascii(x: Column) -> Column:
    """Compatibility-decompose and keep the ASCII part; null stays null."""
    source, target, expand = _ascii_table()

    def finish(single: Column) -> Column:
        rest = F.regexp_replace(_expand(single, expand), r"[^\x00-\x7F]+", "")
        return F.when(_is_ascii(single), single).otherwise(rest)

    return F.when(_is_ascii(x), x).otherwise(_bind(F.translate(x, source, target), finish))


def fold_case(x: Column) -> Column:
    """Full Unicode case fold (``ß`` becomes ``ss``), not locale lower-casing."""
    source, target, expand = _casefold_table()
    folded = _bind(F.translate(x, source, target), lambda single: _expand(single, expand))
    return F.when(_is_ascii(x), F.lower(x)).otherwise(folded)


def norm_key(x: Column) -> Column:
    """Match key of an artist or title: fold, lower, cut "feat.", drop brackets, alnum only.

    The two rarer patterns run only on rows that contain their letters or brackets.
    """

    def has(text: Column, *parts: str) -> Column:
        found = [F.contains(text, F.lit(p)) for p in parts]
        return found[0] | found[1]

    def cut(text: Column) -> Column:
        return F.when(has(text, "feat", "ft"), F.regexp_replace(text, FEATURING, "")).otherwise(text)

    def drop(text: Column) -> Column:
        return F.when(has(text, "(", "["), F.regexp_replace(text, BRACKETED, "")).otherwise(text)

    folded = F.lower(fold_ascii(F.coalesce(x, F.lit(""))))
    return F.regexp_replace(_bind(_bind(folded, cut), drop), NOT_ALNUM, "")


def norm_place(x: Column) -> Column:
    """Match key of a place name: fold, lower, alnum only ("feat" and brackets stay)."""
    return F.regexp_replace(F.lower(fold_ascii(F.coalesce(x, F.lit("")))), NOT_ALNUM, "")


def norm_ws(x: Column) -> Column:
    """Case fold and collapse white space; the harvest caches are keyed by this."""
    return F.trim(F.regexp_replace(fold_case(F.coalesce(x, F.lit(""))), UNEVEN_SPACE, " "))


def track_key(artist: Column, track: Column) -> Column:
    """Cache key of a track."""
    return F.concat(norm_ws(artist), F.lit("||"), norm_ws(track))


def with_norm_key(df: DataFrame, **outputs: str) -> DataFrame:
    """Add ``output=norm_key(input)`` columns, e.g. ``with_norm_key(df, na="artist")``."""
    return df.withColumns({out: norm_key(F.col(col)) for out, col in outputs.items()})


def key_strength(na: Column, nt: Column) -> Column:
    """``both``, ``one`` or ``none`` of the two key parts carry text."""
    filled = (na != "").cast("int") + (nt != "").cast("int")
    return F.when(filled == 2, "both").when(filled == 1, "one").otherwise("none")


def digits_only(x: Column) -> Column:
    return x.rlike(f"^{digit_class()}+$")


def is_strong_dedup_key(na: Column, nt: Column) -> Column:
    """Normalised artist and title present and the title not just a number."""
    return (na != "") & (nt != "") & ~digits_only(nt)


def is_weak_tag(artist: Column, title: Column) -> Column:
    """Raw artist or title missing or blank, or a numeric title (before normalising)."""
    a = strip(F.coalesce(artist, F.lit("")))
    t = strip(F.coalesce(title, F.lit("")))
    return (a == "") | (t == "") | digits_only(t)


def blank_to_null(x: Column) -> Column:
    return F.nullif(strip(x), F.lit(""))
