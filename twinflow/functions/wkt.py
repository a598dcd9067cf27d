"""Well-known text as Column expressions.

Text is checked with possessive patterns only: they never backtrack, so a ring
of any length is matched in constant stack depth.
"""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from twinflow.functions.text import strip

_NUMBER = r"[-+]?+(?:\d++(?:\.\d*+)?+|\.\d++)(?:[eE][-+]?+\d++)?+"


def _grammar() -> str:
    """One geometry (no collection), any keyword case, XY to XYZM."""
    sep = r"\s*+,\s*+"

    def group(item: str, least: int = 1) -> str:
        rest = rf"(?:{sep}{item})" + ("*+" if least == 1 else rf"{{{least - 1},}}+")
        return rf"\(\s*+{item}{rest}\s*+\)"

    def bodies(extra: str) -> str:
        point = rf"{_NUMBER}(?:\s++{_NUMBER}){extra}"
        line = group(point, 2)
        ring = group(point, 4)
        hole = rf"(?:{ring}|EMPTY)"
        polygon = group(hole)
        kinds = {
            "POINT": rf"\(\s*+{point}\s*+\)",
            "LINESTRING": line,
            "LINEARRING": ring,
            "POLYGON": polygon,
            "MULTIPOINT": group(rf"(?:{point}|\(\s*+{point}\s*+\)|EMPTY)"),
            "MULTILINESTRING": group(rf"(?:{line}|EMPTY)"),
            "MULTIPOLYGON": group(rf"(?:{polygon}|EMPTY)"),
        }
        return "|".join(rf"{k}\s*+@(?:EMPTY|{v})" for k, v in kinds.items())

    variants = [
        bodies("{1,3}+").replace("@", ""),
        bodies("{2}+").replace("@", r"(?:Z|M)\s*+"),
        bodies("{3}+").replace("@", r"ZM\s*+"),
    ]
    return "(?i)(?:" + "|".join(variants) + ")"


_GEOMETRY = _grammar()
_COLLECTION = (
    r"(?i)GEOMETRYCOLLECTION\s*+(?:ZM|Z|M)?+\s*+(?:EMPTY|\(\s*+#(?:\s*+,\s*+#)*+\s*+\))"
)
_UNRINGED = (
    r"(?i)(?<![A-Z])(?:MULTI)?+(?:POINT|LINESTRING)\s*+(?:ZM|Z|M)?+\s*+"
    r"\((?:[^()]++|\([^()]*+\))*+\)"
)


def _closed(ring: Column) -> Column:
    """First and last coordinate are the same text, or else agree as numbers in x and y."""
    first = strip(F.substring_index(ring, ",", 1))
    last = strip(F.substring_index(ring, ",", -1))

    def ordinate(point: Column, i: int) -> Column:
        return F.try_element_at(F.split(point, r"\s+"), F.lit(i)).try_cast("double")

    agree = (ordinate(first, 1) == ordinate(last, 1)) & (ordinate(first, 2) == ordinate(last, 2))
    return F.when(first == last, F.lit(True)).otherwise(agree)


def is_wkt(wkt: Column) -> Column:
    """True when the text is a readable geometry with closed rings.

    Collections are read inside out: each plain geometry is folded to ``#``,
    then each collection of ``#`` as often as there are collections in the
    text, so nesting may be of any depth.
    """
    text = strip(wkt)
    kind = F.upper(F.substring(text, 1, 18))
    collection = kind == "GEOMETRYCOLLECTION"
    names = F.regexp_extract_all(text, F.lit("(?i)GEOMETRYCOLLECTION"), F.lit(0))
    nested = F.aggregate(
        names,
        F.regexp_replace(text, _GEOMETRY, "#"),
        lambda part, _: F.regexp_replace(part, _COLLECTION, "#"),
    )
    readable = F.when(collection, ~text.contains("#") & (nested == "#")).otherwise(
        text.rlike(f"^(?:{_GEOMETRY})$")
    )
    # forall over no ring at all is true, so the grammar has the first word
    closed = (
        F.when(kind.rlike("^(?:MULTI)?(?:POINT|LINESTRING)"), F.lit(True))
        .when(collection, F.forall(_lists(F.regexp_replace(text, _UNRINGED, " ")), _closed))
        .otherwise(F.forall(_lists(text), _closed))
    )
    return F.coalesce(F.when(readable, closed), F.lit(False))


def _lists(text: Column) -> Column:
    """The innermost coordinate lists; in a text without points and lines, the rings."""
    return F.regexp_extract_all(text, F.lit(r"\((\s*+[-+.\d][^()]*+)\)"), F.lit(1))


def prefixed(proj: Column, wkt: Column) -> Column:
    """The wire form: projection, one blank, text."""
    return F.concat_ws(" ", proj, wkt)


_PREFIX = r"[A-Za-z][A-Za-z0-9_-]*+:\S++"


def has_prefix(shape: Column) -> Column:
    return shape.rlike(rf"^\s*+{_PREFIX}\s")


def proj_of(shape: Column) -> Column:
    return F.nullif(F.regexp_extract(shape, rf"^\s*+({_PREFIX})\s", 1), F.lit(""))


def wkt_of(shape: Column) -> Column:
    """The text without its projection prefix."""
    return strip(F.regexp_replace(shape, rf"^\s*+{_PREFIX}\s++", ""))


_PAIR = rf"({_NUMBER})\s++({_NUMBER})(?:\s++{_NUMBER})*+"


def ordinates(wkt: Column, axis: int) -> Column:
    """All x (axis 1) or y (axis 2) values of a text."""
    found = F.regexp_extract_all(wkt, F.lit(_PAIR), F.lit(axis))
    return F.transform(found, lambda n: n.try_cast("double"))


def bbox(wkt: Column) -> Column:
    """struct(min_x, min_y, max_x, max_y); null fields for an empty geometry and
    for text that is none."""
    both = F.when(is_wkt(wkt), F.struct(*[ordinates(wkt, axis).alias(name) for axis, name in ((1, "x"), (2, "y"))]))

    def of(both: Column) -> Column:
        return F.struct(
            F.array_min(both["x"]).alias("min_x"),
            F.array_min(both["y"]).alias("min_y"),
            F.array_max(both["x"]).alias("max_x"),
            F.array_max(both["y"]).alias("max_y"),
        )

    # bind the ordinates once
    return F.transform(F.array(both), of)[0]


def bbox_to_wkt(min_x: Column, min_y: Column, max_x: Column, max_y: Column) -> Column:
    """Closed rectangle, counter-clockwise from the lower left, six decimals."""
    corners = [(min_x, min_y), (max_x, min_y), (max_x, max_y), (min_x, max_y), (min_x, min_y)]
    flat = reduce(lambda acc, xy: acc + list(xy), corners, [])
    text = F.format_string("POLYGON((" + ", ".join(["%f %f"] * 5) + "))", *flat)
    missing = reduce(lambda a, b: a | b, [c.isNull() for c in (min_x, min_y, max_x, max_y)])
    return F.when(~missing, text)


def coords_to_wkt(coords: Column) -> Column:
    """array<struct<x,y>> to text: one point, two a line, more a polygon.

    Ordinates keep all their digits, so a small ring does not collapse.
    """
    size = F.size(coords)
    ring = F.when(
        F.element_at(coords, 1) == F.element_at(coords, -1), coords
    ).otherwise(F.concat(coords, F.slice(coords, 1, 1)))

    def text(points: Column) -> Column:
        return F.array_join(
            F.transform(points, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", "
        )

    return (
        F.when(size == 1, F.concat(F.lit("POINT("), text(coords), F.lit(")")))
        .when(size == 2, F.concat(F.lit("LINESTRING("), text(coords), F.lit(")")))
        .when(size >= 3, F.concat(F.lit("POLYGON(("), text(ring), F.lit("))")))
    )
