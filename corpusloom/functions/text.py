"""String helpers with UTF-8 byte and Unicode whitespace semantics."""

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the code points with the Unicode White_Space property.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c: Column | str) -> Column:
    """Drop Unicode whitespace at both ends (``trim`` knows only the space)."""
    return F.btrim(as_column(c), F.lit(WHITESPACE))


def truncate_bytes(c: Column | str, limit: int) -> Column:
    """The first ``limit`` UTF-8 bytes; a character cut in two becomes U+FFFD."""
    text = as_column(c)
    cut = F.make_valid_utf8(F.substring(text.cast("binary"), 1, limit).cast("string"))
    return F.when(F.octet_length(text) > limit, cut).otherwise(text)


def parse_tags(c: Column | str) -> Column:
    """A comma list as an array: trimmed, blanks dropped, order and repeats kept."""
    parts = F.transform(F.split(as_column(c), ","), trim_ws)
    return F.filter(parts, lambda tag: tag != "")


def _reference_table() -> dict[str, str]:
    """Texts of the named references, with and without semicolon, and of the numbers
    from 128 to 159, which mean characters of Windows-1252."""
    table = dict(html5)
    for number in range(128, 160):
        table[f"#{number}"] = bytes([number]).decode("cp1252", "replace")
    return table


def decode_references(c: Column | str) -> Column:
    """Decode the character references of an attribute value, in the JVM.

    As HTML has it for attributes, a name without its semicolon counts only if neither
    ``=`` nor a letter or digit follows; unknown names stay. Numbers that are no
    characters become U+FFFD.
    """
    text = as_column(c)
    table = F.from_json(F.lit(json.dumps(_reference_table())), "map<string,string>")
    number, name = r"&#[0-9]+;?|&#[xX][0-9A-Fa-f]+;?", "&[A-Za-z][A-Za-z0-9]*(?:;|(?![A-Za-z0-9=]))"
    pieces = F.regexp_extract_all(text, F.lit(f"(?s){number}|{name}|[^&]+|&"), F.lit(0))

    def decoded(piece: Column) -> Column:
        digits = F.regexp_extract(piece, "^&#[xX]?0*([0-9A-Fa-f]*);?", 1)
        base = F.when(F.lower(piece).startswith("&#x"), 16).otherwise(10)
        # More than 7 digits are beyond any character.
        code = F.when(base == 16, F.conv(digits, 16, 10)).otherwise(digits).cast("long")
        code = F.when(F.length(digits).between(1, 7), code).otherwise(0)
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        known = F.try_element_at(table, F.concat(F.lit("#"), code.cast("string")))
        of_number = F.coalesce(known, F.when(valid, character).otherwise("\ufffd"))
        of_name = F.coalesce(F.try_element_at(table, F.substr(piece, F.lit(2))), piece)
        return (
            F.when(piece.startswith("&#") & (F.length(piece) > 2), of_number)
            .when(piece == "&amp;", "&")
            .when(piece.startswith("&"), of_name)
            .otherwise(piece)
        )

    return F.when(text.contains("&"), F.array_join(F.transform(pieces, decoded), "")).otherwise(text)
