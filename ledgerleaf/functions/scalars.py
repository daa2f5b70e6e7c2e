"""Column expressions for text, numbers, years, dates, identifiers and evidence. All run in the JVM."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO_PREFIX = "00000000-0000-0000-0000-"


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def is_null_or_empty(c: Column) -> Column:
    """Blank for reference and duplicate checks."""
    return c.isNull() | (c.cast("string") == "")


def is_blank(c: Column) -> Column:
    """Blank after trimming white space."""
    return c.isNull() | ~_s(c).rlike(r"(?U)\S")


def normalize_for_match(c: Column) -> Column:
    """A hyphen right before line ends goes with them, for a blank; white space becomes one blank; trimmed, lower case."""
    joined = F.regexp_replace(_s(c), r"-[\r\n]+", " ")
    return F.lower(F.trim(F.regexp_replace(joined, r"(?U)[\s\x1c-\x1f]+", " ")))


def sanitize_markdown(c: Column) -> Column:
    """Line ends to \\n, written-out \\n and \\t to characters, at most one blank line in a row."""
    ends = F.replace(F.replace(_s(c), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    plain = F.replace(F.replace(ends, F.lit("\\n"), F.lit("\n")), F.lit("\\t"), F.lit("\t"))
    return F.regexp_replace(plain, r"\n{3,}", "\n\n")


def normalize_toc(c: Column) -> Column:
    """Each line loses its white space at both ends and one leading marker of digits, dots and dashes, but keeps a character; runs of blank lines become one."""
    blank = r"[\s\x1c-\x1f]"
    bare = F.transform(F.split(F.replace(_s(c), F.lit("\r\n"), F.lit("\n")), "\n", -1), lambda x: F.regexp_replace(x, rf"(?U){blank}+\z", ""))
    lines = F.transform(bare, lambda x: F.regexp_replace(x, rf"(?Uds)^{blank}*[\d.\-]*{blank}*(.+)\z", "$1"))
    text = F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n")
    return F.regexp_replace(text, rf"(?U)^{blank}+|{blank}+\z", "")


def _thousands(found: Column, comma: str) -> Column:
    """A number as digits and a point. Of two kinds of separators the last is the decimal one; the same one again and again parts thousands; a lone point is decimal; a lone comma is what ``comma`` puts in its place."""
    last_point, last_comma = F.length(found) - F.instr(F.reverse(found), "."), F.length(found) - F.instr(F.reverse(found), ",")
    points, commas = (F.length(found) - F.length(F.replace(found, F.lit(x), F.lit(""))) for x in (".", ","))
    without = lambda x: F.replace(found, F.lit(x), F.lit(""))
    return (
        F.when((points > 0) & (commas > 0), F.when(last_point > last_comma, without(",")).otherwise(F.replace(without("."), F.lit(","), F.lit("."))))
        .when(points > 1, without("."))
        .when(commas > 1, without(","))
        .when(found.rlike(r",\d{3}\z"), without(","))
        .otherwise(F.replace(found, F.lit(","), F.lit(comma)))
    )


def first_number(c: Column, first_group_only: bool = False) -> Column:
    """The first number in a text: a lone point is decimal, a lone comma parts thousands, so do repeated separators; a text without a number stays.

    ``first_group_only``: the number ends after its first separator and the digits behind it.
    """
    text = _s(c)
    found = F.regexp_substr(text, F.lit(r"-?\d+(?:[.,]\d+)?" if first_group_only else r"-?\d+(?:[.,]\d+)*"))
    return F.coalesce(F.regexp_replace(_thousands(found, ""), r"^(-?)0+(?=\d)", "$1"), text)


def verified_decimal(c: Column) -> Column:
    """The first number of a text as a decimal; a lone comma parts thousands if three digits follow, else it is the decimal point; null if there is no number."""
    found = F.regexp_substr(_s(c), F.lit(r"-?\d+(?:[.,]\d+)*"))
    return _thousands(found, ".").try_cast("decimal(38,12)")


def verified_int(c: Column) -> Column:
    """All digits of a text as an integer, negative if the text starts with a minus; null without a digit."""
    text = F.trim(_s(c))
    digits = F.regexp_replace(text, "[^0-9]", "")
    return F.when(digits != "", F.concat(F.when(text.startswith("-"), "-").otherwise(""), digits)).try_cast("bigint")


def year_int(c: Column) -> Column:
    """The first year of the 20th or 21st century in a text; null if none."""
    return F.regexp_substr(_s(c), F.lit(r"(19|20)\d{2}")).try_cast("int")


def year_to_date_text(c: Column) -> Column:
    """A four-digit year becomes its first day; other texts stay."""
    return F.when(_s(c).rlike(r"^\d{4}$"), F.concat(_s(c), F.lit("-01-01"))).otherwise(_s(c))


def coerce(c: Column, kind: str, number: Column | None = None) -> Column:
    """A trimmed text as ``kind``; blank or unconvertible gives null (the validator tells them apart).

    Digits may be grouped by commas and underscores. A whole number has no decimals other than zeros. Dates are ISO
    dates, also with slashes, with a time or a Z behind them, or four digits for a year's first day; where the text was a
    JSON ``number``, one from 1 to 9999 is a year. Timestamps with an offset become UTC, others stay as they are, in any
    session; what is no date, or date and time, is none.
    """
    text = F.nullif(F.trim(_s(c)), F.lit(""))
    digits = F.regexp_replace(text, "[,_]", "")
    is_year = text.rlike(r"^\d{4}$")
    if number is not None:
        is_year = is_year | (F.coalesce(number, F.lit(False)) & text.rlike(r"^\d{1,4}$"))
    year = F.when(is_year & (text.try_cast("int") > 0), F.concat(F.lpad(text, 4, "0"), F.lit("-01-01")))
    if kind in ("int", "long"):
        return F.when(digits.rlike(r"^[+-]?\d+(\.0+)?$"), digits).try_cast("decimal(38,12)").try_cast("int" if kind == "int" else "bigint")
    if kind == "decimal":
        return digits.try_cast("decimal(38,12)")
    if kind == "date":
        day = F.regexp_replace(F.substring_index(F.replace(text, F.lit("/"), F.lit("-")), "T", 1), "Z$", "")
        packed = F.when(day.rlike(r"^\d{8}$"), F.regexp_replace(day, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"))
        return F.coalesce(year, packed, F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), day)).try_cast("date")
    if kind == "timestamp":
        stamp = F.replace(text, F.lit("/"), F.lit("-"))
        clock = r"\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?"
        bare = F.when(stamp.rlike(rf"^(?:\d{{4}}-\d{{2}}-\d{{2}}|{clock})$"), stamp)
        # with an offset, the clock less the offset: UTC whatever the session's zone
        zone = rf"^({clock})\s*(?:[Zz]|([+-])(\d{{2}}):?(\d{{2}})?)$"
        hours, minutes = (F.coalesce(F.regexp_extract(stamp, zone, k).try_cast("int"), F.lit(0)) for k in (3, 4))
        east = F.when(F.regexp_extract(stamp, zone, 2) == "-", -1).otherwise(1) * (60 * hours + minutes)
        utc = F.when(stamp.rlike(zone), F.regexp_extract(stamp, zone, 1).try_cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(0), east))
        return F.coalesce(F.coalesce(year, bare).try_cast("timestamp_ntz"), utc)
    if kind == "uuid":
        return F.when(is_uuid(text), canonical_uuid(text))
    return text


def _hex(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(F.trim(_s(c)), r"(?i)^urn:uuid:", ""), r"[{}\-]", ""))


def is_uuid(c: Column) -> Column:
    return F.coalesce(_hex(c).rlike("^[0-9a-f]{32}$"), F.lit(False))


def canonical_uuid(c: Column) -> Column:
    return F.regexp_replace(_hex(c), r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def is_placeholder_uuid(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(_s(c))).startswith(ZERO_PREFIX), F.lit(False))


def uuid5(namespace: uuid.UUID, name: Column) -> Column:
    """Name-based UUID, equal to Python's ``uuid.uuid5``."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(_s(name), "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def class_namespace(name: str) -> uuid.UUID:
    return uuid.uuid5(uuid.UUID(int=0), name)


def content_key(canonical: Column) -> Column:
    """Equality key of a record given as canonical JSON."""
    return F.sha2(canonical, 256)


def table_signature(header: Column, heading_path: Column) -> Column:
    clean = F.lower(F.trim(F.regexp_replace(_s(header), r"(?U)\s+", " ")))
    return F.substring(F.sha1(F.concat(_s(heading_path), F.lit("|"), clean)), 1, 12)


def signature_from_notes(notes: Column, chunk_signatures: Column) -> Column:
    """``table_signature = X`` in a note, else the chunk's only signature; null if it is none of the chunk's."""
    said = F.nullif(F.regexp_extract(_s(notes), r"table_signature\s*=\s*([0-9a-fA-F]+)", 1), F.lit(""))
    found = F.coalesce(said, F.when(F.size(chunk_signatures) == 1, F.get(chunk_signatures, F.lit(0))))
    return F.when(F.array_contains(chunk_signatures, found), found)


def merge_proofs(misc: Column, proofs: Column) -> Column:
    """Adds ``<field>_proof`` entries to a map; keys that exist stay. misc: map<string,string>; proofs: map<field, text>."""
    base = F.coalesce(misc, F.create_map().cast("map<string,string>"))
    named = F.transform_keys(proofs, lambda k, v: F.concat(k, F.lit("_proof")))
    return F.map_concat(base, F.map_filter(named, lambda k, v: ~F.map_contains_key(base, k)))


def split_sentences(c: Column) -> Column:
    """Parts after ``.``, ``!`` or ``?`` that white space or the end follows."""
    return F.filter(F.transform(F.split(_s(c), r"(?<=[.!?])(?U)\s+"), lambda x: F.trim(x)), lambda x: x != "")
