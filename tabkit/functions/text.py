"""Text expressions: strip, percentages, age ranges, numbers, markup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters stripped from both ends of a word.
WORD_STRIP_CHARS = ".,;:!?\"'"

# What counts as a percentage, an age range and a number inside a sentence.
PERCENT = r"(\d+(?:\.\d+)?)%"
AGE_RANGE = r"aged (\d+)–(\d+)"
NUMBER = r"(\d+)"


def str_strip(text: Column, chars: str | None = None) -> Column:
    """Remove spaces, or the given characters, from both ends."""
    return F.trim(text) if chars is None else F.btrim(text, F.lit(chars))


def _group(text: Column, pattern: str, group: int) -> Column:
    found = F.regexp_extract(text, pattern, group)
    return F.when(found != "", found)


def extract_percentage(text: Column) -> Column:
    """First percentage as a double, NULL without one."""
    return _group(text, PERCENT, 1).try_cast("double")


def extract_age_range(text: Column) -> Column:
    """Struct (lo, hi) of the first "aged a–b", NULL without one."""
    lo = _group(text, AGE_RANGE, 1).try_cast("int")
    hi = _group(text, AGE_RANGE, 2).try_cast("int")
    return F.when(lo.isNotNull() & hi.isNotNull(), F.struct(lo.alias("lo"), hi.alias("hi")))


def extract_numbers(text: Column) -> Column:
    """All whole numbers in order of appearance."""
    return F.transform(F.regexp_extract_all(text, F.lit(NUMBER), F.lit(1)), lambda s: s.try_cast("bigint"))


# Named character entities and their characters.
ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”",
    "hellip": "…", "bull": "•", "middot": "·", "copy": "©", "reg": "®", "trade": "™", "deg": "°", "plusmn": "±", "times": "×", "divide": "÷",
    "frac12": "½", "sect": "§", "para": "¶", "laquo": "«", "raquo": "»", "cent": "¢", "pound": "£", "yen": "¥", "euro": "€", "le": "≤", "ge": "≥",
    "ne": "≠", "larr": "←", "rarr": "→", "szlig": "ß", "auml": "ä", "ouml": "ö", "uuml": "ü", "eacute": "é", "egrave": "è", "agrave": "à", "ntilde": "ñ",
    "ensp": " ", "emsp": " ", "thinsp": " ", "shy": "", "amp": "&",
}
REFERENCE = r"&(?:[A-Za-z][A-Za-z0-9]*|#[xX][0-9A-Fa-f]{1,6}|#[0-9]{1,7});"


def _character(reference: Column) -> Column:
    """The character of a reference; one that names none stays, and so does a no-break space, by its name."""
    hexadecimal = F.lower(F.substring(reference, 3, 1)) == "x"
    digits = F.regexp_extract(reference, r"(?i)&#x?([0-9a-f]+);", 1)
    code = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")
    real = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    safe = F.when(real, code).otherwise(F.lit(32))
    numeric = F.when(code == 0xA0, F.lit("&nbsp;")).when(real, F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")).otherwise(reference)
    names = F.create_map(*[F.lit(x) for name, char in ENTITIES.items() for x in (f"&{name};", char)])
    return F.when(reference.startswith("&#"), numeric).otherwise(F.coalesce(names[reference], reference))


def decode_entities(text: Column) -> Column:
    """Numeric references and the named ones of ``ENTITIES`` as characters, each decoded once; no-break spaces stay as their reference.

    The text is cut at its references and put together again with their characters; a text without an ampersand is not looked at.
    """
    between = F.split(text, REFERENCE, -1)
    characters = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)), _character)
    whole = F.array_join(F.zip_with(between, characters, lambda a, c: F.concat(a, F.coalesce(c, F.lit("")))), "")
    return F.when(text.contains("&"), whole).otherwise(text)


# Signs that a text is not clean yet.
UNCLEAN = "[<&\\t\\r\\n\u00a0]|  |^ | $"


def strip_markup(html: Column) -> Column:
    """Text content: comments and tags removed, entities decoded, white space collapsed, no-break spaces dropped."""
    text = decode_entities(F.regexp_replace(html, r"(?s)<!--.*?-->|<[^>]*>", ""))
    text = F.trim(F.regexp_replace(text, r"[ \t\r\n]+", " "))
    return F.when(html.rlike(UNCLEAN), F.regexp_replace(text, "&nbsp;|\u00a0", "")).otherwise(html)
