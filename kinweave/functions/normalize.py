"""Normalizers, one per attribute type or subtype.

Each takes a column and returns a column.  A value that is blank after cleaning becomes
NULL, so it can never take part in a match key.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented Latin letters (Latin-1 and Latin Extended-A) and their plain forms, position by
# position: the letter that canonical decomposition leaves, and those that have none.
STROKED = {"ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ħ": "h", "Ħ": "H", "ŧ": "t", "Ŧ": "T", "ı": "i", "ŀ": "l", "Ŀ": "L"}
DECOMPOSED = {c: unicodedata.normalize("NFD", c)[0] for c in map(chr, range(0xC0, 0x180)) if unicodedata.decomposition(c)}
FOLDED = {c: plain for c, plain in DECOMPOSED.items() if plain.isascii()} | STROKED
ACCENTED, PLAIN = "".join(FOLDED), "".join(FOLDED.values())
LIGATURES = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE"}

# Street words and their short forms.
STREET_WORDS = {
    "alley": "aly", "avenue": "ave", "boulevard": "blvd", "circle": "cir", "court": "ct",
    "drive": "dr", "highway": "hwy", "lane": "ln", "parkway": "pkwy", "place": "pl",
    "road": "rd", "square": "sq", "street": "st", "terrace": "ter",
    "apartment": "apt", "suite": "ste",
    "north": "n", "south": "s", "east": "e", "west": "w",
}

# What counts as white space at the ends of a value.
BLANKS = " \t\r\n"

EXTENSION = r"(?i)\s*(?:extension|ext\.?|x)\s*(\d+)\s*$"


def strip_blanks(c: Column) -> Column:
    return F.trim(c, F.lit(BLANKS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip_blanks(c), F.lit(""))


def fold_accents(c: Column) -> Column:
    """Plain letters for accented ones, whether the accent is part of the letter or follows it."""
    out = F.translate(F.regexp_replace(c, r"\p{M}+", ""), ACCENTED, PLAIN)
    for ligature, letters in LIGATURES.items():
        out = F.replace(out, F.lit(ligature), F.lit(letters))
    return out


def norm_text(c: Column) -> Column:
    """Lower case, runs of white space collapsed to one space."""
    return blank_to_null(F.regexp_replace(F.lower(c), r"\s+", " "))


def _words(c: Column) -> Column:
    """Lower-case words of letters and digits, one space apart."""
    plain = F.regexp_replace(F.lower(fold_accents(c)), r"['’.]", "")
    return F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " "))


def norm_name(c: Column) -> Column:
    return F.nullif(_words(c), F.lit(""))


def norm_email(c: Column) -> Column:
    email = F.lower(strip_blanks(c))
    return F.when(email.rlike(r"^[^@\s]+@[^@\s]+$"), email)


def email_user(c: Column) -> Column:
    return F.split_part(norm_email(c), F.lit("@"), F.lit(1))


def email_domain(c: Column) -> Column:
    return F.split_part(norm_email(c), F.lit("@"), F.lit(2))


def norm_phone(c: Column) -> Column:
    """Digits without extension; a leading 1 of eleven digits is dropped."""
    digits = F.regexp_replace(F.regexp_replace(c, EXTENSION, ""), r"[^0-9]", "")
    national = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10))
    return F.nullif(F.coalesce(national, digits), F.lit(""))


def phone_country(c: Column) -> Column:
    """Country code of a number that starts with `+`, where its end can be told."""
    spaced = F.regexp_extract(c, r"^\s*\+\s*(\d{1,3})[\s(.\-]", 1)
    run_on = F.regexp_extract(c, r"^\s*\+(1)\d{10}\s*$", 1)
    return F.coalesce(F.nullif(spaced, F.lit("")), F.nullif(run_on, F.lit("")))


def phone_ext(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, EXTENSION, 1), F.lit(""))


def norm_address(c: Column) -> Column:
    """Lower-case words with street words shortened."""
    pairs = [F.lit(part) for pair in STREET_WORDS.items() for part in pair]
    short = F.create_map(*pairs)
    words = F.transform(
        F.split(_words(c), " "), lambda w: F.coalesce(F.try_element_at(short, w), w)
    )
    return F.nullif(F.array_join(words, " "), F.lit(""))


def house_number(c: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(c, r"^\s*(\d+[A-Za-z]?)(?:\s|,|$)", 1)), F.lit(""))


def street_name(c: Column) -> Column:
    """The normalized address without its house number."""
    return F.nullif(F.regexp_replace(norm_address(c), r"^\d+[a-z]?(?:\s+|$)", ""), F.lit(""))


def po_box(c: Column) -> Column:
    return F.nullif(
        F.upper(F.regexp_extract(c, r"(?i)\bp\.?\s*o\.?\s*box\s+#?\s*([0-9A-Za-z]+)", 1)), F.lit("")
    )


def norm_postal(c: Column) -> Column:
    """Letters and digits; of a US code of nine digits the first five."""
    code = norm_id(c)
    return F.when(code.rlike(r"^\d{9}$"), F.substring(code, 1, 5)).otherwise(code)


def split_full_name(c: Column) -> Column:
    """Struct of first, middle and last name; `Last, First` order is understood."""
    ordered = F.regexp_replace(strip_blanks(c), r"^([^,]+),\s*(.+)$", "$2 $1")
    parts = F.filter(F.split(ordered, r"\s+"), lambda p: p != "")
    count = F.size(parts)
    return F.struct(
        F.try_element_at(parts, F.lit(1)).alias("first"),
        F.when(count > 2, F.array_join(F.slice(parts, F.lit(2), F.greatest(count - 2, F.lit(0))), " "))
        .alias("middle"),
        F.when(count > 1, F.try_element_at(parts, F.lit(-1))).alias("last"),
    )


def norm_date(c: Column, *formats: str) -> Column:
    """Timestamp without zone; tries the ISO form, then `formats`; NULL when none fits."""
    text = strip_blanks(c.cast("string"))
    tries = [text.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def norm_number(c: Column) -> Column:
    return strip_blanks(c.cast("string")).try_cast("double")


def norm_id(c: Column) -> Column:
    return F.nullif(F.upper(F.regexp_replace(c, r"[^0-9A-Za-z]", "")), F.lit(""))


def norm_url(c: Column) -> Column:
    """Scheme and host in lower case, no fragment, no trailing slash."""
    bare = F.regexp_replace(strip_blanks(c), r"#.*$", "")
    origin = F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?]*)", 1)
    rest = F.substr(bare, F.length(origin) + F.lit(1))
    return F.nullif(F.regexp_replace(F.concat(F.lower(origin), rest), r"/+$", ""), F.lit(""))


# Which normalizer an attribute gets: the subtype decides first, then the type.
BY_SUBTYPE = {
    "FIRST": norm_name, "LAST": norm_name, "FIRST_NAME": norm_name, "MIDDLE_NAME": norm_name,
    "LAST_NAME": norm_name, "FULL_NAME": norm_name, "NAME": norm_name, "CARE_OF": norm_name,
    "CITY": norm_name, "STATE": norm_name, "COUNTRY": norm_name,
    "STREET": norm_address, "STREET_NAME": norm_address, "ADDRESS_FULL": norm_address,
    "ADDRESS_LINE1": norm_address, "ADDRESS_LINE2": norm_address, "ADDRESS_LINE3": norm_address,
    "HOUSE_NUMBER": house_number, "PO_BOX_NUMBER": po_box,
    "POSTAL_CODE": norm_postal, "ZIP": norm_postal,
    "PHONE_NUMBER": norm_phone, "MOBILE": norm_phone, "HOME": norm_phone, "WORK": norm_phone,
    "EMAIL_USER": email_user, "EMAIL_DOMAIN": email_domain,
    "SSN": norm_id, "PROVIDER_ID": norm_id, "DOB": norm_date,
}
BY_TYPE = {
    "TEXT": norm_text, "NAME": norm_name, "EMAIL": norm_email, "PHONE_NUMBER": norm_phone,
    "ADDRESS": norm_address, "DATE": norm_date, "NUMBER": norm_number, "URL": norm_url,
    "PERSON_IDENTIFIER": norm_id, "ACCOUNT_NUMBER": norm_id,
}


def normalizer(type_: str, subtype: str = "NONE"):
    return BY_SUBTYPE.get(subtype) or BY_TYPE[type_]
