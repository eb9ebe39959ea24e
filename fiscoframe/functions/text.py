"""Text normalisation as native expressions.

Accents are removed with one ``translate`` whose table is derived from the
Unicode database: every character whose decomposition leaves exactly one
non-mark character, plus the marks themselves (deleted).  Characters that expand
to several are replaced first, in the rows that hold any: Hangul syllables by
arithmetic, the others (ligatures, fractions and the like) from a table that is
derived from the same database.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stop-words dropped from search text.
STOP_WORDS = (
    "A", "AS", "O", "OS", "DE", "DA", "DO", "DAS", "DOS", "COM",
    "PARA", "POR", "E", "EM", "NA", "NO", "NAS", "NOS", "UM", "UMA",
)

WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())
_ASCII_SPACES = "[\\t-\\r\\x1c-\\x20]+"
# The Hangul syllables, which all decompose into several letters.
_HANGUL = (0xAC00, 0xD7A3)


def _is_mark(ch: str, form: str) -> bool:
    if form == "NFKD":
        return unicodedata.combining(ch) != 0
    return unicodedata.category(ch) == "Mn"


@cache
def _fold_tables(form: str) -> tuple[str, str, str]:
    """(characters to fold, their replacements, characters that expand)."""
    folded, plain, dropped, expanding = [], [], [], []
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF or _HANGUL[0] <= code <= _HANGUL[1]:
            continue
        ch = chr(code)
        if not unicodedata.decomposition(ch) and not _is_mark(ch, form):
            continue
        bare = "".join(part for part in unicodedata.normalize(form, ch) if not _is_mark(part, form))
        if bare == ch:
            continue
        if not bare:
            dropped.append(ch)
        elif len(bare) == 1:
            folded.append(ch)
            plain.append(bare)
        else:
            expanding.append(ch)
    return "".join(folded + dropped), "".join(plain), "".join(expanding)


@cache
def _expansions(form: str) -> str:
    """What each expanding character folds to, as JSON."""
    bare = {
        ch: "".join(part for part in unicodedata.normalize(form, ch) if not _is_mark(part, form))
        for ch in _fold_tables(form)[2]
    }
    return json.dumps(bare)


def _hangul_letters(ch: Column) -> Column:
    """The two or three letters of a Hangul syllable, by the arithmetic of its code point."""
    rest = F.ascii(ch) - _HANGUL[0]
    first, vowel, last = (F.floor(rest / 588), F.floor(F.pmod(rest, F.lit(588)) / 28), F.pmod(rest, F.lit(28)))
    letter = lambda start, n, at: F.substring(F.lit("".join(chr(start + k) for k in range(n))), at.cast("int") + 1, F.lit(1))
    # without a last letter the table's place 0 is empty: places 1 to 27 follow
    tail = F.when(last > 0, letter(0x11A7, 28, last)).otherwise(F.lit(""))
    return F.concat(letter(0x1100, 19, first), letter(0x1161, 21, vowel), tail)


def _expanded(column: Column, form: str) -> Column:
    """Every expanding character replaced by what it folds to."""
    syllable = f"[\\x{{{_HANGUL[0]:x}}}-\\x{{{_HANGUL[1]:x}}}]"
    characters = _fold_tables(form)[2]
    holds = F.length(F.translate(column, characters, "")) < F.length(column)
    table = F.from_json(F.lit(_expansions(form)), "map<string,string>")

    def one(ch: Column) -> Column:
        is_syllable = (ch >= chr(_HANGUL[0])) & (ch <= chr(_HANGUL[1]))
        # the table is only searched for characters that it holds
        return F.when(is_syllable, _hangul_letters(ch)).when(F.contains(F.lit(characters), ch) & (ch != ""), table[ch]).otherwise(ch)

    return F.when(column.rlike(syllable) | holds, F.array_join(F.transform(F.split(column, ""), one), "")).otherwise(column)


@cache
def _windows_1252() -> str:
    """Characters of the bytes 0x80 to 0x9F in Windows code page 1252, U+FFFD where it has none."""
    return bytes(range(0x80, 0xA0)).decode("cp1252", "replace")


def read_as_windows_1252(column: Column) -> Column:
    """Reads the UTF-8 bytes of a text as code page 1252, as a conversion from that page to UTF-8 does."""
    latin = F.decode(F.encode(column, "UTF-8"), "ISO-8859-1")
    return F.translate(latin, "".join(map(chr, range(0x80, 0xA0))), _windows_1252())


def is_ascii(column: Column) -> Column:
    """Cheap test: as many bytes as characters."""
    return F.length(column) == F.octet_length(column)


def strip_accents(column: Column, form: str = "NFD", spaces: bool = False) -> Column:
    """Decompose and drop combining marks.

    Plain ASCII text is returned as it is.  ``spaces`` also turns every non-ASCII
    white space into a blank.
    """
    source, target, _ = _fold_tables(form)
    if spaces:
        blanks = "".join(ch for ch in WHITESPACE if ord(ch) > 0x7F)
        source, target = blanks + source, " " * len(blanks) + target
    return F.when(is_ascii(column), column).otherwise(F.translate(_expanded(column, form), source, target))


def strip(column: Column) -> Column:
    """Remove all kinds of white space from both ends."""
    return F.btrim(column, F.lit(WHITESPACE))


def normalize(column: Column) -> Column:
    """Accent-free, upper case, stripped; null stays null."""
    return strip(F.upper(strip_accents(column.cast("string"), "NFD")))


def normalize_description(column: Column, empty_to_null: bool = True) -> Column:
    """:func:`normalize` with inner white space collapsed."""
    plain = F.upper(strip_accents(column.cast("string"), "NFD", spaces=True))
    value = F.trim(F.regexp_replace(plain, _ASCII_SPACES, " "))
    return F.nullif(value, F.lit("")) if empty_to_null else value


def bare_letters(column: Column) -> Column:
    """Plain letters and digits of the normalised text; texts that differ in case, accents or blanks alone share them."""
    plain = F.upper(strip_accents(F.upper(F.coalesce(column.cast("string"), F.lit(""))), "NFD"))
    return F.regexp_replace(plain, "[^A-Z0-9]+", "")


def normalize_code(column: Column) -> Column:
    """Normalised code without leading zeros; nothing left means ``0``."""
    stripped = F.ltrim(normalize(column), F.lit("0"))
    return F.when(stripped == "", F.lit("0")).otherwise(stripped)


def remove_dots(column: Column) -> Column:
    """Normalised code without dots."""
    return F.replace(normalize(column), F.lit("."), F.lit(""))


def bare_key(column: Column) -> Column:
    """Join key of the classification lookups: dots removed, then stripped."""
    return strip(F.replace(column.cast("string"), F.lit("."), F.lit("")))


def clean_item_code(column: Column) -> Column:
    """Item code without leading zeros, blanks, dots and dashes."""
    return F.regexp_replace(F.ltrim(column, F.lit("0")), "[ .-]", "")


def normalize_elements(column: Column) -> Column:
    return F.transform(column, lambda v: normalize(v))


def search_text(column: Column) -> Column:
    """Search form of a description: plain letters and digits, stop-words gone.

    Words are separated by single blanks first, so a stop-word is one that has a
    blank on both sides.
    """
    plain = F.upper(strip_accents(F.coalesce(column.cast("string"), F.lit("")), "NFKD"))
    words = F.concat(F.lit(" "), F.regexp_replace(plain, "[^A-Z0-9]+", " "), F.lit(" "))
    return F.trim(F.regexp_replace(words, f"(?<= )(?:{'|'.join(STOP_WORDS)}) ", ""))


def natural_key(column: Column) -> Column:
    """Array key that orders ``9`` before ``10``.

    Digit runs become (length, digits) so that runs of any length compare as
    numbers; a leading digit run is preceded by an empty text part.
    """
    text = F.coalesce(column.cast("string"), F.lit(""))
    parts = F.regexp_extract_all(text, F.lit("([0-9]+|[^0-9]+)"), F.lit(1))

    def encode(part: Column) -> Column:
        digits = F.ltrim(part, F.lit("0"))
        return F.when(
            part.rlike("^[0-9]"), F.concat(F.lpad(F.length(digits).cast("string"), 6, "0"), digits)
        ).otherwise(F.lower(part))

    encoded = F.transform(parts, encode)
    return F.when(text.rlike("^[0-9]"), F.concat(F.array(F.lit("")), encoded)).otherwise(encoded)


def natural_sorted(column: Column) -> Column:
    """Sort a text array in natural order (equal keys by plain text)."""
    keyed = F.transform(column, lambda v: F.struct(natural_key(v).alias("k"), v.alias("v")))
    return F.transform(F.array_sort(keyed), lambda s: s["v"])
