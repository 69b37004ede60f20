"""Name and label normalisation."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, functions as F

# The characters Python's str.strip() and str.split() treat as blank, as a Java
# regular expression class. It lists everything else, letters first, since that is decided fastest.
BLANK = (
    r"[^\x21-\x84\x00-\x08\x0e-\x1b\x86-\x9f\xa1-\x{167f}\x{1681}-\x{1fff}"
    r"\x{200b}-\x{2027}\x{202a}-\x{202e}\x{2030}-\x{205e}\x{2060}-\x{2fff}\x{3001}-\x{10ffff}]"
)


@dataclass(frozen=True)
class NameRules:
    """Switches of the name normaliser, applied in the order listed."""

    remove_diacritics: bool = True
    lower: bool = True
    strip: bool = True
    remove_trailing_commas: bool = True
    remove_periods: bool = False
    collapse_spaces: bool = True


HANGUL = (0xAC00, 0xD7A3)
SEVERAL = "\1"  # stands for characters that become several; a text that has it is taken apart as well


def strip_marks(text: str) -> str:
    """Compatibility decomposition without the combining marks, for a literal."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


@cache
def mark_tables() -> tuple[str, str, str, str]:
    """What decomposition does to each character, from Python's Unicode data.

    Characters with one character in their place, then those with several, then marks, which go; what
    stands in the place of the former, a mark for several; characters with several in their place; and
    these, parted by zeros. Hangul syllables are left to arithmetic.
    """
    single, gone, several = {}, [], {}
    for code in (*range(0x80, 0xD800), *range(0xE000, 0x110000)):
        if not HANGUL[0] <= code <= HANGUL[1]:
            char = chr(code)
            plain = strip_marks(char)
            if not plain:
                gone.append(char)
            elif plain != char:
                (single if len(plain) == 1 else several)[char] = plain
    target = "".join(single.values()) + SEVERAL * len(several)
    return "".join([*single, *several, *gone]), target, "".join(several), "\0".join(several.values())


def _hangul(char: Column) -> Column:
    """The two or three letters of a syllable; null for any other character."""
    place = F.ascii(char) - HANGUL[0]
    letters = lambda first, n: F.lit("".join(chr(first + k) for k in range(n)))
    part = lambda text, at: F.substr(text, at.cast("int") + 1, F.lit(1))
    lead, vowel = part(letters(0x1100, 19), F.floor(place / 588)), part(letters(0x1161, 21), F.floor(place % 588 / 28))
    tail = F.when(place % 28 == 0, "").otherwise(part(letters(0x11A7, 28), place % 28))
    return F.when(place.between(0, HANGUL[1] - HANGUL[0]), F.concat(lead, vowel, tail))


def without_marks(col: Column) -> Column:
    """Diacritics removed: compatibility decomposition, every character on its own, without combining marks.

    Spark has no such function. It is a translation table made from Unicode data, of constant
    size, which Spark applies by itself; only texts with characters that become several are
    taken apart. ASCII text cannot change.
    """
    source, target, several, parts = mark_tables()

    def expanded(char: Column) -> Column:
        place = F.instr(F.lit(several), char) - 1
        return F.coalesce(F.get(F.split(F.lit(parts), "\0"), place), _hangul(char), char)

    quick = F.translate(col, source, target)
    apart = F.array_join(F.transform(F.regexp_extract_all(col, F.lit("(?s)."), F.lit(0)), expanded), "")
    special = (F.instr(quick, SEVERAL) > 0) | col.rlike(f"[\\x{{{HANGUL[0]:x}}}-\\x{{{HANGUL[1]:x}}}]")
    plain = F.octet_length(col) == F.char_length(col)
    return F.when(plain, col).when(special, F.translate(apart, source, target)).otherwise(quick)


def strip_blank(col: Column) -> Column:
    return F.regexp_replace(col, rf"\A{BLANK}+|{BLANK}+\z", "")


def collapse_blank(col: Column) -> Column:
    """One space for every run of blanks, none at the ends."""
    return F.trim(F.regexp_replace(col, f"{BLANK}+", " "))


def name_key(col: Column, rules: NameRules = NameRules()) -> Column:
    """Comparison form of a person or team name, under configurable rules."""
    if rules.remove_diacritics:
        col = without_marks(col)
    if rules.lower:
        col = F.lower(col)
    if rules.strip and rules.collapse_spaces:
        # blanks can be collapsed first: the ends are then single spaces and cheap to cut
        col = collapse_blank(col)
        if rules.remove_trailing_commas:
            col = F.rtrim(F.rtrim(col, F.lit(",")))
        if rules.remove_periods:
            col = collapse_blank(F.replace(col, F.lit("."), F.lit("")))
        return col
    if rules.strip:
        col = strip_blank(col)
    if rules.remove_trailing_commas:
        col = strip_blank(F.regexp_replace(col, r",+(?=\n?\z)", ""))
    if rules.remove_periods:
        col = F.replace(col, F.lit("."), F.lit(""))
    return collapse_blank(col) if rules.collapse_spaces else col


def plain_name_key(col: Column) -> Column:
    """Comparison form from built-in functions only; diacritics stay."""
    tidy = F.regexp_replace(F.trim(F.lower(col)), r",+$", "")
    return F.regexp_replace(tidy, r"\s+", " ")


def season_label(col: Column) -> Column:
    """``2007/08`` becomes ``2007-08``; numeric seasons become text."""
    return F.translate(col.cast("string"), "/", "-")
