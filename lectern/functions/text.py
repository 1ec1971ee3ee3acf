"""Text cleaning as column expressions.

Everything stays inside the JVM. The two accent-folding functions are character
maps generated from the Unicode database when the module is imported; rows that
are plain ASCII skip the map.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as text files and spreadsheets use it: Unicode White_Space plus the four
# ASCII separators U+001C..U+001F.
SPACE = r"(?U)[\s\x1c-\x1f]"
SPACE_CHARACTERS = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())
NON_ASCII = r"[^\x00-\x7f]"


def as_column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bind(value, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it.

    Optimizer rules that merge projections and push filters copy an expression to every
    mention; a lambda variable is not copied.
    """
    return F.get(F.transform(F.array(as_column(value)), use), F.lit(0))


def strip(value) -> Column:
    return F.btrim(as_column(value), F.lit(SPACE_CHARACTERS))


def blank_to_null(value) -> Column:
    column = as_column(value)
    return F.when(strip(column) != "", column)


def is_blank(value) -> Column:
    """Present but empty or whitespace only; NULL is not blank."""
    column = as_column(value)
    return column.isNotNull() & (strip(column) == "")


def or_sentinel(value, sentinel: str) -> Column:
    return F.coalesce(blank_to_null(value), F.lit(sentinel))


def _single_blanks(text: Column) -> Column:
    """Runs of whitespace as one blank; plain text with single blanks needs no rewriting."""
    return F.when(text.rlike("  |[^ -~]"), F.regexp_replace(text, SPACE + "+", " ")).otherwise(text)


def collapse_spaces(value) -> Column:
    """One space between words, none at the ends; NULL becomes empty."""
    return bind(strip(F.coalesce(as_column(value), F.lit(""))), _single_blanks)


# --- accent folding ------------------------------------------------------------------------


def _is_hangul(code: int) -> bool:
    return 0xAC00 <= code <= 0xD7A3


def _fold_nfkd(ch: str) -> str:
    parts = "".join(part for part in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(part))
    # what has no ASCII letter or digit becomes a separator anyway
    return parts if not parts or any(part.isascii() and part.isalnum() for part in parts) else ch


def _fold_nfd(ch: str) -> str:
    return "".join(part for part in unicodedata.normalize("NFD", ch) if unicodedata.category(part) != "Mn")


# no character of the planes between these has case, marks or a decomposition
CASED_OR_COMPOSED = [*range(0x80, 0x32400), *range(0xE0000, 0xE0200)]

FOLDS = {"comparison": _fold_nfkd, "marks": _fold_nfd, "case": str.casefold}


@lru_cache(maxsize=None)
def _fold_map(form: str) -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Characters that change under a fold (Hangul syllables apart).

    Returns source and target strings for ``translate`` (sources past the end of the
    target are deleted) and the few characters that grow into several.
    """
    fold = FOLDS[form]
    changed = [
        (chr(code), fold(chr(code))) for code in CASED_OR_COMPOSED
        if not _is_hangul(code) and fold(chr(code)) != chr(code)
    ]
    one_to_one = [(ch, folded) for ch, folded in changed if len(folded) == 1]
    deleted = [ch for ch, folded in changed if not folded]
    growing = tuple((ch, folded) for ch, folded in changed if len(folded) > 1)
    source = "".join(ch for ch, _ in one_to_one) + "".join(deleted)
    return source, "".join(folded for _, folded in one_to_one), growing


def _character_class(codes, gap: int = 8) -> str:
    """Few ranges that cover the code points; it may cover neighbours too, so it only guards."""
    ranges: list[list[int]] = []
    for code in sorted(codes):
        if ranges and code - ranges[-1][1] <= gap:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{low:x}}}-\\x{{{high:x}}}" for low, high in ranges) + "]"


def _expand(value: Column, growing: tuple[tuple[str, str], ...]) -> Column:
    """Replace the characters that fold into several, only in rows that hold one."""
    if not growing:
        return value
    keys = F.split(F.lit("\t".join(ch for ch, _ in growing)), "\t")
    values = F.split(F.lit("\t".join(folded for _, folded in growing)), "\t")
    table = F.map_from_arrays(keys, values)
    holds_one = _character_class(ord(ch) for ch, _ in growing)
    spelled = F.array_join(
        F.transform(F.split(value, ""), lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), ""
    )
    return F.when(value.rlike(holds_one), spelled).otherwise(value)


def _fold(value: Column, form: str) -> Column:
    source, target, growing = _fold_map(form)
    folded = F.translate(_expand(value, growing), source, target)
    return F.when(value.rlike(NON_ASCII), folded).otherwise(value)


ASCII_SEPARATORS = "".join(chr(code) for code in range(0x80) if not chr(code).isalnum())


def _ascii_words(text: Column) -> Column:
    """ASCII text with each run of separators as one blank; the regular expression takes many times as long."""
    blanks = F.translate(text, ASCII_SEPARATORS, " " * len(ASCII_SEPARATORS))
    # no bracket is left, so each run of blanks is one pair of brackets after the second step
    pairs = F.replace(F.replace(blanks, F.lit(" "), F.lit("<>")), F.lit("><"), F.lit(""))
    return F.replace(pairs, F.lit("<>"), F.lit(" "))


def normalize_text(value) -> Column:
    """Comparison form: no accents, ASCII letters and digits, single spaces, lower case."""
    column = F.coalesce(as_column(value), F.lit(""))
    folded = F.regexp_replace(_fold(column, "comparison"), "[^a-zA-Z0-9]+", " ")
    return F.lower(F.trim(F.when(column.rlike(NON_ASCII), folded).otherwise(_ascii_words(column))))


def _spell_hangul(value: Column) -> Column:
    """Canonical decomposition of Hangul syllables, which is arithmetic on the code point."""
    lead = F.array(*[F.lit(chr(0x1100 + i)) for i in range(19)])
    vowel = F.array(*[F.lit(chr(0x1161 + i)) for i in range(21)])
    tail = F.array(F.lit(""), *[F.lit(chr(0x11A8 + i)) for i in range(27)])

    def spell(ch: Column) -> Column:
        index = F.ascii(ch) - F.lit(0xAC00)
        letters = F.concat(
            F.get(lead, F.floor(index / 588).cast("int")),
            F.get(vowel, F.floor((index % 588) / 28).cast("int")),
            F.get(tail, (index % 28).cast("int")),
        )
        return F.when((index >= 0) & (index < 11172), letters).otherwise(ch)

    spelled = F.array_join(F.transform(F.split(value, ""), spell), "")
    return F.when(value.rlike("[가-힣]"), spelled).otherwise(value)


def fold_marks(value) -> Column:
    """Trimmed, lower case, canonical decomposition without marks; punctuation stays."""
    column = F.lower(strip(F.coalesce(as_column(value), F.lit(""))))
    return bind(column, lambda text: F.when(
        text.rlike(NON_ASCII), _spell_hangul(_fold(text, "marks"))).otherwise(text))


# --- delimited cells ---------------------------------------------------------------------------


def split_list(value) -> Column:
    """``a; b;;c`` -> [a, b, c]: trimmed, empties dropped; NULL -> []."""
    pieces = F.transform(F.split(F.coalesce(as_column(value), F.lit("")), ";"), strip)
    return F.filter(pieces, lambda item: item != "")


def split_plain(value) -> Column:
    """``a;b;;c`` -> [a, b, c] without trimming the pieces."""
    return F.filter(F.split(F.coalesce(as_column(value), F.lit("")), ";"), lambda item: item != "")


def join_list(items) -> Column:
    """Back to one cell; an empty list is NULL."""
    return F.nullif(F.array_join(as_column(items), ";"), F.lit(""))


def tidy_delimiters(value) -> Column:
    """``|`` becomes ``;``, no blanks at the ends or around ``;``."""
    pieces = F.split(F.replace(as_column(value), F.lit("|"), F.lit(";")), ";")
    return F.array_join(F.transform(pieces, strip), ";")


def drop_parentheses(value) -> Column:
    return strip(F.regexp_replace(as_column(value), r"\([^)]*\)", ""))


def distinct_items(value) -> Column:
    """Items of a cell once each, first-seen order; NULL when none is left."""
    return join_list(F.array_distinct(split_list(value)))


def _caseless(item: Column) -> Column:
    """Comparison form of a trimmed item."""
    return F.lower(F.when(item.rlike(NON_ASCII), _fold(_single_blanks(item), "case")).otherwise(_single_blanks(item)))


def items_not_in(value, other) -> Column:
    """Items of ``value`` that are not items of ``other``, ignoring case and blanks."""
    taken = F.transform(split_list(other), _caseless)
    return bind(taken, lambda others: join_list(
        F.filter(split_list(value), lambda item: ~F.array_contains(others, _caseless(item)))))


# --- small rewrites ------------------------------------------------------------------------------


def drop_decimal_zero(value) -> Column:
    """Identifiers that a spreadsheet stored as numbers: ``978...0`` + ``.0``."""
    return F.regexp_replace(strip(value), r"\.0$", "")


def natural_name(value) -> Column:
    """``Last, First`` -> ``First Last``; names without a comma stay."""
    column = as_column(value)
    parts = F.split(column, ",")
    turned = F.concat(strip(F.get(parts, 1)), F.lit(" "), strip(F.get(parts, 0)))
    return F.when(F.contains(column, F.lit(",")), turned).otherwise(column)


def full_title(title, subtitle) -> Column:
    return F.concat_ws(": ", as_column(title), as_column(subtitle))


def search_title(value) -> Column:
    """The main title: before the first colon, then before the first full stop."""
    return strip(F.substring_index(F.substring_index(as_column(value), ":", 1), ".", 1))
