"""Identifiers and classification codes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.nested import pair_value, parse_pair_lists
from lectern.functions.text import as_column, bind, join_list, split_list, strip


def clean_isbn(value) -> Column:
    return F.upper(F.regexp_replace(F.coalesce(as_column(value), F.lit("")), "[^0-9Xx]", ""))


def weighted_digit_sum(number: Column, positions: int) -> Column:
    """Digits of a whole number of ``positions`` places, weighted 1,3,1,3... from the left.

    ``number`` should be a plain column or a bound value: it is mentioned once per place.
    """
    digits = [F.call_function("div", number, F.lit(10 ** (positions - place))) % 10 for place in range(1, positions + 1)]
    return reduce(lambda total, digit: total + digit, digits[0::2]) + 3 * reduce(
        lambda total, digit: total + digit, digits[1::2])


def check_digit(first_twelve) -> Column:
    number = as_column(first_twelve).try_cast("bigint")
    return bind(number, lambda value: (10 - weighted_digit_sum(value, 12) % 10) % 10)


def is_isbn13(value) -> Column:
    """Thirteen digits whose weighted sum, check digit included, is a multiple of ten."""
    number = bind(clean_isbn(value), lambda code: F.when(code.rlike("^[0-9]{13}$"), code.try_cast("bigint")))
    return bind(number, lambda whole: F.coalesce(weighted_digit_sum(whole, 13) % 10 == 0, F.lit(False)))


def has_book_prefix(value) -> Column:
    """The shallow check: length 13 and prefix 978 or 979."""
    column = F.coalesce(as_column(value), F.lit(""))
    return (F.length(column) == 13) & F.substring(column, 1, 3).isin("978", "979")


def printable(value) -> Column:
    """Text with everything outside printable ASCII written as UTF-8 hex escapes."""
    def show(ch: Column) -> Column:
        return F.when(ch.rlike("^[ -~]$"), ch).otherwise(F.concat(F.lit("\\x"), F.hex(F.encode(ch, "UTF-8"))))
    column = as_column(value)
    spelled = F.array_join(F.transform(F.split(column, ""), show), "")
    return F.when(column.rlike("[^ -~]"), spelled).otherwise(column)


def fallback_identifier(electronic, printed) -> Column:
    return F.coalesce(as_column(electronic), as_column(printed))


def fallback_format(electronic, label: str) -> Column:
    return F.when(as_column(electronic).isNotNull(), F.lit(label))


# --- classification codes -------------------------------------------------------------------


def _is_subject(code: Column) -> Column:
    """A BISAC subject: three capitals and six digits."""
    return code.rlike("^[A-Z]{3}[0-9]{6}$")


def _is_thema(code: Column) -> Column:
    """A THEMA code: up to six capitals and digits."""
    return code.rlike("^[A-Z0-9]{1,6}$")


def _present(items: Column) -> Column:
    return F.filter(items, lambda item: item.isNotNull())


def _opened(text: Column) -> Column:
    """The text without one opening bracket."""
    return F.when(F.startswith(text, F.lit("[")), F.substring(text, F.lit(2), F.length(text))).otherwise(text)


def _bracketed(text: Column) -> Column:
    """What stands between each ``[`` and the next ``]``."""
    parts = F.split(text, r"\[")
    closed = F.filter(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda part: F.contains(part, F.lit("]")))
    return F.transform(closed, lambda part: F.substring_index(part, "]", 1))


def _subject_at_start(text: Column) -> Column:
    code = F.left(text, F.lit(9))
    return F.when(_is_subject(code), code)


def bisac_list(value) -> Column:
    """Subjects that begin the items of a list, in brackets or not."""
    items = F.split(as_column(value), ";")
    return join_list(_present(F.transform(items, lambda item: _subject_at_start(_opened(item)))))


def bisac_unread(value) -> Column:
    """The items of a list that hold something but do not begin with a subject: what ``bisac_list`` leaves out."""
    items = F.split(as_column(value), ";")
    left = F.filter(items, lambda item: (strip(item) != "") & _subject_at_start(_opened(item)).isNull())
    return F.transform(left, strip)


def bisac_before_arrow(value) -> Column:
    """The subject that stands alone before the first ``>``."""
    text = as_column(value)
    head = F.rtrim(F.substring_index(text, ">", 1))
    return F.when(F.contains(text, F.lit(">")) & _is_subject(head), head)


def bisac_in_pairs(value) -> Column:
    """The codes of a serialised list of objects."""
    return join_list(_present(F.transform(parse_pair_lists(value), lambda pairs: pair_value(pairs, "code"))))


def thema_brackets(value) -> Column:
    """The bracketed code of each item of a list."""
    items = F.split(as_column(value), ";")
    first = F.transform(items, lambda item: F.get(F.filter(_bracketed(item), lambda code: code.rlike("^[A-Z0-9]+$")), 0))
    return join_list(_present(first))


def thema_mixed(value) -> Column:
    """Codes of the first bracket, then codes written before ``>`` that the bracket lacks."""
    text = strip(as_column(value))
    listed = F.get(F.filter(_bracketed(text), lambda inside: inside.rlike("^[A-Z0-9;]+$")), 0)
    bracket = F.filter(split_list(listed), _is_thema)
    heads = F.transform(split_list(text), lambda part: strip(F.substring_index(part, ">", 1)))
    extra = F.filter(F.array_distinct(heads), lambda code: _is_thema(code) & ~F.array_contains(bracket, code))
    return join_list(F.concat(bracket, extra))


def _class_number(text: Column, before: str = "") -> Column:
    """The first three digits in a row, with a fraction if a point and digits follow; a longer run gives its first three."""
    return F.nullif(F.regexp_extract(text, before + "([0-9]{3}([.][0-9]+)?)", 1), F.lit(""))


def dewey_list(value) -> Column:
    """The first class number of each item of a list."""
    items = F.split(as_column(value), ";")
    return join_list(_present(F.transform(items, lambda item: _class_number(item))))


def dewey_leading(value) -> Column:
    """The class number that begins the text, in brackets or not."""
    return _class_number(as_column(value), r"^\s*\[?")


def doi_from_url(value) -> Column:
    """The path of an address whose host ends in ``.org``."""
    text = as_column(value)
    address = F.when(F.contains(text, F.lit("://")), F.substring_index(text, "://", -1)).otherwise(text)
    host = F.substring_index(address, "/", 1)
    path = F.substring(address, F.length(host) + 2, F.length(address))
    return F.when(F.endswith(host, F.lit(".org")), F.nullif(path, F.lit("")))
