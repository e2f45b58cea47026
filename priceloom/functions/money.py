"""Amounts in Turkish and English notation: parsing, scanning and formatting, as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bind

#: Fixed value: an amount with a currency mark before or after it. The grouped form is tried first and cuts ungrouped numbers
#: after three digits; results depend on that.
AMOUNT = r"(?:₺|TL)?\s*(\d{1,3}(?:[.\s]\d{3})*(?:[.,]\d{1,2})?|\d+(?:[.,]\d{1,2})?)\s*(?:₺|TL)?"
LEAST, MOST = 1.0, 100_000.0
#: Amounts whose thousands are grouped by dots, and by commas.
DOTS, COMMAS = r"^\d{1,3}(\.\d{3})+(,\d+)?$", r"^\d{1,3}(,\d{3})+(\.\d+)?$"


def parse_money(token: Column) -> Column:
    """The amount of a token, or null if it is none or outside 1 to 100,000.

    Groups of three digits behind dots or commas are thousands. Else, of two kinds of separators the later is the decimal one, and
    a comma alone is decimal before at most two digits. A dot alone is decimal.
    """
    return bind(F.regexp_replace(token, r"^\s+|\s+$|₺|TL|tl|\u00a0| ", ""), _amount)


def _amount(raw: Column) -> Column:
    no_dots = F.translate(F.replace(raw, F.lit("."), F.lit("")), ",", ".")
    no_commas = F.replace(raw, F.lit(","), F.lit(""))
    comma, dot = raw.contains(","), raw.contains(".")
    last = lambda mark: F.length(raw) - F.locate(mark, F.reverse(raw))
    number = (
        F.when(raw.rlike(DOTS), no_dots)
        .when(raw.rlike(COMMAS), no_commas)
        .when(comma & dot, F.when(last(",") > last("."), no_dots).otherwise(no_commas))
        .when(comma, F.when(F.length(F.substring_index(raw, ",", -1)) <= 2, no_dots).otherwise(no_commas))
        .otherwise(raw)
    )
    value = bind(number, lambda n: F.when(n.rlike(r"^[0-9]+([.][0-9]*)?$|^[.][0-9]+$"), n.try_cast("double")))
    return bind(value, lambda v: F.when(v.between(LEAST, MOST), v))


def scan_money(text: Column) -> Column:
    """All amounts in a text, in order."""
    found = F.regexp_extract_all(F.translate(text, "\u00a0", " "), F.lit("(?iuU)" + AMOUNT), F.lit(1))
    return F.filter(F.transform(found, parse_money), lambda x: x.isNotNull())


def format_tl(amount: Column) -> Column:
    """Whole liras, half to even, dots between thousands."""
    return F.translate(F.format_number(amount, 0), ",", ".")


def format_range(low: Column, high: Column) -> Column:
    """One amount if both differ by less than half a lira, else the range; null without amounts."""
    one = F.concat(format_tl(low), F.lit(" TL"))
    return F.when(F.abs(high - low) < 0.5, one).otherwise(F.concat(format_tl(low), F.lit(" – "), format_tl(high), F.lit(" TL")))


def range_of(amounts: Column) -> Column:
    """format_range over an array of amounts."""
    return F.when(F.size(amounts) > 0, format_range(F.array_min(amounts), F.array_max(amounts)))
