"""Text, number and price rules as Column expressions (no UDFs).

Whitespace follows Unicode (nbsp and friends count), digits are ASCII only.
Every function takes a column or a column name and returns a Column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace (as a class and one by one), symbol ranges removed as emoji, quote marks
# cut from both ends, promo labels that are no status, currency signs in order.
SPACE_CLASS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
EMOJI_CLASS = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F9FF}\x{2600}-\x{26FF}"
    r"\x{2700}-\x{27BF}\x{1FA00}-\x{1FA6F}\x{1FA70}-\x{1FAFF}\x{FE00}-\x{FEFF}]"
)
QUOTE_MARKS = "'\"“”‘’"
PROMO_LABELS = ("listimet e fundit", "te rekomanduara", "featured", "recent listings")
CURRENCY_SIGNS = (("€", "EUR"), ("$", "USD"), ("£", "GBP"))
YES_WORDS = ("po", "yes")
NO_WORDS = ("jo", "no")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(text: Column | str) -> Column:
    return F.nullif(_col(text), F.lit(""))


def strip_space(text: Column | str) -> Column:
    """Trim Unicode whitespace from both ends."""
    return F.btrim(_col(text), F.lit(SPACES))


def clean_text(text: Column | str) -> Column:
    """Drop emoji, collapse whitespace, cut quote marks from both ends; empty is null."""
    without_emoji = F.regexp_replace(_col(text), f"{EMOJI_CLASS}+", "")
    one_spaced = F.regexp_replace(without_emoji, f"{SPACE_CLASS}+", " ")
    return blank_to_null(F.btrim(F.trim(one_spaced), F.lit(QUOTE_MARKS)))


def first_number(text: Column | str) -> Column:
    """First number in the text as a string, comma written as dot."""
    found = F.regexp_extract(_col(text), r"[0-9]+(?:[.,][0-9]+)?", 0)
    return blank_to_null(F.translate(found, ",", "."))


def parse_price(raw: Column | str) -> Column:
    """Price text to double; separators are read by position and group length.

    With both separators the one that comes first groups thousands. With one
    kind only, exactly three characters after its last use mean thousands.
    """
    kept = F.regexp_replace(_col(raw), "[^0-9.,]", "")
    drop = lambda sign: F.replace(kept, F.lit(sign), F.lit(""))
    tail_is_group = lambda sign: F.length(F.substring_index(kept, sign, -1)) == 3
    has_dot, has_comma = F.contains(kept, F.lit(".")), F.contains(kept, F.lit(","))
    plain = (
        F.when(
            has_dot & has_comma,
            F.when(F.instr(kept, ".") < F.instr(kept, ","), F.translate(drop("."), ",", ".")).otherwise(drop(",")),
        )
        .when(has_comma, F.when(tail_is_group(","), drop(",")).otherwise(F.translate(kept, ",", ".")))
        .when(has_dot & tail_is_group("."), drop("."))
        .otherwise(kept)
    )
    return plain.try_cast("double")


def price_currency(raw: Column | str) -> Column:
    """Currency code by the first sign present; the letters ALL come last."""
    text = _col(raw)
    signs = [F.when(F.contains(text, F.lit(sign)), code) for sign, code in CURRENCY_SIGNS]
    return F.coalesce(*signs, F.when(F.contains(F.upper(text), F.lit("ALL")), "ALL"))


def listing_status(value: Column | str) -> Column:
    """Clean the status; promo labels count as missing."""
    status = clean_text(value)
    return F.when(~F.lower(status).isin(*PROMO_LABELS), status)


def yes_no(value: Column | str) -> Column:
    """``Yes``/``No`` from site words, after an optional ``label:`` prefix."""
    text = strip_space(value)
    answer = strip_space(F.substr(text, F.instr(text, ":") + 1))
    word = F.lower(answer)
    return F.when(
        F.length(_col(value)) > 0,
        F.when(word.isin(*YES_WORDS), "Yes").when(word.isin(*NO_WORDS), "No").otherwise(answer),
    )
