"""SQL text for reading loosely typed JSON payloads held in a variant column."""

from __future__ import annotations

from candlewick.schemas import AMOUNT_SQL

# The characters a text field is stripped of on both ends.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Calendar date, optionally with a time of day and an offset.
_ISO_EXTENDED = (
    r"^\\d{4}-\\d{2}-\\d{2}"
    r"([T ]\\d{2}:\\d{2}(:\\d{2}([.]\\d+)?)?(Z|[+-]\\d{2}(:?\\d{2})?)?)?$"
)
_ISO_BASIC = r"^\\d{8}T\\d{6}$"


def stripped(text: str) -> str:
    return f"btrim({text}, '{WHITESPACE}')"


def field(variant: str, path: str, kind: str = "string") -> str:
    return f"try_variant_get({variant}, '{path}', '{kind}')"


def _decimals(text: str) -> str:
    """Decimals that a number's text needs: those written, less trailing zeros, moved by the exponent."""
    lowered = f"lower({text})"
    written, point = f"substring_index({lowered}, 'e', 1)", f"instr({lowered}, '.')"
    moved = f"if(contains({lowered}, 'e'), try_cast(substring_index({lowered}, 'e', -1) as int), 0)"
    end = f"if({point} > 0, {point}, length({written}))"
    return f"if(translate({written}, '+-.0', '') = '', 0, length(rtrim('0', {written})) - {end} - {moved})"


def number(text: str) -> str:
    """Decimal value of a stripped text, rounded to 18 decimals; null for anything that is not a finite number."""
    return f"try_cast({text} as {AMOUNT_SQL})"


def amount(text: str) -> str:
    """As ``number``, but null for a value with more than 18 decimals, which would be rounded."""
    return f"if({_decimals(text)} <= 18, {number(text)}, null)"


def instant(text: str) -> str:
    """Instant of an ISO-8601 text, taken as UTC where it names no offset."""
    return (
        f"case when {text} rlike '{_ISO_EXTENDED}' then try_cast({text} as timestamp)"
        f" when {text} rlike '{_ISO_BASIC}'"
        f" then try_to_timestamp({text}, \"yyyyMMdd'T'HHmmss\") end"
    )


def epoch_millis(value: str) -> str:
    """Instant of epoch milliseconds within the years 1 to 9999, else null."""
    return (
        f"case when {value} between -62135596800000 and 253402300799999"
        f" then timestamp_millis({value}) end"
    )


def iso(time: str) -> str:
    return f"date_format({time}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx\")"


def is_object(text: str) -> str:
    """Whether a text that parses as JSON is an object."""
    return rf"({text} rlike '^[ \\t\\r\\n]*[{{]')"
