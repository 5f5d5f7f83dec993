"""Building delimited records: envelope, sanitising, addresses, multi-value fields."""

from pyspark.sql import functions as F

FIELD_SEPARATOR = "|"
VALUE_SEPARATOR = "~"
TIME_FORMAT = "yyyyMMddHHmmss"


def delimited(*fields):
    """Join fields with ``|``; a null field becomes an empty one, so positions never shift."""
    filled = [F.coalesce(f.cast("string"), F.lit("")) for f in fields]
    return F.concat_ws(FIELD_SEPARATOR, *filled)


def envelope(ip, port, event_time, *payload):
    """``ip|port|yyyyMMddHHmmss|payload``."""
    return delimited(ip, port, F.date_format(event_time, TIME_FORMAT), *payload)


def amount_text(amount):
    """Two decimals; halves of a cent, as the number is written, are rounded away from zero."""
    return F.format_string("%.2f", amount)


def sanitise(text):
    """Blank out the field separator and the line breaks, so that one record stays one line."""
    return F.translate(text, FIELD_SEPARATOR + "\r\n", "   ")


def addresses(header, extract_angle=False):
    """Distinct names or addresses in a header, in order of first appearance.

    A header without ``@`` gives none; one with ``@`` and no space is an address as it stands;
    otherwise its space-separated pieces count, except those with angle brackets. With
    ``extract_angle`` the bracketed addresses are added.
    """
    pieces = F.filter(
        F.split(header, " "), lambda p: ~(p.contains("<") | p.contains(">"))
    )
    if extract_angle:
        bracketed = F.regexp_extract_all(header, F.lit(r"<([^<>\s]+@[^<>\s]+)>"), F.lit(1))
        pieces = F.concat(pieces, bracketed)
    return (
        F.when(~F.coalesce(header.contains("@"), F.lit(False)), F.array().cast("array<string>"))
        .when(~header.contains(" "), F.array(header))
        .otherwise(F.array_distinct(pieces))
    )


def multi_value(values):
    """One ``~``-joined field, sorted so that equal sets give equal text."""
    return F.array_join(F.array_sort(values), VALUE_SEPARATOR)
