"""Column functions over fetch responses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lookup import let

# Longest header value kept; months; named zones of mail dates (hours).
MAX_HEADER_CHARS = 500
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
ZONES = {"ast": -4, "adt": -3, "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7}

_MAIL = r"(?i)^(?:[a-z]+,\s*)?(\d{1,2})[ -]([a-z]{3})[a-z]*[ -](\d{4}|\d{2})\s+(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?\s*([a-z]+|[+-]\d{4})?\s*$"
_CTIME = r"(?i)^[a-z]{3}\s+([a-z]{3})\s+(\d{1,2})\s+(\d{1,2}):(\d{1,2}):(\d{1,2})\s+(\d{4})\s*$"


def http_date(value) -> Column:
    """SC-18: an HTTP date (mail form, its older form with hyphens, or ctime) as a UTC
    timestamp; NULL if it isn't one. No zone, or an unknown one, counts as UTC."""
    v = F.trim(F.col(value) if isinstance(value, str) else value)

    def number(text: Column) -> Column:
        return F.nullif(text, F.lit("")).cast("int")

    def part(p: str, i: int) -> Column:
        return F.regexp_extract(v, p, i)

    def month(text: Column) -> Column:
        return F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(text)).cast("int"), F.lit(0))

    def year(y: Column) -> Column:
        return F.when(y > 99, y).when(y > 68, y + 1900).otherwise(y + 2000)

    def offset(zone: Column) -> Column:
        named = F.lit(0)
        for name, hours in ZONES.items():
            named = F.when(F.lower(zone) == name, hours * 60).otherwise(named)
        minutes = number(F.substring(zone, 2, 2)) * 60 + number(F.substring(zone, 4, 2))
        return F.when(zone.startswith("+"), minutes).when(zone.startswith("-"), -minutes).otherwise(named)

    zero = F.lit(0)
    mail = F.try_make_timestamp(year(number(part(_MAIL, 3))), month(part(_MAIL, 2)), number(part(_MAIL, 1)), number(part(_MAIL, 4)),
                                number(part(_MAIL, 5)), F.coalesce(number(part(_MAIL, 6)), zero), F.lit("UTC"))
    ctime = F.try_make_timestamp(number(part(_CTIME, 6)), month(part(_CTIME, 1)), number(part(_CTIME, 2)), number(part(_CTIME, 3)),
                                 number(part(_CTIME, 4)), number(part(_CTIME, 5)), F.lit("UTC"))
    return F.coalesce(mail - F.make_dt_interval(mins=offset(part(_MAIL, 7))), ctime)


def iso_utc(ts) -> Column:
    """A timestamp as ISO text in UTC (the session's zone is UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def header_text(value) -> Column:
    """SC-19: a header value, stripped and cut to its longest length; NULL when empty."""
    v = F.col(value) if isinstance(value, str) else value
    return F.nullif(F.substring(F.regexp_replace(v, r"(?U)^\s+|\s+$", ""), 1, MAX_HEADER_CHARS), F.lit(""))


def is_redirect(hops) -> Column:
    """SC-19: redirect flag from the hop count (NULL counts as none)."""
    h = F.col(hops) if isinstance(hops, str) else hops
    return F.coalesce(h, F.lit(0)) > 0


def fail_reason(error_type, status, message) -> Column:
    """SC-20: normalised reason of a failed fetch: ``HttpError <status>``, ``IgnoreRequest
    <message>`` (a download over the size bound always reads the same, so reasons stay few),
    else the error's type."""
    kind, code, text = (F.col(c) if isinstance(c, str) else c for c in (error_type, status, message))
    over = F.lit("exceeded DOWNLOAD_MAXSIZE")

    def ignored(reason: Column) -> Column:
        return F.when(reason.contains("exceeded DOWNLOAD_MAXSIZE"), F.concat(F.lit("IgnoreRequest "), over)).otherwise(reason)

    return (F.when(kind == "HttpError", F.concat(F.lit("HttpError "), F.coalesce(code.cast("string"), F.lit("None"))))
            .when(kind == "IgnoreRequest", let(F.concat(F.lit("IgnoreRequest "), F.coalesce(text, F.lit(""))), ignored))
            .otherwise(kind))
