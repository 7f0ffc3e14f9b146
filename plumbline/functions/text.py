"""Text clean-up and label helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LABEL_SEPARATOR = " | "

# The characters Unicode and ASCII count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Markers shown beside a severity, and the one for any other text.
SEVERITY_MARKERS = {"HIGH": "🔴", "MEDIUM": "🟡", "LOW": "🟢"}
OTHER_MARKER = "⚪"


def strip_space(text: Column) -> Column:
    """Drop white space of any kind, line ends included, at both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def strip_fences(text: Column) -> Column:
    """Drop a code fence that opens or closes a response, and the space around; marks inside stay."""
    return strip_space(F.regexp_replace(strip_space(text), "^```(json)?|```$", ""))


def label(*parts: Column) -> Column:
    return F.concat_ws(LABEL_SEPARATOR, *parts)


def label_part(text: Column, position: int) -> Column:
    """The 1-based part of a label built by :func:`label`; NULL if there is none."""
    return F.try_element_at(F.split(text, r" \| "), F.lit(position))


def status_colour(status: Column) -> Column:
    """The colour a check status is shown in."""
    return F.when(status == "PASS", "green").otherwise("red")


def severity_marker(severity: Column) -> Column:
    pairs = [F.lit(item) for pair in SEVERITY_MARKERS.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), severity), F.lit(OTHER_MARKER))


def percent(share: Column) -> Column:
    """``0.3400`` as ``34.00%``."""
    return F.format_string("%.2f%%", share * 100)
