"""Humidity / temperature device replies (F7, F8, F9, M10) as column expressions.

A reply looks like ``{H00rdd 1;48.120; %RH;0;-;27.520;  degC;...]``: the payload after
the first space (variant A) or after ``rdd`` (variant B) is split on ';'; field 1 is the
relative humidity and field 5 the temperature.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config
from .text import NUMBER_PATTERN, WS_CHARS, normalise_units

PAYLOAD_STRIP = " ]\r\n"


def latin1_text(raw_bytes) -> Column:
    """Device bytes as text, one character per byte (Latin-1, like the poller)."""
    return F.decode(F.col(raw_bytes) if isinstance(raw_bytes, str) else raw_bytes, "ISO-8859-1")


def _after(text: Column, sep: str) -> Column:
    pos = F.instr(text, sep)
    return F.when(pos > 0, text.substr(pos + len(sep), F.length(text) + 1)).otherwise(text)


def reply_parts(raw, variant: str = "A") -> Column:
    """F7 / F8 + M11: the ';'-separated fields of a reply's payload as an array (untrimmed;
    read single fields with ``reply_field``, which trims -- no per-element lambda)."""
    text = normalise_units(F.col(raw) if isinstance(raw, str) else raw)
    if variant == "A":
        payload = _after(text, " ")
    else:
        payload = F.when(F.instr(text, "rdd") > 0, _after(text, "rdd")).otherwise(_after(text, " "))
    payload = F.trim(payload, F.lit(PAYLOAD_STRIP))
    return F.split(payload, ";")


def reply_field(parts: Column, index: int) -> Column:
    """Field ``index`` (0-based), stripped; null when the reply is shorter."""
    return F.trim(F.try_element_at(parts, F.lit(index + 1)), F.lit(WS_CHARS))


def field_number(parts: Column, index: int) -> Column:
    f = reply_field(parts, index)
    return F.when(f.rlike(NUMBER_PATTERN), f.try_cast("double"))


def dew_point(rh, temp_c, a: float = config.MAGNUS_A, b: float = config.MAGNUS_B) -> Column:
    """Magnus dew point in degC (null outside 0 < RH)."""
    rh = F.col(rh) if isinstance(rh, str) else rh
    t = F.col(temp_c) if isinstance(temp_c, str) else temp_c
    gamma = F.log(rh / 100.0) + (t * a) / (t + b)
    return F.when(rh > 0, (gamma * b) / (F.lit(a) - gamma))

