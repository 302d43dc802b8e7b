"""String column expressions.

All functions map ``Column -> Column`` and use built-in expressions only, so they stay
inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config

# Whitespace removed by strip(): the characters Python's str.isspace() accepts.  Spark's
# one-argument trim() only removes U+0020, so every "trim" in this package goes through
# strip(), which trims this character set (no regex, so it stays cheap in generated code).
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
            + "".join(chr(c) for c in range(0x2000, 0x200B))
            + "\u2028\u2029\u202f\u205f\u3000")

# F1: characters that may not appear in a spreadsheet cell (XML 1.0): C0 controls except
# tab/LF/CR, C1 controls except U+0085, U+FDD0-U+FDEF, U+FFFE, U+FFFF.
ILLEGAL_CELL_CLASS = "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F-\\x{84}\\x{86}-\\x{9F}\\x{FDD0}-\\x{FDEF}\\x{FFFE}\\x{FFFF}]"
# C0 controls except tab/LF/CR only
ILLEGAL_C0_CLASS = "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]"
MAX_CELL_CHARS = 32767
# wide enough for any amount on a sheet; rounding is left to the output
AMOUNT_TYPE = "decimal(38,6)"

# T5: what counts as a number (pandas.to_numeric accepts these; Spark's cast would also
# accept '1d', 'nan', 'Infinity', which must stay null)
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"

# H6: characters that a normalised column name does not have
NAME_NOISE = "".join(config.NAME_NOISE_CHARS)

FULLWIDTH_DIGITS = "０１２３４５６７８９"
ASCII_DIGITS = "0123456789"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove leading and trailing Unicode whitespace (like Python's ``str.strip()``)."""
    return F.trim(_col(c), F.lit(WS_CHARS))


def blank_to_null(c) -> Column:
    """Stripped text, with the empty string turned into null."""
    s = strip(c)
    return F.when(s != "", s)


def clean_cell(c) -> Column:
    """drop characters illegal in a spreadsheet cell; the length stays."""
    return F.regexp_replace(_col(c), ILLEGAL_CELL_CLASS, "")


def cut_cell(c) -> Column:
    """the first 32,767 characters, for output that ends in a spreadsheet cell."""
    return F.substring(_col(c), 1, MAX_CELL_CHARS)


def clean_report_text(c) -> Column:
    """drop C0 control characters; a missing value prints as the empty string."""
    return F.coalesce(F.regexp_replace(_col(c), ILLEGAL_C0_CLASS, ""), F.lit(""))


def norm_text(c, lower: bool = False) -> Column:
    """compare form of a cell: stripped, optionally lower-cased, null -> ''."""
    s = strip(_col(c).cast("string"))
    if lower:
        s = F.lower(s)
    return F.coalesce(s, F.lit(""))


def ascii_digits(c) -> Column:
    """Full-width digits to ASCII digits."""
    return F.translate(_col(c), FULLWIDTH_DIGITS, ASCII_DIGITS)


def parse_number(c) -> Column:
    """number from text -- commas removed, stripped, must look like a number."""
    s = strip(F.regexp_replace(_col(c).cast("string"), ",", ""))
    return F.when(s.rlike(NUMBER_PATTERN), (s).try_cast("double"))


def parse_amount(c) -> Column:
    """F4 for money: the number as AMOUNT_TYPE (exact sums, order-independent)."""
    s = strip(F.regexp_replace(_col(c).cast("string"), ",", ""))
    return F.when(s.rlike(NUMBER_PATTERN), s.try_cast(AMOUNT_TYPE))


def is_blank(c) -> Column:
    """null, empty after strip, or the texts 'nan' / 'nat' (any case)."""
    return F.coalesce(F.lower(strip(_col(c).cast("string"))).isin(*config.BLANK_TOKENS), F.lit(True))


def starts_with_subtotal(c, prefix: str = config.SUBTOTAL_PREFIX) -> Column:
    """P2 cell test: stripped text starts with the subtotal marker (null -> false)."""
    return F.coalesce(strip(_col(c).cast("string")).startswith(prefix), F.lit(False))


def norm_name(c) -> Column:
    """H6: column-name normal form: strip, lower case, drop space _ - ( ) （ ） [ ] 【 】 : ："""
    return F.translate(F.lower(strip(c)), NAME_NOISE, "")


def norm_name_py(name: str) -> str:
    """The same rule on the driver, for column *names* (metadata only)."""
    return str(name).strip(WS_CHARS).lower().translate(dict.fromkeys(map(ord, NAME_NOISE)))


def format_amount(c, unit: str = "TWD") -> Column:
    """'12,345 TWD'."""
    return F.concat(F.format_number(_col(c).cast("double"), 0), F.lit(f" {unit}"))


def format_pct(c) -> Column:
    """'12.3%'."""
    return F.format_string("%.1f%%", _col(c).cast("double"))


def pct_label(c, threshold: float) -> Column:
    """Percentage text only for slices at or above the threshold."""
    return F.when(_col(c) >= threshold, format_pct(c)).otherwise(F.lit(""))


def normalise_units(c) -> Column:
    """'°C' -> 'degC', '%rh' -> '%RH'."""
    out = _col(c)
    for old, new in config.UNIT_REPLACEMENTS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def delimited_row(cols, sep: str = "\t", null_text: str = config.EXTRACT_NULL_TEXT) -> Column:
    """one text line per row, missing values printed as ``None``."""
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit(null_text)) for c in cols])
