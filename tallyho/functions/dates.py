"""Date column expressions (D1-D11), including the payment-term rule engine.

Spark 4 runs with ANSI mode on, so every parse goes through ``try_*`` functions and
invalid input becomes null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from .text import NUMBER_PATTERN, ascii_digits, strip

EXCEL_EPOCH = "1899-12-30"
# Excel serial day numbers that map to real dates (1900-01-01 .. 9999-12-31)
EXCEL_SERIAL_MIN = 1
EXCEL_SERIAL_MAX = 2958465

# Tried in this order; the time-of-day forms accept cells that were real dates and
# were turned into text ('2025-11-18 00:00:00')
SHEET_DATE_FORMATS = ["yyyy/M/d", "yyyy-M-d", "yyyy/M/d H:m:s", "yyyy-M-d H:m:s"]
# D3: separators '.' and '/' become '-', then these are tried (month-first before day-first)
LENIENT_DATE_FORMATS = ["yyyy-M-d", "yyyy-M-d H:m:s", "yyyyMMdd", "M-d-yyyy", "d-M-yyyy"]
# D3, free forms: rewritten in this order to '=year month day', the mark keeping later ones off
MONTH = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
NUMBER = "([0-9]{1,2})"
YEAR = "([0-9]{4}|[0-9]{2})"
FREE_FORMS = [
    ("=", "?"),
    ("^(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?[., ]+", ""),
    ("[t ]+[0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:[.][0-9]+)?)?(?: ?[ap]m)?(?: ?(?:z|utc|gmt|[-+][0-9]{2}:?[0-9]{2}))?$", ""),
    (r"\b(?:(jan)uary|(feb)ruary|(mar)ch|(apr)il|(jun)e|(jul)y|(aug)ust|(sep)t(?:ember)?|(oct)ober|(nov)ember|(dec)ember)\b",
     "$1$2$3$4$5$6$7$8$9$10$11"),
    ("([0-9])(?:st|nd|rd|th)(?![a-z])", "$1"),
    ("[-./, ]+", " "),
    (f"^{NUMBER} {MONTH} {YEAR}$", "=$3 $2 $1"),
    (f"^{MONTH} {NUMBER} {YEAR}$", "=$3 $1 $2"),
    (f"^(1[3-9]|2[0-9]|3[01]) {NUMBER} {YEAR}$", "=$3 $2 $1"),
    (f"^{NUMBER} {NUMBER} {YEAR}$", "=$3 $1 $2"),
    (f"^([0-9]{{4}}) (?:{MONTH}|{NUMBER}) {NUMBER}$", "=$1 $2$3 $4"),
    ("^([0-9]{4})([0-9]{2})([0-9]{2})(?:[0-9]{4}|[0-9]{6})?$", "=$1 $2 $3"),
    ("^=([0-5][0-9]|6[0-8]) ", "=20$1 "),
    ("^=([0-9]{2}) ", "=19$1 "),
]
# The two sensor-log timestamp formats
LOG_TS_FORMATS = ["yyyy/MM/dd HH:mm", "yyyy-MM-dd HH:mm:ss"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _try_formats(s: Column, formats) -> Column:
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(fmt)) for fmt in formats])


def excel_serial_to_date(c) -> Column:
    """Excel serial day number (text or number) -> DATE, fraction of day dropped."""
    s = strip(_col(c).cast("string"))
    num = F.when(s.rlike(NUMBER_PATTERN), (s).try_cast("double"))
    day = F.floor(num)
    ok = (day >= EXCEL_SERIAL_MIN) & (day <= EXCEL_SERIAL_MAX)
    return F.when(ok, F.date_add(F.lit(EXCEL_EPOCH).cast("date"), day.cast("int")))


def sheet_date(c) -> Column:
    """D1: 'Y/m/d', then 'Y-m-d', then an Excel serial number; floored to the day."""
    s = strip(_col(c).cast("string"))
    return F.coalesce(_try_formats(s, SHEET_DATE_FORMATS).cast("date"), excel_serial_to_date(s))


def lenient_date(c) -> Column:
    """D3: '.' and '/' read as '-', then a list of common layouts, then the free forms."""
    s = strip(_col(c).cast("string"))
    return F.coalesce(_try_formats(F.translate(s, "./", "--"), LENIENT_DATE_FORMATS).cast("date"), free_date(s))


def free_date(c) -> Column:
    """D3, free forms: a weekday before and a time of day behind are cut off, separators become
    blanks, and the remaining two or three words are read by their kind.

    A month may be a name, a four-digit number is the year, and a year of two digits is the one
    in 1969-2068.  Without a name the month goes first unless its number exceeds 12.  Text of any
    other shape, and days that do not exist, give null.
    """
    s = F.lower(strip(_col(c).cast("string")))
    for pattern, into in FREE_FORMS:
        s = F.regexp_replace(s, pattern, into)
    return _try_formats(s, ["'='yyyy M d", "'='yyyy MMM d"]).cast("date")


def as_date(c, dtype: str) -> Column:
    """DATE from a column of any type: temporal columns are cast, text goes through D3."""
    if dtype in ("date", "timestamp", "timestamp_ntz"):
        return _col(c).cast("date")
    return lenient_date(c)


def day_of_month(d, months_ahead, day: int) -> Column:
    """The given day of the month ``months_ahead`` after the month of ``d``.

    Month arithmetic is ``add_months`` (D4: clamps to the month end, like the original);
    month ends elsewhere are ``last_day`` (D6)."""
    return F.date_add(F.add_months(F.trunc(_col(d), "month"), months_ahead), day - 1)


def display_date(c) -> Column:
    """D9: 'yyyy/MM/dd', missing -> ''."""
    return F.coalesce(F.date_format(_col(c), "yyyy/MM/dd"), F.lit(""))


def log_timestamp(c) -> Column:
    """Sensor-log timestamp in minute or second form."""
    return _try_formats(strip(_col(c)), LOG_TS_FORMATS)


def name_timestamp(c, pattern: str = config.OUTPUT_NAME_PATTERN) -> Column:
    """Timestamp embedded in a file name as ``..._yyyyMMdd_HHmm``."""
    digits = F.concat(F.regexp_extract(_col(c), pattern, 1), F.regexp_extract(_col(c), pattern, 2))
    return F.when(F.length(digits) == 12, F.try_to_timestamp(digits, F.lit("yyyyMMddHHmm")))


# ---- D7: expected payment date ------------------------------------------------------
RULE_NO_INPUT = 0
RULE_SKIPPED = 1
RULE_THIS_MONTH_15 = 2
RULE_THIS_MONTH_18 = 3
RULE_NEXT_MONTH_15 = 4
RULE_NET_DAYS_18TH = 5
RULE_NET_DAYS_MONTH_END = 6
RULE_NET_DAYS_UNSUPPORTED = 7
RULE_UNSUPPORTED = 8
RULE_OVERRIDE = 9
MAX_MONTHS_AHEAD = 12 * 7000   # keeps every computed date inside year 9999


def with_expected_pay_date(df: DataFrame, doc_date: str, term: str, vendor: str | None = None) -> DataFrame:
    """D7 + P8: add ``expected_pay_date``, ``pay_rule`` and ``basis``; first matching rule wins.

    ``doc_date`` must be a DATE column, ``term`` and ``vendor`` text.  The work is staged
    over three projections (normalised term -> rule number -> date and text) so each
    expression is evaluated once per row and stays small enough for code generation.
    """
    d = F.col(doc_date)
    # terms are matched in full after removing ASCII spaces; J8/M12: the net-days ->
    # months rule is a literal map looked up with try_element_at (null = not in the map)
    net = f"^{config.NET_DAYS_PREFIX}([0-9]+){config.NET_DAYS_SUFFIX}$"
    term_s = strip(F.col(term))
    staged = df.withColumns({
        "_tly_term": term_s,
        "_tly_t": ascii_digits(F.replace(term_s, F.lit(" "), F.lit(""))),
    })
    t = F.col("_tly_t")
    ts = F.col("_tly_term")
    staged = staged.withColumns({
        "_tly_net": t.rlike(net),
        "_tly_n": F.regexp_extract(t, net, 1).try_cast("bigint"),
    })
    is_net = F.col("_tly_net")
    n = F.col("_tly_n")
    months_18 = F.lit(1) + F.floor((n - 18) / 30)
    is_18th = is_net & (n >= 18) & (((n - 18) % 30) == 0) & (months_18 <= MAX_MONTHS_AHEAD)
    month_end_map = F.create_map(*[F.lit(x) for kv in config.NET_DAYS_MONTH_END.items() for x in kv])
    months_end = F.try_element_at(month_end_map, n)
    rule = (
        F.when(d.isNull() | ts.isNull() | (ts == ""), RULE_NO_INPUT)
        .when(ts.isin(*config.SKIP_TERMS), RULE_SKIPPED)
        .when(t == config.TERM_THIS_MONTH_15, RULE_THIS_MONTH_15)
        .when(t == config.TERM_THIS_MONTH_18, RULE_THIS_MONTH_18)
        .when(t == config.TERM_NEXT_MONTH_15, RULE_NEXT_MONTH_15)
        .when(is_18th, RULE_NET_DAYS_18TH)
        .when(is_net & months_end.isNotNull(), RULE_NET_DAYS_MONTH_END)
        .when(is_net, RULE_NET_DAYS_UNSUPPORTED)
        .otherwise(RULE_UNSUPPORTED)
    )
    if vendor is not None:
        override = ((strip(F.col(vendor)) == config.OVERRIDE_VENDOR)
                    & (t == config.TERM_NEXT_MONTH_15) & d.isNotNull())
        rule = F.when(F.coalesce(override, F.lit(False)), RULE_OVERRIDE).otherwise(rule)
    staged = staged.withColumns({"pay_rule": rule, "_tly_m18": months_18, "_tly_mend": months_end})
    r = F.col("pay_rule")
    m18 = F.col("_tly_m18")
    mend = F.col("_tly_mend")
    late = F.dayofmonth(d) > 18
    expected = (
        F.when(r == RULE_THIS_MONTH_15, day_of_month(d, 0, 15))
        .when(r == RULE_THIS_MONTH_18, day_of_month(d, late.cast("int"), 18))
        .when(r == RULE_NEXT_MONTH_15, day_of_month(d, 1, 15))
        .when(r == RULE_NET_DAYS_18TH, day_of_month(d, m18.cast("int"), 18))
        .when(r == RULE_NET_DAYS_MONTH_END, F.last_day(F.add_months(d, mend.cast("int"))))
        .when(r == RULE_OVERRIDE, day_of_month(d, 0, 15))
    )
    basis = (
        F.when(r == RULE_NO_INPUT, F.lit("no document date or blank term"))
        .when(r == RULE_SKIPPED, F.lit("skipped by user rule"))
        .when(r == RULE_THIS_MONTH_15, F.lit("this month 15th"))
        .when((r == RULE_THIS_MONTH_18) & ~late, F.lit("this month 18th (day <= 18)"))
        .when(r == RULE_THIS_MONTH_18, F.lit("next month 18th (day > 18)"))
        .when(r == RULE_NEXT_MONTH_15, F.lit("next month 15th"))
        .when(r == RULE_NET_DAYS_18TH, F.format_string("net %d days: 18th of month +%d", n, m18.cast("bigint")))
        .when(r == RULE_NET_DAYS_MONTH_END, F.format_string("net %d days: month end +%d", n, mend.cast("bigint")))
        .when(r == RULE_NET_DAYS_UNSUPPORTED, F.format_string("unsupported: net %d days", n))
        .when(r == RULE_UNSUPPORTED, F.lit("unsupported term"))
        .when(r == RULE_OVERRIDE, F.lit("vendor override: 15th of document month"))
    )
    return (staged.withColumns({"expected_pay_date": expected, "basis": basis})
            .drop("_tly_term", "_tly_t", "_tly_net", "_tly_n", "_tly_m18", "_tly_mend"))


def days_between(later, earlier) -> Column:
    """Signed day difference ``later - earlier`` (null if either is missing)."""
    return F.datediff(_col(later), _col(earlier))
