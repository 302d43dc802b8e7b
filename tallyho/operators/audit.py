"""Payment-date audit (entry 2): expected date from the payment term, compared with the
recorded date, classified and summarised.

Every step is a column expression or one aggregation; nothing is per-row Python.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import RULE_SKIPPED, as_date, days_between, display_date, with_expected_pay_date
from ..functions.text import clean_report_text
from .columns import pick_column

STATUS_SKIPPED = "skipped"
STATUS_UNSUPPORTED = "unsupported"
STATUS_MISMATCH = "mismatch"
STATUS_MATCH = "match"
STATUS_NOT_COMPARED = "not compared"   # the table has no planned-date column

REPORT_COLUMNS = ["voucher_no", "doc_date", "vendor_code", "vendor_name", "term_code", "term_name",
                  "planned_pay_date", "expected_pay_date", "days_diff", "basis"]


def resolve_audit_columns(columns: list[str]) -> dict[str, str | None]:
    """H7/H12 on the driver: map roles to the columns present (canonical name or alias)."""
    roles = {
        "doc_date": ["doc_date", *config.DOC_DATE_ALIASES],
        "term_name": ["term_name", *config.TERM_ALIASES],
        "planned_pay_date": ["planned_pay_date", *config.PLANNED_ALIASES],
        "voucher_no": ["voucher_no", *config.VOUCHER_NO_ALIASES],
        "vendor_name": ["vendor_name", *config.VENDOR_ALIASES],
        "vendor_code": ["vendor_code", *config.VENDOR_CODE_ALIASES],
        "term_code": ["term_code", *config.TERM_CODE_ALIASES],
    }
    found = {role: pick_column(columns, names) for role, names in roles.items()}
    missing = [r for r in ("doc_date", "term_name") if found[r] is None]
    if missing:
        raise ValueError(f"required columns not found: {', '.join(missing)}")
    return found


def audit_payments(df: DataFrame) -> DataFrame:
    """D7 + P8 + P10 + D8 + P6 on a voucher table.

    Output: the canonical voucher columns (missing ones as null, H11) plus
    ``expected_pay_date, pay_rule, basis, is_consistent, days_diff, audit_status``.  Without a
    planned-date column nothing can be compared: ``is_consistent`` is null, no row a mismatch.
    """
    found = resolve_audit_columns(df.columns)
    dtypes = dict(df.dtypes)

    def text(role):
        c = found[role]
        return F.col(c).cast("string") if c else F.lit(None).cast("string")

    doc = as_date(found["doc_date"], dtypes[found["doc_date"]])
    planned = (as_date(found["planned_pay_date"], dtypes[found["planned_pay_date"]])
               if found["planned_pay_date"] else F.lit(None).cast("date"))
    base = df.select(text("voucher_no").alias("voucher_no"), doc.alias("doc_date"),
                     text("vendor_code").alias("vendor_code"), text("vendor_name").alias("vendor_name"),
                     text("term_code").alias("term_code"), text("term_name").alias("term_name"),
                     planned.alias("planned_pay_date"))
    vendor = "vendor_name" if found["vendor_name"] else None
    exp = F.col("expected_pay_date")
    comparable = exp.isNotNull() if found["planned_pay_date"] else F.lit(False)
    consistent = F.when(comparable, F.coalesce(F.col("planned_pay_date") == exp, F.lit(False)))
    status = (F.when(F.col("pay_rule") == RULE_SKIPPED, STATUS_SKIPPED)
              .when(exp.isNull(), STATUS_UNSUPPORTED)
              .when(F.col("is_consistent").isNull(), STATUS_NOT_COMPARED)
              .when(~F.col("is_consistent"), STATUS_MISMATCH)
              .otherwise(STATUS_MATCH))
    audited = (with_expected_pay_date(base, "doc_date", "term_name", vendor)
               .withColumn("is_consistent", consistent)
               .withColumn("days_diff", days_between("planned_pay_date", "expected_pay_date"))
               .withColumn("audit_status", status))
    # Quality counters ride along with the scan (no extra job).  The observation node also
    # keeps report filters on audit_status above the rule evaluation: pushed below it,
    # Catalyst would inline the whole rule chain into the join condition once per reference.
    s = F.col("audit_status")
    return audited.observe(f"payment_audit_{uuid.uuid4().hex[:8]}",
                           F.count(F.lit(1)).alias("rows"),
                           F.count_if(s == STATUS_MISMATCH).alias("mismatches"),
                           F.count_if(s == STATUS_UNSUPPORTED).alias("unsupported"))


def mismatches(audited: DataFrame) -> DataFrame:
    return audited.where(F.col("audit_status") == STATUS_MISMATCH)


def mismatch_by_term(audited: DataFrame) -> DataFrame:
    """Mismatch count per payment term, missing term kept as its own group."""
    return mismatches(audited).groupBy("term_name").agg(F.count(F.lit(1)).alias("mismatches"))


def status_counts(audited: DataFrame) -> DataFrame:
    """One-row summary of the audit."""
    s = F.col("audit_status")
    return audited.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(s == STATUS_MISMATCH).alias("mismatches"),
        F.count_if(s == STATUS_SKIPPED).alias("skipped"),
        F.count_if(s == STATUS_UNSUPPORTED).alias("unsupported"),
        F.count_if(s == STATUS_MATCH).alias("matched"),
    )


def mismatch_report(audited: DataFrame) -> DataFrame:
    """O2 + D9: mismatch detail in report form, earliest document date first (missing last)."""
    return (mismatches(audited)
            .select(*REPORT_COLUMNS,
                    display_date("doc_date").alias("doc_date_text"),
                    display_date("planned_pay_date").alias("planned_text"),
                    display_date("expected_pay_date").alias("expected_text"))
            .orderBy(F.asc_nulls_last("doc_date"), F.asc_nulls_last("voucher_no")))


def audit_report(audited: DataFrame) -> dict[str, DataFrame]:
    """K2: the six report tables; text columns cleaned of control characters (F2)."""
    def clean(df: DataFrame) -> DataFrame:
        return df.select(*[clean_report_text(c).alias(c) if t == "string" else F.col(c)
                           for c, t in df.dtypes])
    s = F.col("audit_status")
    return {
        "counts": status_counts(audited),
        "by_term": clean(mismatch_by_term(audited)),
        "mismatches": clean(mismatch_report(audited)),
        "skipped": clean(audited.where(s == STATUS_SKIPPED).select(*REPORT_COLUMNS)),
        "unsupported": clean(audited.where(s == STATUS_UNSUPPORTED).select(*REPORT_COLUMNS)),
        "all": clean(audited),
    }
