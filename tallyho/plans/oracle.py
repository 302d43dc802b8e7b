"""Independent SQL for every registered query, runnable by DuckDB on the same parquet tables.

The SQL restates each operator's semantics from scratch -- it shares no code with the
Spark implementation -- and is what the result of each ``queries()`` entry is checked
against.  Fixture views are spelled out as CTEs over the base tables.
"""

from __future__ import annotations

from ..functions.text import WS_CHARS

# the whitespace set of Python's str.isspace(): control characters by code, the rest literal
_WS_SQL = " || ".join([f"chr({ord(ch)})" for ch in WS_CHARS if ord(ch) < 0x20]
                      + ["'" + "".join(ch for ch in WS_CHARS if ord(ch) >= 0x20) + "'"])


def strip_sql(expr: str) -> str:
    return f"trim({expr}, {_WS_SQL})"


VOUCHERS = """
vouchers AS (
 SELECT concat('V', CAST(o_orderkey AS VARCHAR)) AS voucher_no, CAST(o_orderdate AS DATE) AS doc_date,
  CAST(o_custkey AS VARCHAR) AS vendor_code,
  CASE WHEN o_custkey % 50 = 0 THEN '南科管理局' ELSE c_name END AS vendor_name,
  CASE o_orderkey % 12 WHEN 0 THEN '當月15號' WHEN 1 THEN '當月18號付款' WHEN 2 THEN '次月15號付款' WHEN 3 THEN '月結18天'
   WHEN 4 THEN '月結48天' WHEN 5 THEN '月結78天' WHEN 6 THEN '月結30天' WHEN 7 THEN '月結60天' WHEN 8 THEN '月結120天'
   WHEN 9 THEN '月結90天' WHEN 10 THEN '請財務部確認付款日' END AS term_name,
  CASE o_orderkey % 5 WHEN 0 THEN NULL
   WHEN 1 THEN CAST(date_trunc('month', o_orderdate) + INTERVAL '1' MONTH + INTERVAL '17' DAY AS DATE)
   WHEN 2 THEN CAST(date_trunc('month', o_orderdate) + INTERVAL '14' DAY AS DATE)
   WHEN 3 THEN last_day(CAST(o_orderdate + INTERVAL '1' MONTH AS DATE))
   ELSE CAST(o_orderdate + INTERVAL '30' DAY AS DATE) END AS planned_pay_date,
  CAST(o_totalprice AS DECIMAL(18,2)) AS amount
 FROM orders JOIN customer ON o_custkey = c_custkey
)"""

# D7 + P8 + P10 + D8 + P6 written as plain CASE chains
AUDITED = f"""
a0 AS (
 SELECT voucher_no, doc_date, vendor_code, vendor_name, CAST(NULL AS VARCHAR) AS term_code, term_name,
  planned_pay_date, {strip_sql('term_name')} AS term_s,
  translate(replace({strip_sql('term_name')}, ' ', ''), '０１２３４５６７８９', '0123456789') AS t
 FROM vouchers
), a1 AS (
 SELECT *, regexp_full_match(t, '月結[0-9]+天') AS is_net,
  TRY_CAST(regexp_extract(t, '^月結([0-9]+)天$', 1) AS BIGINT) AS n
 FROM a0
), a2 AS (
 SELECT *,
  CASE
   WHEN {strip_sql('vendor_name')} = '南科管理局' AND t = '次月15號付款' AND doc_date IS NOT NULL THEN 9
   WHEN doc_date IS NULL OR term_s IS NULL OR term_s = '' THEN 0
   WHEN term_s IN ('月結30天(EXW date)', '月結60天(FCA date)', '請財務部確認付款日') THEN 1
   WHEN t = '當月15號' THEN 2
   WHEN t = '當月18號付款' THEN 3
   WHEN t = '次月15號付款' THEN 4
   WHEN is_net AND n >= 18 AND (n - 18) % 30 = 0 THEN 5
   WHEN is_net AND n IN (30, 60, 120) THEN 6
   WHEN is_net THEN 7
   ELSE 8 END AS pay_rule
 FROM a1
), a3 AS (
 SELECT *,
  CASE pay_rule
   WHEN 2 THEN CAST(date_trunc('month', doc_date) + INTERVAL '14' DAY AS DATE)
   WHEN 3 THEN CASE WHEN day(doc_date) <= 18 THEN CAST(date_trunc('month', doc_date) + INTERVAL '17' DAY AS DATE)
               ELSE CAST(date_trunc('month', doc_date) + INTERVAL '1' MONTH + INTERVAL '17' DAY AS DATE) END
   WHEN 4 THEN CAST(date_trunc('month', doc_date) + INTERVAL '1' MONTH + INTERVAL '14' DAY AS DATE)
   WHEN 5 THEN CAST(date_trunc('month', doc_date) + to_months(CAST(1 + (n - 18) // 30 AS INTEGER)) + INTERVAL '17' DAY AS DATE)
   WHEN 6 THEN last_day(CAST(doc_date + to_months(CASE n WHEN 30 THEN 1 WHEN 60 THEN 2 ELSE 4 END) AS DATE))
   WHEN 9 THEN CAST(date_trunc('month', doc_date) + INTERVAL '14' DAY AS DATE)
  END AS expected_pay_date,
  CASE pay_rule
   WHEN 0 THEN 'no document date or blank term'
   WHEN 1 THEN 'skipped by user rule'
   WHEN 2 THEN 'this month 15th'
   WHEN 3 THEN CASE WHEN day(doc_date) <= 18 THEN 'this month 18th (day <= 18)' ELSE 'next month 18th (day > 18)' END
   WHEN 4 THEN 'next month 15th'
   WHEN 5 THEN printf('net %d days: 18th of month +%d', n, 1 + (n - 18) // 30)
   WHEN 6 THEN printf('net %d days: month end +%d', n, CASE n WHEN 30 THEN 1 WHEN 60 THEN 2 ELSE 4 END)
   WHEN 7 THEN printf('unsupported: net %d days', n)
   WHEN 8 THEN 'unsupported term'
   WHEN 9 THEN 'vendor override: 15th of document month'
  END AS basis
 FROM a2
), audited AS (
 SELECT voucher_no, doc_date, vendor_code, vendor_name, term_code, term_name, planned_pay_date,
  expected_pay_date, CAST(pay_rule AS INTEGER) AS pay_rule, basis,
  CASE WHEN expected_pay_date IS NOT NULL THEN coalesce(planned_pay_date = expected_pay_date, false) END AS is_consistent,
  CAST(date_diff('day', expected_pay_date, planned_pay_date) AS INTEGER) AS days_diff,
  CASE WHEN pay_rule = 1 THEN 'skipped'
       WHEN expected_pay_date IS NULL THEN 'unsupported'
       WHEN NOT coalesce(planned_pay_date = expected_pay_date, false) THEN 'mismatch'
       ELSE 'match' END AS audit_status
 FROM a3
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


AUDIT = with_ctes(VOUCHERS, AUDITED)

ORACLE: dict[str, str] = {
    "audit_detail": AUDIT + "SELECT * FROM audited",
    "audit_mismatch_by_term": AUDIT + """
SELECT term_name, count(*) AS mismatches FROM audited WHERE audit_status = 'mismatch' GROUP BY term_name""",
    "audit_status_counts": AUDIT + """
SELECT count(*) AS total_rows,
 count(*) FILTER (WHERE audit_status = 'mismatch') AS mismatches,
 count(*) FILTER (WHERE audit_status = 'skipped') AS skipped,
 count(*) FILTER (WHERE audit_status = 'unsupported') AS unsupported,
 count(*) FILTER (WHERE audit_status = 'match') AS matched
FROM audited""",
    "audit_mismatch_sorted": AUDIT + """
SELECT voucher_no, doc_date, vendor_code, vendor_name, term_code, term_name, planned_pay_date,
 expected_pay_date, days_diff, basis,
 coalesce(strftime(doc_date, '%Y/%m/%d'), '') AS doc_date_text,
 coalesce(strftime(planned_pay_date, '%Y/%m/%d'), '') AS planned_text,
 coalesce(strftime(expected_pay_date, '%Y/%m/%d'), '') AS expected_text
FROM audited WHERE audit_status = 'mismatch'""",
}


def _spend_rows(dim: str) -> str:
    return f"""
r AS (
 SELECT NULLIF({strip_sql(dim)}, '') AS {dim}, amount FROM vouchers
 WHERE amount IS NOT NULL AND NULLIF({strip_sql(dim)}, '') IS NOT NULL
), agg AS (SELECT {dim}, sum(amount) AS amount FROM r GROUP BY {dim})"""


def _topk_other(dim: str, k: int = 10) -> str:
    return with_ctes(VOUCHERS, _spend_rows(dim)) + f"""
, ranked AS (SELECT *, row_number() OVER (ORDER BY amount DESC, {dim} ASC NULLS LAST) AS rk FROM agg)
SELECT rank, {dim}, CAST(amount AS DOUBLE) AS amount,
 CAST(amount AS DOUBLE) * 100.0 / CAST((SELECT sum(amount) FROM r) AS DOUBLE) AS pct
FROM (
 SELECT CAST(rk AS INTEGER) AS rank, {dim}, amount FROM ranked WHERE rk <= {k}
 UNION ALL
 SELECT {k + 1}, '其他', sum(amount) FROM ranked WHERE rk > {k} HAVING count(*) > 0
) x"""


ORACLE.update({
    "spend_by_term": with_ctes(VOUCHERS, _spend_rows("term_name")) + """
, s AS (SELECT term_name, CAST(amount AS DOUBLE) AS amount,
  CAST(amount AS DOUBLE) * 100.0 / CAST((SELECT sum(amount) FROM agg) AS DOUBLE) AS pct FROM agg)
SELECT term_name, amount, pct, CASE WHEN pct >= 2.0 THEN printf('%.1f%%', pct) ELSE '' END AS label FROM s""",
    "spend_topk_other": _topk_other("term_name"),
    "spend_topk_vendor": _topk_other("vendor_name"),
    "spend_topk_by_folder": with_ctes(VOUCHERS) + f"""
, r AS (
 SELECT r_name AS folder, NULLIF({strip_sql('vendor_name')}, '') AS vendor_name, amount
 FROM vouchers JOIN customer ON CAST(c_custkey AS VARCHAR) = vendor_code
 JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
 WHERE amount IS NOT NULL AND NULLIF({strip_sql('vendor_name')}, '') IS NOT NULL
), agg AS (SELECT folder, vendor_name, sum(amount) AS amount FROM r GROUP BY folder, vendor_name)
, tot AS (SELECT folder, sum(amount) AS total FROM r GROUP BY folder)
, ranked AS (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY amount DESC, vendor_name ASC NULLS LAST) AS rk FROM agg)
SELECT x.folder, rank, vendor_name, CAST(amount AS DOUBLE) AS amount, CAST(amount AS DOUBLE) * 100.0 / CAST(total AS DOUBLE) AS pct
FROM (
 SELECT folder, CAST(rk AS INTEGER) AS rank, vendor_name, amount FROM ranked WHERE rk <= 10
 UNION ALL
 SELECT folder, 11, '其他', sum(amount) FROM ranked WHERE rk > 10 GROUP BY folder
) x JOIN tot ON tot.folder = x.folder""",
    "spend_top3": with_ctes(VOUCHERS, _spend_rows("term_name")) + """
, ranked AS (SELECT *, row_number() OVER (ORDER BY amount DESC, term_name ASC NULLS LAST) AS rk FROM agg)
SELECT CAST(rk AS INTEGER) AS rank, term_name, CAST(amount AS DOUBLE) AS amount,
 round_even(CAST(amount AS DOUBLE) * 100.0 / CAST((SELECT sum(amount) FROM r) AS DOUBLE), 1) AS pct
FROM ranked WHERE rk <= 3""",
    "spend_vendor_share": with_ctes(VOUCHERS, _spend_rows("term_name")) + f"""
, top AS (SELECT term_name FROM agg ORDER BY amount DESC, term_name ASC NULLS LAST LIMIT 3)
, d AS (
 SELECT NULLIF({strip_sql('term_name')}, '') AS term_name, NULLIF({strip_sql('vendor_name')}, '') AS vendor_name, amount
 FROM vouchers)
, bv AS (
 SELECT term_name, vendor_name, sum(amount) AS amount FROM d
 WHERE term_name IN (SELECT term_name FROM top) AND vendor_name IS NOT NULL AND amount IS NOT NULL
 GROUP BY term_name, vendor_name)
, base AS (SELECT term_name, sum(amount) AS b FROM bv GROUP BY term_name)
, s AS (
 SELECT bv.term_name, vendor_name, CAST(amount AS DOUBLE) AS amount,
  CASE WHEN b > 0 THEN CAST(amount AS DOUBLE) * 100.0 / CAST(b AS DOUBLE) ELSE 0.0 END AS pct
 FROM bv JOIN base ON bv.term_name = base.term_name)
SELECT term_name, vendor_name, amount, pct, CASE WHEN pct >= 10.0 THEN printf('%.1f%%', pct) ELSE '' END AS label FROM s""",
})


_DIFF_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate"]
_DIFF_NORM = ", ".join(
    [f"coalesce({strip_sql(f'CAST({c} AS VARCHAR)')}, '') AS {c}" for c in _DIFF_COLS[:-1]]
    + ["coalesce(strftime(l_shipdate, '%Y-%m-%d'), '') AS l_shipdate"])
_DIFF_OCC = ("row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
             + ", ".join(_DIFF_COLS) + ") AS occ")
DIFF = """
l0 AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_shipdate
       FROM lineitem WHERE l_partkey % 10 <> 0),
r0 AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CASE WHEN l_partkey % 17 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity, l_returnflag, l_shipdate
       FROM lineitem WHERE l_suppkey % 10 <> 1),
""" + f"""
dl AS (SELECT {_DIFF_NORM}, {_DIFF_OCC} FROM l0),
dr AS (SELECT {_DIFF_NORM}, {_DIFF_OCC} FROM r0),
only_l AS (SELECT * FROM dl WHERE NOT EXISTS (SELECT 1 FROM dr WHERE dr.l_orderkey = dl.l_orderkey
           AND dr.l_linenumber = dl.l_linenumber AND dr.occ = dl.occ)),
only_r AS (SELECT * FROM dr WHERE NOT EXISTS (SELECT 1 FROM dl WHERE dr.l_orderkey = dl.l_orderkey
           AND dr.l_linenumber = dl.l_linenumber AND dr.occ = dl.occ)),
pairs AS (SELECT dl.l_orderkey AS key_1, dl.l_linenumber AS key_2,
           dl.l_partkey AS lp, dr.l_partkey AS rp, dl.l_suppkey AS ls, dr.l_suppkey AS rs,
           dl.l_quantity AS lq, dr.l_quantity AS rq, dl.l_returnflag AS lf, dr.l_returnflag AS rf,
           dl.l_shipdate AS ld, dr.l_shipdate AS rd
          FROM dl JOIN dr ON dl.l_orderkey = dr.l_orderkey AND dl.l_linenumber = dr.l_linenumber AND dl.occ = dr.occ),
cells0 AS (
 SELECT key_1, key_2, 'l_partkey' AS "column", lp AS left_value, rp AS right_value FROM pairs WHERE lp <> rp
 UNION ALL SELECT key_1, key_2, 'l_quantity', lq, rq FROM pairs WHERE lq <> rq
 UNION ALL SELECT key_1, key_2, 'l_returnflag', lf, rf FROM pairs WHERE lf <> rf
 UNION ALL SELECT key_1, key_2, 'l_shipdate', ld, rd FROM pairs WHERE ld <> rd
 UNION ALL SELECT key_1, key_2, 'l_suppkey', ls, rs FROM pairs WHERE ls <> rs),
mult AS (SELECT key_1, key_2, count(*) AS multiplicity FROM pairs GROUP BY key_1, key_2),
cells AS (SELECT cells0.*, multiplicity FROM cells0 JOIN mult ON cells0.key_1 = mult.key_1 AND cells0.key_2 = mult.key_2)"""
_DIFF_SEL = ", ".join(_DIFF_COLS)
_DIFF_ON = " AND ".join(f"a.{c} = b.{c}" for c in _DIFF_COLS)

ORACLE.update({
    "diff_only_left": with_ctes(DIFF) + f"SELECT {_DIFF_SEL} FROM only_l",
    "diff_only_right": with_ctes(DIFF) + f"SELECT {_DIFF_SEL} FROM only_r",
    "diff_cells": with_ctes(DIFF) + "SELECT * FROM cells",
    "diff_rows_nokey": with_ctes(DIFF) + f"""
SELECT {_DIFF_SEL}, 'left' AS side FROM dl a WHERE NOT EXISTS (SELECT 1 FROM dr b WHERE {_DIFF_ON})
UNION ALL
SELECT {_DIFF_SEL}, 'right' AS side FROM dr a WHERE NOT EXISTS (SELECT 1 FROM dl b WHERE {_DIFF_ON})""",
    "diff_columns_differ": """
WITH l AS (SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
 CAST(l_partkey AS VARCHAR) AS l_partkey, CASE WHEN l_returnflag <> 'N' THEN l_returnflag ELSE '' END AS flag, '' AS note FROM lineitem),
r AS (SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
 CAST(l_partkey AS VARCHAR) AS l_partkey, '' AS flag, CASE WHEN l_suppkey % 10 = 1 THEN 'late' ELSE '' END AS note FROM lineitem)
SELECT *, 'left' AS side FROM l ANTI JOIN r USING (l_orderkey, l_linenumber, l_partkey, flag, note)
UNION ALL SELECT *, 'right' FROM r ANTI JOIN l USING (l_orderkey, l_linenumber, l_partkey, flag, note)""",
    "diff_summary": with_ctes(DIFF) + """
SELECT 'diff_left' AS left_table, 'diff_right' AS right_table, 'l_orderkey, l_linenumber' AS keys_used,
 (SELECT count(*) FROM only_l) = 0 AND (SELECT count(*) FROM only_r) = 0 AND (SELECT count(*) FROM cells) = 0 AS same,
 (SELECT count(*) FROM only_l) AS only_in_left_rows, (SELECT count(*) FROM only_r) AS only_in_right_rows,
 (SELECT count(*) FROM cells) AS column_diff_rows""",
    "diff_key_except_all": with_ctes(DIFF) + "SELECT l_orderkey, l_linenumber FROM only_l",
    "diff_key_intersect_all": with_ctes(DIFF) + "SELECT key_1 AS l_orderkey, key_2 AS l_linenumber FROM pairs",
})


# ---- cell grids ---------------------------------------------------------------------
CELLS = """
sheet_rows AS (
 SELECT concat('book', CAST(n_regionkey AS VARCHAR), '.xlsx') AS file, n_name AS sheet, c_nationkey, c_custkey, c_name,
  row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn
 FROM customer JOIN nation ON c_nationkey = n_nationkey
), cells AS (
 SELECT DISTINCT file, sheet, CAST(0 AS BIGINT) AS row_idx, 0 AS col_idx, 'Voucher report' AS value FROM sheet_rows
 UNION ALL SELECT DISTINCT file, sheet, CAST(2 AS BIGINT), 0, CASE WHEN c_nationkey % 2 = 0 THEN '憑單日期' ELSE '單據日期' END FROM sheet_rows WHERE c_nationkey <> 24
 UNION ALL SELECT DISTINCT file, sheet, CAST(2 AS BIGINT), 1, '憑單單號' FROM sheet_rows WHERE c_nationkey <> 24
 UNION ALL SELECT DISTINCT file, sheet, CAST(2 AS BIGINT), 2, ' 廠商簡稱 ' FROM sheet_rows WHERE c_nationkey <> 24
 UNION ALL SELECT DISTINCT file, sheet, CAST(2 AS BIGINT), 3, '金額' FROM sheet_rows WHERE c_nationkey <> 24
 UNION ALL SELECT file, sheet, rn + 2, 0, CASE c_custkey % 3
    WHEN 0 THEN concat('2024/', CAST(c_custkey % 12 + 1 AS VARCHAR), '/', CAST(c_custkey % 28 + 1 AS VARCHAR))
    WHEN 1 THEN concat('2024-', CAST(c_custkey % 12 + 1 AS VARCHAR), '-', CAST(c_custkey % 28 + 1 AS VARCHAR))
    ELSE CAST(45292 + c_custkey AS VARCHAR) END FROM sheet_rows WHERE rn % 3 = 1
 UNION ALL SELECT file, sheet, rn + 2, 1, concat('C', CAST(c_custkey AS VARCHAR)) FROM sheet_rows
 UNION ALL SELECT file, sheet, rn + 2, 2, CASE WHEN rn % 10 = 0 THEN ' 小結:' ELSE c_name END FROM sheet_rows
 UNION ALL SELECT file, sheet, rn + 2, 3, concat(CAST(c_custkey % 900 + 1 AS VARCHAR), ',500.25') FROM sheet_rows
), nb AS (SELECT * FROM cells WHERE value IS NOT NULL AND value <> '')"""

VOUCHER_CELLS = CELLS.replace("), nb AS", """
 UNION ALL SELECT DISTINCT file, sheet, CAST(2 AS BIGINT), 4, '單據日期' FROM sheet_rows WHERE c_nationkey % 4 = 0 AND c_nationkey <> 24
 UNION ALL SELECT DISTINCT file, sheet, CAST(2 AS BIGINT), 5, '付款條件名稱' FROM sheet_rows WHERE c_nationkey <> 24
 UNION ALL SELECT DISTINCT file, sheet, CAST(2 AS BIGINT), 6, '預計付款日' FROM sheet_rows WHERE c_nationkey <> 24
 UNION ALL SELECT file, sheet, rn + 2, 4, concat('2023/', CAST(c_custkey % 12 + 1 AS VARCHAR), '/', CAST(c_custkey % 28 + 1 AS VARCHAR))
  FROM sheet_rows WHERE c_nationkey % 4 = 0 AND c_nationkey <> 24 AND c_custkey % 7 <> 0
 UNION ALL SELECT file, sheet, rn + 2, 5, CASE c_custkey % 4 WHEN 0 THEN '月結30天' WHEN 1 THEN '當月15號'
  WHEN 2 THEN '次月15號付款' ELSE '月結60天' END FROM sheet_rows
 UNION ALL SELECT file, sheet, rn + 2, 6, concat('2024/', CAST(c_custkey % 12 + 1 AS VARCHAR), '/15') FROM sheet_rows
), nb AS""")

_HEADER_KEYS = "'憑單日期', '憑單單號', '單據日期', '廠商代號', '廠商簡稱', '付款條件代號', '付款條件名稱', '預計付款日', '預計兌現日'"
HEADERS = f"""
hits AS (SELECT file, sheet, row_idx, count(DISTINCT {strip_sql('value')}) AS hits FROM nb
         WHERE {strip_sql('value')} IN ({_HEADER_KEYS}) GROUP BY file, sheet, row_idx),
hdr AS (SELECT file, sheet, min(row_idx) AS header_row FROM hits WHERE hits >= 3 GROUP BY file, sheet),
names AS (SELECT nb.file, nb.sheet, col_idx, {strip_sql('value')} AS name FROM nb JOIN hdr ON nb.file = hdr.file
          AND nb.sheet = hdr.sheet WHERE row_idx = header_row AND {strip_sql('value')} <> '')"""

_ALIAS_ROWS = []
for _canon, _aliases in [
        ("voucher_date", ["憑單日期", "憑單日", "憑單日期(西元)", "單據日期"]),
        ("doc_date", ["單據日期"]),
        ("voucher_no", ["憑單單號", "單據編號", "憑單編號", "單號", "發票號碼"]),
        ("vendor_code", ["廠商代號"]),
        ("vendor_name", ["廠商簡稱", "廠商名稱", "供應商名稱", "供應商"]),
        ("term_code", ["付款條件代號"]),
        ("term_name", ["付款條件名稱", "付款條件", "付款條件說明"]),
        ("planned_pay_date", ["預計付款日", "應付日期", "付款日期"]),
        ("cash_date", ["預計兌現日"]),
        ("amount", ["本幣貨款金額", "本幣金額", "金額(本幣)", "金額本幣", "金額"])]:
    for _p, _a in enumerate(_aliases):
        _ALIAS_ROWS.append(f"('{_a}', '{_canon}', {_p})")
_ALIASES = ", ".join(_ALIAS_ROWS)

_NUM = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_ILLEGAL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{84}\x{86}-\x{9F}\x{FDD0}-\x{FDEF}\x{FFFE}\x{FFFF}]"


def sheet_date_sql(e: str) -> str:
    d = strip_sql(e)
    serial = f"floor(TRY_CAST({d} AS DOUBLE))"
    return (f"coalesce(CAST(try_strptime({d}, '%Y/%m/%d') AS DATE), CAST(try_strptime({d}, '%Y-%m-%d') AS DATE), "
            f"CAST(try_strptime({d}, '%Y/%m/%d %H:%M:%S') AS DATE), CAST(try_strptime({d}, '%Y-%m-%d %H:%M:%S') AS DATE), "
            f"CASE WHEN regexp_full_match({d}, '{_NUM}') AND {serial} BETWEEN 1 AND 2958465 "
            f"THEN DATE '1899-12-30' + CAST({serial} AS INTEGER) END)")


def number_sql(e: str) -> str:
    s = strip_sql(f"replace({e}, ',', '')")
    return f"CASE WHEN regexp_full_match({s}, '{_NUM}') THEN TRY_CAST({s} AS DOUBLE) END"


def clean_cell_sql(e: str) -> str:
    return f"regexp_replace({e}, '{_ILLEGAL}', '', 'g')"


_CANON = ["voucher_date", "voucher_no", "vendor_code", "vendor_name", "term_code", "term_name",
          "planned_pay_date", "cash_date", "amount", "doc_date"]
CONSOLIDATED = f"""
aliases AS (SELECT * FROM (VALUES {_ALIASES}) t(alias, canonical, priority)),
picked AS (SELECT file, sheet, canonical, col_idx FROM (
  SELECT names.file, names.sheet, canonical, col_idx,
   row_number() OVER (PARTITION BY names.file, names.sheet, canonical ORDER BY priority, col_idx) AS rn
  FROM names JOIN aliases ON names.name = aliases.alias) x WHERE rn = 1),
colmap AS (SELECT * FROM picked UNION ALL
  SELECT file, sheet, 'voucher_date', 1 FROM hdr WHERE NOT EXISTS (
   SELECT 1 FROM picked p WHERE p.file = hdr.file AND p.sheet = hdr.sheet AND p.canonical = 'voucher_date')),
own_doc AS (SELECT d.file, d.sheet FROM colmap d JOIN colmap v ON d.file = v.file AND d.sheet = v.sheet
  WHERE d.canonical = 'doc_date' AND v.canonical = 'voucher_date' AND d.col_idx <> v.col_idx),
body AS (SELECT nb.file, nb.sheet, nb.row_idx, nb.col_idx, nb.value FROM nb JOIN hdr ON nb.file = hdr.file
         AND nb.sheet = hdr.sheet WHERE row_idx > header_row),
wide AS (SELECT b.file, b.sheet, b.row_idx,
  {", ".join(f"max(CASE WHEN m.canonical = '{c}' THEN b.value END) AS {c}" for c in _CANON)}
  FROM body b LEFT JOIN colmap m ON b.file = m.file AND b.sheet = m.sheet AND b.col_idx = m.col_idx
  GROUP BY b.file, b.sheet, b.row_idx),
marked AS (SELECT *, CASE WHEN {strip_sql('voucher_date')} IN ('', 'nan', 'NaT') THEN NULL
  ELSE {strip_sql('voucher_date')} END AS dt FROM wide),
filled AS (SELECT *, last_value(dt IGNORE NULLS) OVER (PARTITION BY file, sheet ORDER BY row_idx
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS dtext FROM marked),
consolidated AS (
 SELECT {sheet_date_sql('dtext')} AS voucher_date,
  CASE WHEN (file, sheet) IN (SELECT (file, sheet) FROM own_doc) THEN {sheet_date_sql('doc_date')}
       ELSE {sheet_date_sql('dtext')} END AS doc_date,
  {", ".join(f"{clean_cell_sql(c)} AS {c}" for c in ["voucher_no", "vendor_code", "vendor_name", "term_code", "term_name"])},
  {sheet_date_sql('planned_pay_date')} AS planned_pay_date, {sheet_date_sql('cash_date')} AS cash_date,
  {number_sql('amount')} AS amount,
  CAST(NULL AS VARCHAR) AS source_folder, file AS source_file, sheet AS sheet_name, row_idx AS source_row
 FROM filled WHERE {sheet_date_sql('dtext')} IS NOT NULL)"""

_SPEND_NORM = ["付款條件名稱", "付款條件", "付款條件代碼名稱", "付款條件說明", "paymentterms", "paymentterm", "terms",
               "termname", "paymenttermsname", "本幣貨款金額", "本幣金額", "本幣金額小計", "金額(本幣)", "金額本幣",
               "金額", "twd", "amounttwd", "amount(twd)", "amountntd", "ntdamount", "localamount", "amount",
               "amountlocal"]


def _norm_name_py(s: str) -> str:
    s = s.strip().lower()
    for ch in " _-()（）[]【】:：":
        s = s.replace(ch, "")
    return s


_SPEND_KEYS = ", ".join(sorted({f"'{_norm_name_py(a)}'" for a in _SPEND_NORM}))

ORACLE.update({
    "cells_header": with_ctes(CELLS, HEADERS) + "SELECT file, sheet, header_row FROM hdr",
    "cells_header_alias": with_ctes(CELLS) + f"""
SELECT file, sheet, min(row_idx) AS header_row FROM nb
WHERE regexp_replace(lower({strip_sql('value')}), '[ _\\-()（）\\[\\]【】:：]', '', 'g') IN ({_SPEND_KEYS})
GROUP BY file, sheet""",
    "cells_table": with_ctes(CELLS, HEADERS) + """
SELECT nb.file, nb.sheet, nb.row_idx, nb.col_idx, nb.value, names.name AS column_name
FROM nb JOIN hdr ON nb.file = hdr.file AND nb.sheet = hdr.sheet
LEFT JOIN names ON nb.file = names.file AND nb.sheet = names.sheet AND nb.col_idx = names.col_idx
WHERE nb.row_idx > hdr.header_row""",
    "consolidated": with_ctes(CELLS, HEADERS, CONSOLIDATED) + "SELECT * FROM consolidated",
    "audit_consolidated": with_ctes(VOUCHER_CELLS, HEADERS, CONSOLIDATED, """
vouchers AS (SELECT voucher_no, doc_date, vendor_code, vendor_name, term_name, planned_pay_date FROM consolidated)""",
                                    AUDITED) + "SELECT * FROM audited",
    "consolidated_file_log": with_ctes(CELLS, HEADERS, CONSOLIDATED) + """
SELECT source_folder, source_file, sheet_name, count(*) AS rows FROM consolidated
GROUP BY source_folder, source_file, sheet_name""",
    "consolidated_errors": with_ctes(CELLS, HEADERS) + """
SELECT DISTINCT file, sheet, 'header row not found' AS error FROM cells c
WHERE NOT EXISTS (SELECT 1 FROM hdr WHERE hdr.file = c.file AND hdr.sheet = c.sheet)""",
})


# ---- register frames ----------------------------------------------------------------
_CRC_STEP = ("list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda c, j: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 40961) "
             "ELSE c >> 1 END, xor(acc, x))")
FRAMES = f"""
frames AS (
 SELECT event_id, ts, concat(lpad(hex(user_id % 247 + 1), 2, '0'),
  CASE WHEN event_id % 40 = 0 THEN '8302' ELSE
   concat('0304', lpad(hex(CAST(floor(value * 10) AS BIGINT) % 65536), 4, '0'),
          CASE WHEN event_id % 25 = 0 THEN '' ELSE lpad(hex(event_id % 65536), 4, '0') END) END) AS body_hex
 FROM events),
fb AS (SELECT event_id, body_hex,
  list_transform(range(0, length(body_hex) // 2), lambda i: CAST('0x' || substr(body_hex, 2 * i + 1, 2) AS INTEGER)) AS b
 FROM frames),
fc AS (SELECT *, list_reduce(b, lambda acc, x: {_CRC_STEP}, 65535) AS crc FROM fb),
fr AS (SELECT event_id, body_hex, crc, b, len(b) + 2 AS n, b[1] AS address, b[2] AS function, b[3] AS cnt FROM fc),
replies AS (
 SELECT event_id, address, function, CASE WHEN (function & 128) = 0 THEN cnt END AS byte_count,
  CASE WHEN n < 3 THEN 'short' WHEN (function & 128) > 0 THEN 'exception' WHEN n < cnt + 5 THEN 'short' ELSE 'ok' END AS status,
  CASE WHEN (function & 128) > 0 THEN cnt END AS exception_code, b, cnt
 FROM fr),
regs AS (
 SELECT event_id, address, function, list_transform(range(1, cnt // 2 + 1), lambda k: b[2 * k + 2] * 256 + b[2 * k + 3]) AS r
 FROM replies WHERE status = 'ok'),
windows AS (SELECT event_id, [0, 20, 100, 200][event_id % 4 + 1] AS start FROM events),
blocks AS (
 SELECT regs.event_id, address AS unit, CASE WHEN function = 4 THEN '3x' ELSE '4x' END AS base,
  (CASE WHEN function = 4 THEN 30001 ELSE 40001 END) + start AS address_from,
  (CASE WHEN function = 4 THEN 30001 ELSE 40001 END) + start + len(r) - 1 AS address_to,
  array_to_string(list_slice(r, 1, 8), ' ') AS words, r
 FROM regs JOIN windows ON regs.event_id = windows.event_id)"""

_FLOAT = """CASE WHEN len(r) >= 2 THEN
 (CASE WHEN ((CAST(r[2] AS BIGINT) * 65536 + r[1]) >> 31) & 1 = 1 THEN -1.0 ELSE 1.0 END) *
 CASE WHEN ((CAST(r[2] AS BIGINT) * 65536 + r[1]) >> 23) & 255 = 255 THEN
       CASE WHEN (CAST(r[2] AS BIGINT) * 65536 + r[1]) & 8388607 = 0 THEN 'inf'::DOUBLE ELSE 'nan'::DOUBLE END
      WHEN ((CAST(r[2] AS BIGINT) * 65536 + r[1]) >> 23) & 255 = 0 THEN CAST((CAST(r[2] AS BIGINT) * 65536 + r[1]) & 8388607 AS DOUBLE) * pow(2.0, -149)
      ELSE (1.0 + CAST((CAST(r[2] AS BIGINT) * 65536 + r[1]) & 8388607 AS DOUBLE) / 8388608.0)
           * pow(2.0, (((CAST(r[2] AS BIGINT) * 65536 + r[1]) >> 23) & 255) - 127) END END"""

_GRID = ", ".join(f"({u}, '{b}', {s}, 16)" for u in (0, 1, 255) for b in ("3x", "4x") for s in (0, 20, 100, 200))

ORACLE.update({
    "frame_crc": with_ctes(FRAMES) + """
SELECT event_id, crc, upper(body_hex || lpad(hex(crc & 255), 2, '0') || lpad(hex(crc >> 8), 2, '0')) AS frame_hex,
 true AS crc_ok FROM fc""",
    "frame_replies": with_ctes(FRAMES) + """
SELECT event_id, address, function, byte_count, status, exception_code FROM replies""",
    "frame_registers": with_ctes(FRAMES) + """
SELECT event_id, address, CAST(k AS INTEGER) AS reg_index, b[2 * k + 2] * 256 + b[2 * k + 3] AS value,
 lower(hex(b[2 * k + 2] * 256 + b[2 * k + 3])) AS value_hex,
 CAST((b[2 * k + 2] * 256 + b[2 * k + 3]) // 10 AS INTEGER) AS scaled_int,
 (b[2 * k + 2] * 256 + b[2 * k + 3]) / 10.0 AS scaled
FROM replies, range(1, cnt // 2 + 1) t(k) WHERE status = 'ok'""",
    "frame_requests": """
WITH rq AS (SELECT event_id, CAST(user_id % 247 + 1 AS INTEGER) AS address, 3 AS function,
  [0, 20, 100, 200][event_id % 4 + 1] AS start, 2 AS count FROM events),
rb AS (SELECT *, [address, function, start >> 8, start & 255, count >> 8, count & 255] AS b FROM rq),
rc AS (SELECT *, list_reduce(b, lambda acc, x: """ + _CRC_STEP + """, 65535) AS crc FROM rb)
SELECT event_id, address, function, start, count,
 upper(lpad(hex(address), 2, '0') || lpad(hex(function), 2, '0') || lpad(hex(start), 4, '0') || lpad(hex(count), 4, '0')
       || lpad(hex(crc & 255), 2, '0') || lpad(hex(crc >> 8), 2, '0')) AS request_hex
FROM rc""",
    "register_float": with_ctes(FRAMES) + f"""
SELECT event_id, unit, base, address_from, address_to, words, {_FLOAT} AS float_swapped FROM blocks""",
    "probe_coverage": with_ctes(FRAMES) + f"""
, grid AS (SELECT * FROM (VALUES {_GRID}) g(unit, base, start, length)),
reads AS (SELECT unit, base, address_from - CASE WHEN base = '3x' THEN 30001 ELSE 40001 END AS start, count(*) AS reads
          FROM blocks GROUP BY ALL)
SELECT grid.unit, grid.base, grid.start, length,
 CASE WHEN grid.base = '3x' THEN 30001 ELSE 40001 END + grid.start AS address_from,
 CASE WHEN grid.base = '3x' THEN 30001 ELSE 40001 END + grid.start + length - 1 AS address_to,
 coalesce(reads, 0) AS reads, reads IS NOT NULL AS hit
FROM grid LEFT JOIN reads ON grid.unit = reads.unit AND grid.base = reads.base AND grid.start = reads.start""",
})


# ---- sensor readings ----------------------------------------------------------------
READINGS = """
readings AS (
 SELECT event_id, ts, CASE WHEN event_id % 50 = 0 THEN '{H00rdd 1;--.--;}' ELSE
  concat('{H00rdd 1;', CAST(CAST(30 + value % 60 AS DECIMAL(6,3)) AS VARCHAR), '; %rh;0;-;',
         CAST(CAST(15 + user_id % 20 AS DECIMAL(6,3)) AS VARCHAR), ';  °C;0;HF5;000;]') END AS raw
 FROM events)"""


def _parsed_sql(variant: str) -> str:
    text = "replace(replace(raw, '°C', 'degC'), '%rh', '%RH')"
    after_space = f"CASE WHEN strpos({text}, ' ') > 0 THEN substr({text}, strpos({text}, ' ') + 1) ELSE {text} END"
    if variant == "A":
        payload = after_space
    else:
        payload = (f"CASE WHEN strpos({text}, 'rdd') > 0 THEN substr({text}, strpos({text}, 'rdd') + 3) "
                   f"ELSE {after_space} END")
    num = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
    return f"""
p0 AS (SELECT event_id, ts, raw,
  list_transform(string_split(trim({payload}, ' ]' || chr(13) || chr(10)), ';'), lambda q: {strip_sql('q')}) AS f
 FROM readings),
parsed AS (SELECT event_id, ts, raw,
  CASE WHEN regexp_full_match(f[2], '{num}') THEN TRY_CAST(f[2] AS DOUBLE) END AS rh,
  CASE WHEN regexp_full_match(f[6], '{num}') THEN TRY_CAST(f[6] AS DOUBLE) END AS temp_c,
  f[3] AS rh_unit, f[5] AS trend, f[7] AS temp_unit, len(f) AS nf FROM p0),
judged AS (SELECT *, CASE WHEN nf < 7 THEN 'too few fields' WHEN rh IS NULL OR temp_c IS NULL THEN 'not a number' END
  AS reject_reason FROM parsed),
good AS (SELECT event_id, ts, rh, temp_c, rh_unit, trend, temp_unit FROM judged WHERE reject_reason IS NULL)"""


ORACLE.update({
    "readings_parsed": with_ctes(READINGS, _parsed_sql("A")) + "SELECT * FROM good",
    "readings_parsed_rdd": with_ctes(READINGS, _parsed_sql("B")) + "SELECT * FROM good",
    "readings_rejected": with_ctes(READINGS, _parsed_sql("A")) + """
SELECT event_id, ts, raw, reject_reason FROM judged WHERE reject_reason IS NOT NULL""",
    "readings_stats": with_ctes(READINGS, _parsed_sql("A")) + """
SELECT CAST(ts AS DATE) AS day, count(*) AS n,
 CAST(sum(CAST(rh AS DECIMAL(12,3))) AS DOUBLE) / count(*) AS rh_avg, min(rh) AS rh_min, max(rh) AS rh_max,
 CAST(sum(CAST(temp_c AS DECIMAL(12,3))) AS DOUBLE) / count(*) AS temp_c_avg, min(temp_c) AS temp_c_min,
 max(temp_c) AS temp_c_max
FROM good GROUP BY CAST(ts AS DATE)""",
    "readings_dew_point": with_ctes(READINGS, _parsed_sql("A")) + """
SELECT event_id, ts, rh, temp_c,
 round(CASE WHEN rh > 0 THEN ((ln(rh / 100.0) + (temp_c * 17.625) / (temp_c + 243.04)) * 243.04)
   / (17.625 - (ln(rh / 100.0) + (temp_c * 17.625) / (temp_c + 243.04))) END, 4) AS dew_point_c
FROM good""",
})


# ---- extract, keyword list, incremental pick, latest file, text functions -----------
_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_C0 = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"


def lenient_date_sql(e: str) -> str:
    d = f"translate({strip_sql(e)}, './', '--')"
    fmts = ["%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y%m%d", "%m-%d-%Y", "%d-%m-%Y"]
    return "coalesce(" + ", ".join(f"CAST(try_strptime({d}, '{f}') AS DATE)" for f in fmts) + ")"


ORACLE.update({
    "extract_top": f"""
SELECT *, concat_ws(chr(9), {", ".join(f"coalesce(CAST({c} AS VARCHAR), 'None')" for c in _ORDER_COLS)}) AS line
FROM orders ORDER BY o_orderkey LIMIT 100""",
    "keyword_excluded": """
SELECT event_id, ts, user_id, event_type, value FROM events WHERE NOT coalesce(contains(event_type, 'error'), false)""",
    "incremental_pick": """
WITH src AS (SELECT concat('O', CAST(o_orderkey AS VARCHAR)) AS name, o_orderdate AS mtime FROM orders),
man AS (SELECT concat('O', CAST(o_orderkey AS VARCHAR)) AS name,
  o_orderdate + CASE WHEN o_orderkey % 3 = 1 THEN INTERVAL '-1' DAY ELSE INTERVAL '1' DAY END AS mtime
  FROM orders WHERE o_orderkey % 3 <> 0)
SELECT src.name, src.mtime, CASE WHEN man.mtime IS NULL THEN 'missing' ELSE 'newer' END AS reason
FROM src LEFT JOIN man ON src.name = man.name WHERE man.mtime IS NULL OR src.mtime > man.mtime""",
    "latest_file": r"""
WITH l AS (
 SELECT event_type AS folder,
  concat(event_type, '/', CASE WHEN event_id % 7 = 0 THEN concat('report_', CAST(event_id AS VARCHAR), '.xlsx')
    ELSE concat('TOTAL_', strftime(ts, '%Y%m%d_%H%M'), '.xlsx') END) AS path,
  CASE WHEN event_id % 7 = 0 THEN ts + INTERVAL 1 HOUR ELSE ts END AS mtime
 FROM events),
t AS (SELECT folder, path, coalesce(
  try_strptime(regexp_extract(path, 'TOTAL_(\d{8})_(\d{4})', 1) || regexp_extract(path, 'TOTAL_(\d{8})_(\d{4})', 2), '%Y%m%d%H%M'),
  mtime) AS ts FROM l),
r AS (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY ts DESC, path DESC) AS rn FROM t)
SELECT folder, path AS latest_file, CAST(ts AS TIMESTAMP) AS file_ts FROM r WHERE rn = 1""",
    "clean_text": f"""
WITH c AS (SELECT doc_id, regexp_replace(text, '{_ILLEGAL}', '', 'g') AS whole, substring({clean_cell_sql('text')}, 1, 32767) AS cell,
  coalesce(regexp_replace(text, '{_C0}', '', 'g'), '') AS report FROM documents)
SELECT doc_id, CAST(length(whole) AS INTEGER) AS full_len, md5(whole) AS full_md5,
 CAST(length(cell) AS INTEGER) AS clean_len, md5(cell) AS clean_md5,
 CAST(length(report) AS INTEGER) AS report_len, md5(report) AS report_md5 FROM c""",
    "parse_amount": with_ctes(CELLS) + f"""
SELECT file, sheet, row_idx, col_idx, value, {number_sql('value')} AS number FROM cells""",
    "parse_dates": with_ctes(CELLS) + f"""
SELECT file, sheet, row_idx, col_idx, value, {sheet_date_sql('value')} AS sheet_date,
 {lenient_date_sql('value')} AS lenient_date FROM cells""",
})

ORACLE["readings_stream"] = ORACLE["readings_parsed"]


# ---- more report tables and options -------------------------------------------------
def _report_sql(status: str) -> str:
    cols = ["voucher_no", "vendor_code", "vendor_name", "term_code", "term_name", "basis"]
    cleaned = {c: f"coalesce(regexp_replace({c}, '{_C0}', '', 'g'), '') AS {c}" for c in cols}
    sel = ", ".join([cleaned["voucher_no"], "doc_date", cleaned["vendor_code"], cleaned["vendor_name"],
                     cleaned["term_code"], cleaned["term_name"], "planned_pay_date", "expected_pay_date",
                     "days_diff", cleaned["basis"]])
    return AUDIT + f"SELECT {sel} FROM audited WHERE audit_status = '{status}'"


_TEXT_COLS = ["voucher_no", "vendor_code", "vendor_name", "term_code", "term_name", "source_folder",
              "source_file", "sheet_name"]
_SUBTOTAL = " OR ".join(f"coalesce(starts_with({strip_sql(c)}, '小結'), false)" for c in _TEXT_COLS)
_CONS = with_ctes(CELLS, HEADERS, CONSOLIDATED)

ORACLE.update({
    "audit_skipped": _report_sql("skipped"),
    "audit_unsupported": _report_sql("unsupported"),
    "spend_consolidated_vendor": _CONS + f"""
, r AS (SELECT NULLIF({strip_sql('vendor_name')}, '') AS vendor_name, CAST(amount AS DECIMAL(18,2)) AS amount
        FROM consolidated WHERE NOT ({_SUBTOTAL})),
agg AS (SELECT vendor_name, sum(amount) AS amount FROM r WHERE amount IS NOT NULL AND vendor_name IS NOT NULL
        GROUP BY vendor_name),
s AS (SELECT vendor_name, CAST(amount AS DOUBLE) AS amount,
      CAST(amount AS DOUBLE) * 100.0 / CAST((SELECT sum(amount) FROM agg) AS DOUBLE) AS pct FROM agg)
SELECT vendor_name, amount, pct, CASE WHEN pct >= 2.0 THEN printf('%.1f%%', pct) ELSE '' END AS label FROM s""",
    "spend_quality": _CONS + f"""
SELECT count(*) AS rows, count(*) FILTER (WHERE {_SUBTOTAL}) AS subtotal_rows,
 count(*) FILTER (WHERE NOT ({_SUBTOTAL}) AND (NULLIF({strip_sql('vendor_name')}, '') IS NULL OR amount IS NULL))
  AS missing_category_or_amount
FROM consolidated""",
    "consolidated_sorted": _CONS + "SELECT * FROM consolidated",
    "consolidated_indexed": _CONS + """SELECT *, row_number() OVER (ORDER BY voucher_date, source_folder NULLS LAST,
 source_file, sheet_name, source_row) - 1 AS pos FROM consolidated""",
    "readings_window": with_ctes(READINGS, _parsed_sql("A")) + """
SELECT date_trunc('hour', ts) AS hour, count(*) AS n,
 CAST(sum(CAST(rh AS DECIMAL(12,3))) AS DOUBLE) / count(*) AS rh_avg, min(rh) AS rh_min, max(rh) AS rh_max,
 CAST(sum(CAST(temp_c AS DECIMAL(12,3))) AS DOUBLE) / count(*) AS temp_c_avg, min(temp_c) AS temp_c_min,
 max(temp_c) AS temp_c_max
FROM good WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' GROUP BY date_trunc('hour', ts)""",
    "diff_distinct_keys": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey % 10 <> 0",
    "diff_only_left_first": with_ctes(DIFF) + """
, cl AS (SELECT l_orderkey, l_linenumber, count(*) AS nl FROM dl GROUP BY ALL),
cr AS (SELECT l_orderkey, l_linenumber, count(*) AS nr FROM dr GROUP BY ALL)
SELECT dl.l_orderkey, dl.l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_shipdate
FROM dl JOIN cl ON dl.l_orderkey = cl.l_orderkey AND dl.l_linenumber = cl.l_linenumber
LEFT JOIN cr ON dl.l_orderkey = cr.l_orderkey AND dl.l_linenumber = cr.l_linenumber
WHERE dl.occ <= nl - coalesce(nr, 0)""",
})

ORACLE["sensor_log"] = with_ctes(READINGS, _parsed_sql("A")) + """
, log AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y/%m/%d %H:%M')
   ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS timestamp, rh, temp_c FROM good)
SELECT event_id, timestamp, coalesce(try_strptime(timestamp, '%Y/%m/%d %H:%M'),
 try_strptime(timestamp, '%Y-%m-%d %H:%M:%S')) AS ts, rh, temp_c FROM log"""

ORACLE["readings_rollup_stream"] = with_ctes(READINGS, _parsed_sql("A")) + """
SELECT date_trunc('hour', ts) AS bucket, count(*) AS n,
 CAST(sum(CAST(rh AS DECIMAL(12,3))) AS DOUBLE) / count(*) AS rh_avg, min(rh) AS rh_min, max(rh) AS rh_max,
 CAST(sum(CAST(temp_c AS DECIMAL(12,3))) AS DOUBLE) / count(*) AS temp_c_avg, min(temp_c) AS temp_c_min,
 max(temp_c) AS temp_c_max
FROM good GROUP BY date_trunc('hour', ts)"""

ORACLE["extract_range"] = f"""
SELECT *, concat_ws(chr(9), {", ".join(f"coalesce(CAST({c} AS VARCHAR), 'None')" for c in _ORDER_COLS)}) AS line
FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'"""

ORACLE["daily_catch_up"] = with_ctes(READINGS, _parsed_sql("A")) + """
SELECT CAST(ts AS DATE) AS day, CASE WHEN day(ts) <= 14 THEN 'first' ELSE 'second' END AS run, count(*) AS n,
 CAST(sum(CAST(rh AS DECIMAL(12,3))) AS DOUBLE) / count(*) AS rh_avg, min(rh) AS rh_min, max(rh) AS rh_max,
 CAST(sum(CAST(temp_c AS DECIMAL(12,3))) AS DOUBLE) / count(*) AS temp_c_avg, min(temp_c) AS temp_c_min,
 max(temp_c) AS temp_c_max
FROM good GROUP BY 1, 2"""

ORACLE["keyword_table_excluded"] = """
WITH kw AS (SELECT DISTINCT unnest(string_split(text, '. ')) AS keyword FROM benchmark)
SELECT doc_id, source, lang, n_chars FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM kw WHERE keyword <> '' AND contains(d.text, kw.keyword))"""

ORACLE["diff_text_dates"] = """
WITH r AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS t, CAST(o_orderdate AS DATE) AS d, CAST(o_custkey + 40000 AS VARCHAR) AS code FROM orders)
SELECT t AS key_1, 'written' AS "column", strftime(d, '%Y-%m-%d') AS left_value,
 strftime(d + INTERVAL 1 DAY, '%Y-%m-%d') AS right_value, CAST(1 AS BIGINT) AS multiplicity FROM r WHERE k % 13 = 0
UNION ALL SELECT t, 'code', code, code || '.0', 1 FROM r WHERE k % 11 = 0"""

_WRITTEN = ["%-d %B %Y", "%b %-d, %Y", "%d-%b-%y", "%A, %-d %B %Y", "%-m/%-d/%y", "%d.%m.%Y", "%Y-%m-%dT%H:%M:%S",
            "%Y%m%d%H%M%S", "%m/%d/%Y %I:%M %p", "%Y %b %d", "30 Feb %Y", "week %-d %Y"]
_READ = ["%d %B %Y", "%b %d, %Y", "%d-%b-%y", "%A, %d %B %Y", "%m/%d/%y", "%m.%d.%Y", "%d.%m.%Y", "%Y-%m-%dT%H:%M:%S",
         "%Y%m%d%H%M%S", "%m/%d/%Y %I:%M %p", "%Y %b %d"]
ORACLE["parse_dates_free"] = f"""
WITH w AS (SELECT o_orderkey, CASE o_orderkey % {len(_WRITTEN)}
 {" ".join(f"WHEN {i} THEN strftime(o_orderdate, '{f}')" for i, f in enumerate(_WRITTEN))} END AS value FROM orders)
SELECT o_orderkey, value, coalesce({", ".join(f"CAST(try_strptime(value, '{f}') AS DATE)" for f in _READ)}) AS lenient_date
FROM w"""
