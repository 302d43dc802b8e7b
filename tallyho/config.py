"""Fixed values.

Everything in this module is data, not logic: header names, column aliases, payment-term
texts and thresholds whose exact values decide which rows match.  They are the values
the original voucher scripts use and must stay byte-identical (Chinese column and term
names included).  Operators receive them as default keyword arguments, so callers can
pass their own lists.
"""

# ---- fixed values: header detection -------------------------------------------------
# A row is the header row when at least HEADER_MIN_HITS of these names occur in it.
HEADER_KEYS = [
    "憑單日期", "憑單單號", "單據日期", "廠商代號", "廠商簡稱",
    "付款條件代號", "付款條件名稱", "預計付款日", "預計兌現日",
]
HEADER_MIN_HITS = 3

# ---- fixed values: column aliases, in priority order (first present wins) -----------
DATE_ALIASES = ["憑單日期", "憑單日", "憑單日期(西元)", "單據日期"]
AMOUNT_ALIASES = ["本幣貨款金額", "本幣金額", "金額(本幣)", "金額本幣", "金額"]
DOC_DATE_ALIASES = ["單據日期", "憑單日期"]
TERM_ALIASES = ["付款條件名稱", "付款條件", "付款條件說明"]
PLANNED_ALIASES = ["預計付款日", "應付日期", "付款日期"]
VOUCHER_NO_ALIASES = ["憑單單號", "單據編號", "憑單編號", "單號", "發票號碼"]
VENDOR_ALIASES = ["廠商簡稱", "廠商名稱", "供應商名稱", "供應商"]
VENDOR_CODE_ALIASES = ["廠商代號"]
TERM_CODE_ALIASES = ["付款條件代號"]
CASH_DATE_ALIASES = ["預計兌現日"]

# canonical column -> aliases; the consolidated voucher table uses these names
CANONICAL_ALIASES = {
    "voucher_date": DATE_ALIASES,
    "doc_date": DOC_DATE_ALIASES[:1],
    "voucher_no": VOUCHER_NO_ALIASES,
    "vendor_code": VENDOR_CODE_ALIASES,
    "vendor_name": VENDOR_ALIASES,
    "term_code": TERM_CODE_ALIASES,
    "term_name": TERM_ALIASES,
    "planned_pay_date": PLANNED_ALIASES,
    "cash_date": CASH_DATE_ALIASES,
    "amount": AMOUNT_ALIASES,
}
# when a sheet has no date alias, the date is taken from this grid column (0-based)
DATE_FALLBACK_COL_IDX = 1

# spend analysis: wider alias sets, matched after name normalisation (see text.norm_name)
SPEND_TERM_ALIASES = [
    "付款條件名稱", "付款條件", "付款條件代碼名稱", "付款條件說明",
    "paymentterms", "paymentterm", "terms", "termname", "paymenttermsname",
]
SPEND_AMOUNT_ALIASES = [
    "本幣貨款金額", "本幣金額", "本幣金額小計", "金額(本幣)", "金額本幣", "金額",
    "twd", "amounttwd", "amount(twd)", "amountntd", "ntdamount", "localamount",
    "amount", "amountlocal",
]
SPEND_VENDOR_ALIASES = ["廠商簡稱", "廠商名稱", "供應商名稱", "廠商代號", "供應商代號"]
# characters removed from a column name before alias matching (after trim + lower)
NAME_NOISE_CHARS = " _-()（）[]【】:："

# ---- fixed values: payment-term rules -----------------------------------------------
SKIP_TERMS = ["月結30天(EXW date)", "月結60天(FCA date)", "請財務部確認付款日"]
TERM_THIS_MONTH_15 = "當月15號"
TERM_THIS_MONTH_18 = "當月18號付款"
TERM_NEXT_MONTH_15 = "次月15號付款"
NET_DAYS_PREFIX = "月結"
NET_DAYS_SUFFIX = "天"
NET_DAYS_MONTH_END = {30: 1, 60: 2, 120: 4}   # net days -> months ahead, then month end
OVERRIDE_VENDOR = "南科管理局"                 # vendor whose next-month-15th term pays this month

# ---- fixed values: spend analysis ---------------------------------------------------
SUBTOTAL_PREFIX = "小結"
OTHER_LABEL = "其他"
TOP_K = 10
TOP_TERMS = 3
PCT_LABEL_MIN_TERM = 2.0
PCT_LABEL_MIN_VENDOR = 10.0
BLANK_TOKENS = ["", "nan", "nat"]

# ---- fixed values: table diff -------------------------------------------------------
# automatic key selection: from each group the first name present on both sides
KEY_CANDIDATE_GROUPS = [
    ["憑單單", "憑單號", "憑單編號", "憑單No", "憑單NO", "單號", "單據號", "單據編號"],
    ["序號", "項次", "行號", "Line", "line"],
    ["供應商代碼", "廠商代碼", "廠商代碼(代號)", "廠商代號", "VendorCode"],
]
# T13 (our addition): the voucher-number column of the consolidated table is tried first
# in group 1, otherwise a consolidated table only ever gets the vendor code as key
KEY_GROUP1_FIRST = ["憑單單號"]
NO_KEYS_LABEL = "(none)"

# ---- fixed values: file discovery ---------------------------------------------------
EXCLUDED_DIR_NAMES = ["total", "out", "compare", "__pycache__", "venv", ".venv", ".git"]
EXCLUDED_DIR_PARTS = ["backup", "_bak", "test"]
WORKBOOK_EXTENSIONS = ["xlsx", "xls"]
WORKBOOK_EXTENSIONS_WIDE = ["xlsx", "xls", "xlsm", "xlsb"]
SKIP_FILE_PREFIXES = ["~$"]
OWN_OUTPUT_PREFIXES = ["TOTAL_", "summary_", "TERMS_COMPARE_"]
OUTPUT_NAME_PATTERN = r"TOTAL_(\d{8})_(\d{4})"

# ---- fixed values: sensor replies and register frames ------------------------------
REPLY_MIN_FIELDS = 7
REPLY_RH_FIELD = 1
REPLY_TEMP_FIELD = 5
REPLY_TREND_FIELD = 4
UNIT_REPLACEMENTS = [("°C", "degC"), ("%rh", "%RH")]
CRC_INIT = 0xFFFF
CRC_POLY_REFLECTED = 0xA001
REGISTER_BASE_INPUT = 30001    # "3x" input registers
REGISTER_BASE_HOLDING = 40001  # "4x" holding registers
READ_PREFIX_REGISTERS = 8

# Dew point (Magnus formula).  The original only promises a dew point; these
# coefficients are our choice (Alduchov & Eskridge 1996).
MAGNUS_A = 17.625
MAGNUS_B = 243.04

# ---- fixed values: database extract -------------------------------------------------
EXTRACT_ROWS = 100
EXTRACT_NULL_TEXT = "None"
EXCLUDE_KEYWORDS = ["error"]

# ---- fixed values: register probe grid ----------------------------------------------
PROBE_UNITS = [0, 1, 255]
PROBE_BASES = ["3x", "4x"]
PROBE_WINDOWS = [(0, 16), (20, 16), (100, 16), (200, 16)]
FUNCTION_BY_BASE = {"3x": 4, "4x": 3}
