"""``.xlsx`` workbooks -> long ``cells`` rows, distributed one workbook per task.

``binaryFile`` lists and loads the workbooks; ``mapInPandas`` opens each one with the
standard library (an ``.xlsx`` is a zip of XML parts) and emits one row per non-empty
cell: ``folder, file, sheet, sheet_idx, row_idx, col_idx, value``.  Values are text as
stored: shared/inline strings as written, numbers (and dates, which a workbook stores as
day serials) as their number text -- the date functions accept serials.  A workbook that
cannot be read yields one row in ``error`` instead of failing the job (H13).
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
_REF = re.compile(r"([A-Z]+)(\d+)")

CELL_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("sheet", T.StringType()),
    T.StructField("sheet_idx", T.IntegerType()), T.StructField("row_idx", T.LongType()),
    T.StructField("col_idx", T.IntegerType()), T.StructField("value", T.StringType()),
    T.StructField("error", T.StringType()),
])


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(node) -> str:
    """Text of a string item: its own text and its runs, without phonetic hints."""
    return "".join(t.text or "" for path in ("m:t", "m:r/m:t") for t in node.findall(path, _NS))


def workbook_cells(data: bytes, first_sheet_only: bool = False):
    """Yield ``(sheet, sheet_idx, row_idx, col_idx, value)`` for every non-empty cell."""
    with zipfile.ZipFile(io.BytesIO(data)) as zf:
        names = set(zf.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            root = ET.fromstring(zf.read("xl/sharedStrings.xml"))
            shared = [_text(si) for si in root.findall("m:si", _NS)]
        rels = {}
        if "xl/_rels/workbook.xml.rels" in names:
            for rel in ET.fromstring(zf.read("xl/_rels/workbook.xml.rels")).findall("rel:Relationship", _NS):
                rels[rel.get("Id")] = rel.get("Target")
        wb = ET.fromstring(zf.read("xl/workbook.xml"))
        sheets = wb.findall("m:sheets/m:sheet", _NS)
        missing = []
        for idx, sh in enumerate(sheets):
            if first_sheet_only and idx > 0:
                break
            target = rels.get(sh.get(f"{{{_NS['r']}}}id"), f"worksheets/sheet{idx + 1}.xml")
            part = target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join("xl", target))
            if part not in names:
                missing.append(f"{sh.get('name')} ({part})")
                continue
            # stream the sheet: rows are handled as they are parsed and then released,
            # so a very large sheet never sits in memory as a whole
            row_tag = f"{{{_NS['m']}}}row"
            for _event, row in ET.iterparse(zf.open(part), events=("end",)):
                if row.tag != row_tag:
                    continue
                r_attr = row.get("r")
                for pos, c in enumerate(row.findall("m:c", _NS)):
                    ref = c.get("r")
                    m = _REF.match(ref or "")
                    col = _col_index(m.group(1)) if m else pos
                    row_no = int(m.group(2)) if m else int(r_attr)
                    kind = c.get("t")
                    if kind == "inlineStr":
                        value = _text(c.find("m:is", _NS)) if c.find("m:is", _NS) is not None else None
                    else:
                        v = c.find("m:v", _NS)
                        value = v.text if v is not None else None
                        if kind == "s" and value is not None:
                            value = shared[int(value)]
                        elif kind == "b" and value is not None:
                            value = "TRUE" if value == "1" else "FALSE"
                    if value is None or value == "":
                        continue
                    yield sh.get("name"), idx, row_no - 1, col, value
                row.clear()
        if missing:  # after the sheets that can be read
            raise ValueError(f"no part for sheet {', '.join(missing)}")


CHUNK_CELLS = 200_000   # cells per output batch (bounds the worker's memory)


def _read_batches(first_sheet_only: bool):
    cols = [f.name for f in CELL_SCHEMA.fields]

    def run(batches):
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    for sheet, sidx, r, c, v in workbook_cells(bytes(content), first_sheet_only):
                        out.append((path, sheet, sidx, r, c, v, None))
                        if len(out) >= CHUNK_CELLS:
                            yield pd.DataFrame(out, columns=cols)
                            out = []
                except Exception as exc:  # H13: the job continues, the file is reported
                    out.append((path, None, None, None, None, None, f"{type(exc).__name__}: {exc}"))
            if out:
                yield pd.DataFrame(out, columns=cols)
    return run


def read_workbooks(files: DataFrame, first_sheet_only: bool = False) -> DataFrame:
    """``files`` = a ``binaryFile`` DataFrame (``path, content``) -> cells + errors.

    Split the result with ``cells_of`` / ``errors_of``.  Each workbook is one unit of
    work; ``spark.sql.files.maxPartitionBytes`` decides how many share a task.
    """
    return files.select("path", "content").mapInPandas(_read_batches(first_sheet_only), CELL_SCHEMA)


def cells_of(raw: DataFrame) -> DataFrame:
    parts = F.split(F.col("path"), "/")
    return (raw.where(F.col("error").isNull())
            .select(F.element_at(parts, -2).alias("folder"), F.element_at(parts, -1).alias("file"),
                    "sheet", "sheet_idx", "row_idx", "col_idx", "value"))


def errors_of(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("error").isNotNull()).select(F.col("path").alias("file"), "error")
