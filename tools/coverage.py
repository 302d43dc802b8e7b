"""
the registered queries that exercise it (from the id tags in docstrings/comments and the
README query table).  ``python tools/coverage.py > COVERAGE.md``"""

from __future__ import annotations

import glob
import os
import re

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
GROUPS = {"S": 12, "K": 8, "H": 13, "P": 13, "J": 9, "A": 13, "W": 4, "O": 6, "U": 4, "F": 14, "D": 11,
          "M": 12, "R": 5}


def expand(text: str) -> set[str]:
    """Ids named in a text, ranges like 'D1-D11' or 'P2-P5' expanded."""
    ids = set()
    for m in re.finditer(r"\b([SKHPJAWOUFDMR])(\d+)(?:-\1?(\d+))?\b", text):
        k, lo, hi = m.group(1), int(m.group(2)), m.group(3)
        for i in range(lo, int(hi) + 1 if hi else lo + 1):
            if i <= GROUPS[k]:
                ids.add(f"{k}{i}")
    return ids


def main() -> None:
    where: dict[str, set[str]] = {}
    for path in sorted(glob.glob(os.path.join(ROOT, "tallyho", "**", "*.py"), recursive=True)):
        rel = os.path.relpath(path, ROOT)
        for tag in expand(open(path, encoding="utf-8").read()):
            where.setdefault(tag, set()).add(rel.replace("tallyho/", ""))
    import sys
    sys.path.insert(0, ROOT)
    from tallyho.plans.catalog import QUERIES, QUERY_OPS
    queries: dict[str, list[str]] = {}
    for name in QUERIES:
        for tag in expand(QUERY_OPS.get(name, "")):
            queries.setdefault(tag, []).append(name)
    print("# SURVEY section 2 coverage\n")
    print("Generated by `python tools/coverage.py`. `modules` = where the operator is implemented (by its id tag);")
    print("`queries` = registered queries (checked against DuckDB) that exercise it; ids without a query are")
    print("covered by tests under `tests/` (see README, library-only items).\n")
    print("| id | modules | queries |")
    print("| --- | --- | --- |")
    for k, n in GROUPS.items():
        for i in range(1, n + 1):
            tag = f"{k}{i}"
            mods = ", ".join(sorted(where.get(tag, []))) or "**missing**"
            qs = ", ".join(sorted(set(queries.get(tag, []))))
            print(f"| {tag} | {mods} | {qs} |")


if __name__ == "__main__":
    main()
