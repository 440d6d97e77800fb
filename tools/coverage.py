"""Print inventory row -> registered queries (with or without SQL check)."""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cardloom.catalog import load


def main() -> None:
    rows: dict[str, list[str]] = {}
    for name, q in load().items():
        for row in q.rows:
            rows.setdefault(row, []).append(name + ("" if q.sql else " (rows only)"))
    for row in sorted(rows, key=lambda r: (r[0], int(re.sub(r"\D", "", r)), r)):
        print(f"{row:5} {', '.join(rows[row])}")


if __name__ == "__main__":
    main()
