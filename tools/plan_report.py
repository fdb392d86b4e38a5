"""Print the physical-plan shape of every registered query as a markdown table.

usage: python tools/plan_report.py [sf_dir]

Per query: base tables scanned (and how often), shuffle exchanges, broadcast
exchanges, partial aggregates, top-k nodes, and whether any Python runs.
Only plans are built. Round trips write their files while being defined and are
listed as scans of ``scratch/...``. Views scan a written mart (``gold/...``): the
ETL that writes it (bronze, silver, gold) runs once before, and is not part of
their plans.
"""

from __future__ import annotations

import io
import os
import re
import sys
from collections import Counter
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def shape(text: str) -> dict[str, str]:
    tree = text.split("\n\n")[0]
    scans = Counter(
        m.group(1)
        for m in re.finditer(r"^Location: \w+ \[file:[^\]]*/(\w+\.parquet|gold/\w+|scratch/[a-z-]+?)(?:-[0-9a-f]{12})?\]", text, re.M)
    )
    shuffles = len(re.findall(r"[-+] Exchange \(", tree)) + len(re.findall(r"^Exchange \(", tree, re.M))
    return {
        "scans": ", ".join(f"{t}×{n}" if n > 1 else t for t, n in sorted((t.removesuffix(".parquet"), n) for t, n in scans.items())) or "–",
        "shuffles": str(shuffles),
        "broadcasts": str(tree.count("BroadcastExchange")),
        "partial agg": "yes" if "partial_" in text else "–",
        "top-k": "yes" if "TakeOrderedAndProject" in tree else "–",
        "python": "yes" if re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|FlatMapGroupsInPandas", text) else "–",
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from nimbusmart.plans.queries import REGISTRY
    from nimbusmart.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    cols = ["scans", "shuffles", "broadcasts", "partial agg", "top-k", "python"]
    print("| query | covers | " + " | ".join(cols) + " |")
    print("|---|---|" + "---|" * len(cols))
    for name, q in REGISTRY.items():
        s = shape(plan_text(q.fn(spark, sf_dir)))
        print(f"| `{name}` | {q.covers} | " + " | ".join(s[c] for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
