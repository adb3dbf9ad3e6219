"""Write the executed (AQE final) physical plans of key queries to docs/PLANS.md.

usage: python scripts/explain_plans.py [--sf DIR] [names...]
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quire.plans import registry  # noqa: E402
from quire.session import build_session  # noqa: E402

DEFAULT = ["eval_weighted", "keyword_search", "vector_search", "invoice_index_record", "upsert_last_wins",
           "train_test_split", "class_report", "hybrid_rrf"]


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    spark = build_session("local[8]", 16)
    registry.load_all()
    out = ["# Executed physical plans", "",
           f"Generated by `scripts/explain_plans.py` on `{a.sf}` (local[8], AQE on). "
           "Each plan is the final adaptive plan after the query ran.", ""]
    for n in a.names or DEFAULT:
        df = registry.QUERIES[n](spark, a.sf)
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        out += [f"## {n}", "", "```", buf.getvalue().strip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out) + "\n")
    spark.stop()
    print(path)


if __name__ == "__main__":
    main()
