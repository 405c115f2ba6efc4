"""Write PLANS.md: the final (post-AQE) physical plan of each headline query.

Usage: python tools/plans.py [sf_dir]   (default /root/testdata/sf0.1)
Each query is executed once (``collect``) so that ``explain`` shows the adaptive plan Spark
actually ran; only the operator tree of ``explain("formatted")`` is kept.
"""

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clicklens.plans.registry import batch_queries  # noqa: E402
from clicklens.session import build_session  # noqa: E402

HEADLINE = ["hot_category_top10", "hot_category_session_top10", "page_conversion", "page_avg_dwell",
            "blacklist_users", "blacklist_filtered_counts", "ads_click_daily", "ads_area_top3_json",
            "ads_last_minute", "ads_sliding_60s"]


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    head, _, details = text.partition("\n\n\n")
    final = head.split("+- == Initial Plan ==")[0].rstrip()
    scans = []
    for block in details.split("\n\n"):
        if block.lstrip().startswith("(") and "Scan parquet" in block.splitlines()[0]:
            keep = [ln for ln in block.splitlines()
                    if ln.startswith(("(", "PushedFilters", "ReadSchema", "PartitionFilters"))]
            scans.append("\n".join(keep))
    return final + ("\n\n" + "\n\n".join(dict.fromkeys(scans)) if scans else "")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `python tools/plans.py {sf}` (`local[8]`, AQE on): the adaptive plan after one run.",
           ""]
    qs = batch_queries()
    for name in HEADLINE:
        df = qs[name](spark, sf)
        df.collect()
        out += [f"## {name}", "", "```", tree(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
