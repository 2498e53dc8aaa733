"""Write PLANS.md: the physical plans of the queries whose shape matters at scale.

Usage: python tools/dump_plans.py [sf_dir]
Plans are printed after execution (AQE final plans), trimmed to operator names
and the first part of each line so the shape is readable.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tollgate.plans.catalog import QUERIES  # noqa: E402
from tollgate.session import get_session  # noqa: E402

SHOWN = {
    "decide": "flagship: scan -> spread -> one projection of all detectors -> per-row top-1; no other exchange",
    "payload_conversation": "two-phase: size aggregate (partial) reused; text gathered only for bounded payloads",
    "outage_episodes": "chunked gaps-and-islands: (endpoint, minute) windows, chunk totals partial-aggregated",
    "retry_resolve": "one partial aggregate with min(struct); no window",
    "quota_month": "per-minute counts pin the crossing; ranking only inside the crossing minute",
    "detect_domain": "parent-domain explode + broadcast equi join with the blocklist",
    "blocked_report": "staged sanitised verdicts joined to requests",
    "src_messages": "role filter and column pruning pushed into the parquet scan",
    "detect_pii": "findings flattened after the projection; no regex in the scan filter",
    "conversation_decisions": "gates before detectors; detectors only on rows that reach the scan",
}
WIDTH = 150


def _short(line: str) -> str:
    """Cut a plan line; scan lines keep their pushed filters and read schema."""
    if "FileScan" not in line:
        return line[:WIDTH]
    head = line[:line.index("]") + 1] if "]" in line else line[:WIDTH]
    extra = [m.group(0) for m in re.finditer(r"(PushedFilters: \[[^\]]*\]|ReadSchema: \S+)", line)]
    return head + " ... " + ", ".join(extra)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=16)
    out = ["# PLANS", "",
           f"AQE final physical plans at `{sf}` (`tools/dump_plans.py`), lines cut at {WIDTH} characters.", ""]
    for name, why in SHOWN.items():
        df = QUERIES[name](spark, sf)
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        raw = [ln for ln in buf.getvalue().splitlines() if ln.strip()]
        cut = next((i for i, ln in enumerate(raw) if "== Initial Plan ==" in ln), None)
        lines = [_short(ln) for ln in (raw[:cut] if cut else raw)]   # final plan only
        out += [f"## `{name}`", "", why, "", "```", *lines, "```", ""]
    Path(__file__).resolve().parents[1].joinpath("PLANS.md").write_text("\n".join(out))


if __name__ == "__main__":
    main()
