"""Write PLANS.md: the plans of everything a headline query runs, its writes too.

Usage: python tools/plans_report.py [sf_dir]
Every key runs once with broadcasts off (the shape at scale). Spark's event log,
in the scratch folder, holds the final adaptive plan of each execution; those with
an exchange, or else the last one, are recorded with their nodes in short.
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from bench import HEADLINE  # noqa: E402
from lakevault.plans.standins import QUERIES  # noqa: E402
from lakevault.session import build_session  # noqa: E402

#: keys beside the bench's whose plans tell how a merge or an incremental mart works
MERGES = [
    "dim_scd2_merge", "sat_point_in_time", "cdc_merge_on_read", "mart_delta_refresh", "mart_active_customers", "mart_star_regions",
    "stream_dedupe_accounted", "forget_by_key",
]
SKIPPED = re.compile(r"WholeStageCodegen|InputAdapter|ColumnarToRow|AdaptiveSparkPlan|ShuffleQueryStage|AQEShuffleRead|TableCacheQueryStage")
MARK = "plans-report:"


def tree(node: dict, depth: int = 0) -> list[str]:
    lines = []
    if not SKIPPED.match(node["nodeName"]):
        text = re.sub(r"#\d+L?|, \[plan_id=\d+\]|\(\d+\) ", "", node["simpleString"])
        text = re.sub(r"file:[^,\]\s)]*/lakevault/[^,\]\s)]*", "<scratch>", text)
        text = re.sub(r"Location: \w+\(\d+ paths\)\[[^\]]*\](, )?|Format: \w+, |Batched: \w+, ", "", text)
        lines.append("  " * depth + (text if len(text) <= 180 else text[:177] + "..."))
        depth += 1
    for child in node["children"]:
        lines += tree(child, depth)
    return lines


def executions(log_dir: str) -> dict[str, list[dict]]:
    """Final plan of each execution, by the query whose job description was set."""
    found: dict[int, tuple[str, dict]] = {}
    for path in glob.glob(f"{log_dir}/*"):
        with open(path, errors="replace") as lines:
            for line in lines:
                if '"sparkPlanInfo"' not in line:
                    continue
                event = json.loads(line)
                key = event["executionId"]
                said = event.get("description", "")
                name = said.removeprefix(MARK) if said.startswith(MARK) else found.get(key, ("", None))[0]
                found[key] = (name, event["sparkPlanInfo"])
    by_name: dict[str, list[dict]] = {}
    for key in sorted(found):
        by_name.setdefault(found[key][0], []).append(found[key][1])
    return by_name


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    logs = tempfile.mkdtemp(prefix="plans-")
    spark = build_session(
        "local[8]",
        **{"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{logs}", "spark.eventLog.rolling.enabled": "false",
           "spark.eventLog.compress": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "300"},
    )
    for name in [*HEADLINE, *MERGES]:
        spark.sparkContext.setJobDescription(MARK + name)
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    spark.stop()
    out = [
        "# Plans of the headline queries",
        "",
        f"Generated by `tools/plans_report.py` at `{os.path.basename(sf.rstrip('/'))}`: the final adaptive plans of the",
        "executions with an exchange that a key runs, its loads' writes included, with broadcast joins off (the",
        "shape at scale; within the threshold Spark broadcasts by measured size). A key without one shows its last plan.",
        "",
    ]
    plans = executions(logs)
    for name in [*HEADLINE, *MERGES]:
        mine = [tree(p) for p in plans.get(name, [])]
        chosen = [t for t in mine if any("Exchange" in x for x in t)] or mine[-1:]
        shuffles = sum(x.strip().startswith("Exchange") for t in chosen for x in t)
        out += [f"## {name}", "", f"{len(mine)} executions, {shuffles} exchanges in all.", ""]
        seen = set()
        for t in chosen:
            text = "\n".join(t[:40])
            if text not in seen:
                out += ["```", text, "```", ""]
            seen.add(text)
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
