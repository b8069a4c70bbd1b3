"""Summaries of physical plans: what each headline query scans, pushes down,
shuffles, broadcasts and aggregates.

``python -m cdcmart.plans.explain [sf_dir] [query ...]`` prints, per query,
the scans (pushed filters, read schema), the exchanges, the joins and the
partial/final aggregation and window-limit steps of the executed plan (the
initial AQE plan), and whether any Python evaluation appears.
"""

from __future__ import annotations

import re
import sys

from pyspark.sql import DataFrame

PREFACE = """# Physical plans of the headline queries

Generated by `python -m cdcmart.plans.explain /root/testdata/sf0.1 > PLANS.md` (initial AQE
plans, `local[8]`, 8 shuffle partitions). What to look for:

* every scan reads only the columns it needs (`read`) and interval filters are
  pushed into the Parquet scan (`pushed`);
* `latest_per_key` shows a *partial* `WindowGroupLimit` below its exchange (rows
  reduced to one per key per map task before the shuffle);
* the marts and key checks aggregate partially before their exchange, and the
  unpivot is one `Expand` over one scan;
* merges never shuffle the full target on the broadcast plan; the broadcasts are
  of the measured U/D change set and of already-reduced key sets; at this scale
  Spark's own size estimates also pick broadcast joins for the shuffle plan;
* `replay_catchup` reads the per-(key, day) latest changes from one checkpoint
  (the feed is shuffled once) and joins the rows to a broadcast per-key summary;
* no Python evaluation and no cross or nested-loop joins anywhere.

"""

_NODE = re.compile(r"^[\s:+\-|]*(\*?\(\d+\)\s*)?(?P<name>[A-Za-z]+)")


def plan_text(df: DataFrame) -> str:
    """The physical plan tree as ``df.explain()`` prints it."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    return text.split("== Physical Plan ==", 1)[-1]


def summary(df: DataFrame) -> dict:
    text = plan_text(df)
    lines = text.splitlines()
    nodes = []
    for line in lines:
        m = _NODE.match(line)
        if m:
            nodes.append(m.group("name"))
    scans = []
    for line in lines:
        if "FileScan" in line or "Scan " in line and "ReadSchema" in line:
            table = re.search(r"Location: \w+\(\d+ paths?\)\[([^\]]+)\]", line)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            schema = re.search(r"ReadSchema: (struct<[^ ]*)", line)
            scans.append({"path": table.group(1).rsplit("/", 1)[-1] if table else "?",
                          "pushed": pushed.group(1) if pushed else "",
                          "read": schema.group(1) if schema else ""})
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                       r"CartesianProduct)[^\n]*?(Inner|LeftOuter|RightOuter|FullOuter|LeftSemi|LeftAnti)", text)
    return {
        "scans": scans,
        "exchanges": [ln.strip(" :+-") for ln in lines if "Exchange hashpartitioning" in ln
                      or "Exchange rangepartitioning" in ln or "Exchange SinglePartition" in ln
                      or "Exchange RoundRobin" in ln or "REBALANCE" in ln],
        "broadcasts": text.count("BroadcastExchange"),
        "joins": [f"{a} {b}" for a, b in joins],
        # map-side (partial) aggregates: an aggregate right below an exchange
        "partial_aggregates": sum(
            1 for a, b in zip(lines, lines[1:])
            if "Exchange " in a and re.search(r"(Hash|ObjectHash|Sort)Aggregate\(", b)),
        "window_group_limit": {"partial": len(re.findall(r"WindowGroupLimit [^\n]*, Partial", text)),
                               "final": len(re.findall(r"WindowGroupLimit [^\n]*, Final", text))},
        "expand": "Expand" in nodes,
        "python": any(k in text for k in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                                          "MapInPandas", "PythonUDF")),
        "cartesian": "CartesianProduct" in text or "BroadcastNestedLoopJoin" in text,
    }


def render(name: str, s: dict) -> str:
    out = [f"### {name}", ""]
    for sc in s["scans"]:
        out.append(f"- scan `{sc['path']}` read `{sc['read']}`"
                   + (f" pushed `{sc['pushed']}`" if sc["pushed"] else ""))
    out.append(f"- exchanges: {len(s['exchanges'])}"
               + ("".join(f"\n  - `{e[:140]}`" for e in s["exchanges"]) if s["exchanges"] else ""))
    out.append(f"- joins: {', '.join(s['joins']) or 'none'}; broadcast exchanges: {s['broadcasts']}")
    out.append(f"- partial aggregates: {s['partial_aggregates']}; window group limits "
               f"(partial/final): {s['window_group_limit']['partial']}/{s['window_group_limit']['final']}")
    out.append(f"- unpivot Expand: {s['expand']}; Python in plan: {s['python']}; cross/nested-loop join: "
               f"{s['cartesian']}")
    return "\n".join(out) + "\n"


def main(argv: list[str]) -> None:
    from ..session import local_session
    from .catalog import queries
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or ["latest_change_per_id", "first_value_distinct", "merge_full", "merge_small_change",
                         "merge_interval", "replay_catchup", "material_grams", "material_kg",
                         "column_check_report", "key_violations", "upsert_material", "merge_classified"]
    spark = local_session()
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # untruncated scan details
    q = queries()
    if len(argv) <= 1:
        print(PREFACE)
    for name in names:
        print(render(name, summary(q[name](spark, sf_dir))))


if __name__ == "__main__":
    main(sys.argv[1:])
