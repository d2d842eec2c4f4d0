"""Print a one-line audit of each query's physical plan (and save the plans).

Flags: exchanges, single-partition exchanges, joins by type, window group
limits, scans with pushed filters / read schema."""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from funnelspark.queries import QUERIES  # noqa: E402
from funnelspark.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
out_dir = sys.argv[2] if len(sys.argv) > 2 else None
spark = build_session("local[8]")
spark.conf.set("spark.sql.adaptive.enabled", "false")  # audit the static plan
spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only the broadcasts that the code asks for
rows = []
for name, fn in QUERIES.items():
    df = fn(spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if out_dir:
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as f:
            f.write(plan)
    ex = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin)", plan))
    single = len(re.findall(r"Exchange SinglePartition", plan))
    bhj = plan.count("BroadcastHashJoin")
    bnl = plan.count("BroadcastNestedLoopJoin")
    smj = plan.count("SortMergeJoin")
    wgl = plan.count("WindowGroupLimit")
    win = plan.count("Window [")
    pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", plan))
    subq = plan.count("Subquery")
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    scans = sum("parquet" in leaves.apply(i).toString() for i in range(leaves.size()))
    bounded = bool(re.search(r"PartitionFilters: \[[^\]]*event_date", plan))
    rows.append((name, ex, single, bhj, bnl, smj, wgl, scans, "yes" if bounded else "", "yes" if pushed else ""))
    print(f"{name:26s} exch={ex:2d} single={single} bhj={bhj} bnlj={bnl} smj={smj} win={win} wgl={wgl} "
          f"pushed={pushed} subq={subq}")
if out_dir:
    with open(os.path.join(out_dir, "table.md"), "w") as f:
        f.writelines("| `" + str(r[0]) + "` | " + " | ".join(map(str, r[1:])) + " |\n" for r in rows)
