"""Run every registered query once and print row counts / schemas."""
import sys, time, traceback
sys.path.insert(0, "/root/repo")
from funnelspark.session import build_session
from funnelspark.queries import QUERIES

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = sys.argv[2:] 
spark = build_session("local[8]")
for name, fn in QUERIES.items():
    if only and name not in only:
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        rows = df.collect()
        print(f"OK   {name:28s} rows={len(rows):6d} {time.time()-t:6.2f}s  {df.columns}")
    except Exception as e:
        print(f"FAIL {name:28s} {type(e).__name__}: {str(e)[:300]}")
