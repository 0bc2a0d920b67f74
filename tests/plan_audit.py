"""Scan the physical plan of every registered query for cartesian products,
nested-loop joins and single-partition exchanges (python tests/plan_audit.py)."""
import sys, io, contextlib, re
sys.path.insert(0, __file__.rsplit('/tests/', 1)[0])
from quarry import get_spark
from quarry.catalog import QUERIES, load_all
load_all()
spark=get_spark()
bad = {}
for name, q in QUERIES.items():
    try:
        df = q(spark, '/root/testdata/sf0.001')
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        plan = buf.getvalue()
    except Exception as e:
        print("ERR", name, str(e)[:200]); continue
    hits = [k for k in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition") if k in plan]
    if hits:
        bad[name] = hits
        lines = [l.strip()[:160] for l in plan.splitlines() if any(k in l for k in ("SinglePartition", "Cartesian", "NestedLoop", "Window ["))]
        print(name, hits); print("   " + "\n   ".join(lines[:6]))
print("queries with flags:", len(bad))
