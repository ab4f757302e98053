"""How the full registry chain scales with input size (not a registered query).

The derived registry of ``sf_dir`` is lengthened k times: k copies with their
snapshot dates shifted by whole spans (a longer series of snapshots of the
same registry), then the chain raw -> staged -> clean -> marts runs once per
k. Prints one JSON line: rows and seconds per factor.
Usage: python tools/scale.py [sf_dir] [k ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    ks = [int(a) for a in args if not a.startswith("/")] or [1, 4, 16]
    from pyspark.sql import functions as F
    from rollcall.session import get_session, materialize
    from rollcall.plans import derived as D, staging as S
    spark = get_session("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    base = materialize(D.registry(spark, sf), "registry")
    span = base.agg(F.datediff(F.max("snapshot_date"), F.min("snapshot_date"))).first()[0] + 1
    out = {}
    for k in ks:
        wide = None
        for i in range(k):
            # a later stretch of snapshots of the same registry: dates shifted
            # by whole spans, so keys, leaders and groups keep their shape
            part = base.withColumn("snapshot_date", F.date_add("snapshot_date", i * span))
            wide = part if wide is None else wide.unionByName(part)
        raw = materialize(wide, f"wide{k}")
        n = raw.count()
        t0 = time.time()
        st = S.stage(raw, D.region_lookup(spark, sf), D.region_fixes(spark), D.name_fixes(spark))
        cl = materialize(S.clean(st), "clean")
        for df in S.marts(cl, D.geo_lookup(spark, sf)).values():
            df.write.format("noop").mode("overwrite").save()
        out[k] = {"rows": n, "sec": round(time.time() - t0, 2)}
    print(json.dumps({"sf": sf, "scale": out}))


if __name__ == "__main__":
    main()
