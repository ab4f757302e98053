"""

Each step runs on a materialised input so only that step is timed; three
runs: the first is cold (code generation, JIT), the best of the others warm.
Usage: python tools/steps.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from rollcall.session import get_session, materialize
    from rollcall.plans import derived as D, staging as S
    from rollcall.operators import canonical as C, gaps as G, history as H
    spark = get_session("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    reg = materialize(D.registry(spark, sf), "reg")
    corrected = materialize(S.correct(S.normalise(reg), D.region_fixes(spark), D.name_fixes(spark)), "corr")
    staged = S.stage(reg, D.region_lookup(spark, sf), D.region_fixes(spark), D.name_fixes(spark))
    clean = materialize(S.clean(staged), "clean")
    cal = materialize(H.calendar(clean), "cal")
    hist = materialize(S.history(clean, cal), "hist")

    def full():
        raw = materialize(D.registry(spark, sf), "registry")   # stands in for the raw store
        st = S.stage(raw, D.region_lookup(spark, sf), D.region_fixes(spark), D.name_fixes(spark))
        cl = materialize(S.clean(st), "clean")
        return list(S.marts(cl, D.geo_lookup(spark, sf)).values())

    steps = {
        "scd2_by_presence": lambda: [S.history(clean, cal)],
        "identity_gap_fill": lambda: [G.backfill(corrected, "entity_no", ["region_code", "entity_name"],
                                                 "snapshot_date", ["entity_type"])],
        "guarded_canonicalisation": lambda: [C.canonicalise_to_leader(
            C.canonicalise(corrected, D.region_lookup(spark, sf), on="region_code", value="region_name"))],
        "movements": lambda: [H.movements(hist, cal)],
        "full_chain_raw_to_marts": full,
    }
    out = {}
    for name, f in steps.items():
        runs = []
        for _ in range(3):
            t0 = time.time()
            for df in f():
                df.write.format("noop").mode("overwrite").save()
            runs.append(round(time.time() - t0, 2))
        out[name] = {"cold": runs[0], "warm": min(runs[1:])}
    print(json.dumps({"sf": sf, "rows": reg.count(), "steps": out}))


if __name__ == "__main__":
    main()
