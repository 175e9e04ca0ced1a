"""Connected components on generated graphs: a long chain and one hub.

    python tools/graph_bench.py [chain_nodes] [hub_leaves]

Graphs are generated with ``spark.range`` (on the executors). Prints one JSON line
per graph and method: rounds, input edges, peak edges of any round, and seconds of
``canonical_ids`` on bigint person codes and directly on person structs.
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from lamina.functions.facts import user_person  # noqa: E402
from lamina.operators import identity as I  # noqa: E402
from lamina.session import build_session, parquet_stage, workspace  # noqa: E402


def main() -> None:
    chain_n = int(sys.argv[1]) if len(sys.argv) > 1 else 20000
    hub_n = int(sys.argv[2]) if len(sys.argv) > 2 else 200000
    spark = build_session("local[8]", 16)
    ids = spark.range(chain_n - 1)
    # chain i - (i+1), ids shuffled by a bijective affine map so order does not help
    chain = ids.select(
        user_person((F.col("id") * 7919) % chain_n).alias("a"),
        user_person(((F.col("id") + 1) * 7919) % chain_n).alias("b"),
    )
    hub = spark.range(1, hub_n + 1).select(user_person(F.lit(hub_n + 1)).alias("a"), user_person("id").alias("b"))
    for name, g in [("chain", chain), ("hub", hub)]:
        g = parquet_stage(workspace(spark, "graph"))(g, name)
        n_edges = g.count()
        for method, fix in [("star", I.star_fixpoint), ("relink", I.equiv_fixpoint)]:
            trace: list = []
            final, rounds = fix(g, trace=trace)
            peak = max(r.count() for r in trace)
            row = {"graph": name, "method": method, "rounds": rounds, "edges": n_edges, "peak_edges": peak,
                   "result_edges": final.count()}
            for encode in (True, False):
                t = time.perf_counter()
                I.canonical_ids(g, method=method, encode=encode).write.format("noop").mode("overwrite").save()
                row[f"sec_{'codes' if encode else 'structs'}"] = round(time.perf_counter() - t, 2)
            print(json.dumps(row))


if __name__ == "__main__":
    main()
