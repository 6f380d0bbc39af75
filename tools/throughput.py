"""Per-row throughput of the CPU-heavy operators on a larger derived input.

Points are derived from ``lineitem`` keys (600 k rows at sf0.1) with the same
arithmetic as the customer points; sites are the suppliers, zones the nation
lattice. Usage: python tools/throughput.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cityscan.operators.nearest import nearest_site, site_load  # noqa: E402
from cityscan.operators.within import points_in_zones  # noqa: E402
from cityscan.operators.zones import unique_zones  # noqa: E402
from cityscan.plans import inputs  # noqa: E402
from cityscan.plans.catalog import _blocks_with_income  # noqa: E402
from cityscan.session import build_session, materialize  # noqa: E402
from cityscan.sources.geojson import features_to_zones, parse_features  # noqa: E402


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cores = 8
    spark = build_session(f"local[{cores}]", shuffle_partitions=cores)
    li = inputs.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    pts = li.select(k.alias("pid"), (F.lit(-118.7) + ((k * 7919) % 1009) / F.lit(2018.0)).alias("lon"),
                    (F.lit(33.7) + ((k * 104729) % 997) / F.lit(1661.0)).alias("lat"))
    pts = materialize(pts.repartition(cores))
    n = pts.count()
    sites = inputs.supplier_sites(spark, d)
    blocks = materialize(_blocks_with_income(spark, d))
    lattice = materialize(li.select(k.alias("pid"), (F.lit(-118.0) + (k * 7919 % 256) / F.lit(1024.0)).alias("lon"),
                                    (F.lit(34.0) + (k * 6007 % 256) / F.lit(1024.0)).alias("lat")).repartition(cores))
    shapes = features_to_zones(parse_features(inputs.shape_texts(spark, d), {"zone": "bigint"}), id_col="zone")
    shapes = materialize(unique_zones(shapes, "zone"))

    def near(sites):
        return lambda: site_load(nearest_site(pts, sites, "lon", "lat", "lon", "lat", "s_suppkey", ["s_name"]), ["s_name"])

    def in_shapes(engine):
        return lambda: points_in_zones(lattice, shapes, "lon", "lat", ["zone"], engine=engine).groupBy("zone").count()

    cases = {
        "nearest_cells_city": near(inputs.city_sites(spark, d)),
        "nearest_cells_stacked": near(inputs.stacked_sites(spark, d)),
        "shapes_native": in_shapes("native"),
        "shapes_arrow": in_shapes("arrow"),
        "nearest_cells": lambda: site_load(nearest_site(pts, sites, "lon", "lat", "lon", "lat", "s_suppkey",
                                                        ["s_name"], method="grid"), ["s_name"]),
        "nearest_array": lambda: site_load(nearest_site(pts, sites, "lon", "lat", "lon", "lat", "s_suppkey",
                                                        ["s_name"], method="array"), ["s_name"]),
        "points_in_zones": lambda: points_in_zones(pts, blocks, "lon", "lat", ["zone"]).groupBy("zone").count(),
    }
    for name, fn in cases.items():
        best = float("inf")
        for _ in range(1 if name == "nearest_array" else 2):
            t0 = time.perf_counter()
            fn().collect()
            best = min(best, time.perf_counter() - t0)
        print(f"{name}: {n} points, {best:.2f} s, {n / best / cores:,.0f} points/s/core")
    spark.stop()


if __name__ == "__main__":
    main()
