"""Write COVERAGE.md: every SURVEY §2 id -> library function(s) -> catalogue queries.

Each query of the catalogue is built on the smallest tables with every listed function
wrapped: a query counts for an id only if it calls the function. A function that no query
calls is named as such.
"""

from __future__ import annotations

import importlib
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FUNCS = {
    "S1": ["sources.files.read_csv"], "S2": ["sources.files.read_json_records", "sources.json_arrays.elements"],
    "S3": ["sources.files.orders_from_rows"], "S4": ["sources.tables.ParquetTable.read"],
    "S5": ["streaming.taxi.read_stream"], "S6": ["sources.files.landing_path", "sources.files.landing_paths"],
    "S7": ["schemas.SCHEMAS", "schemas.conform"],
    "K1": ["sources.writers.write_csv"], "K2": ["sources.writers.write_json"],
    "K3": ["sources.writers.write_partitioned", "sources.tables.ParquetTable.overwrite"],
    "K4": ["sources.tables.ParquetTable.append"], "K5": ["sources.writers.truncate_and_load", "sources.tables.ParquetTable.overwrite"],
    "K6": ["operators.quality.anomaly_lines", "sources.writers.write_text_lines"],
    "K7": ["streaming.taxi.write_stream"], "K8": ["sources.writers.materialize"],
    "K9": ["operators.layout.layout_report"],
    "P1": ["operators.filters.where_equals"], "P2": ["operators.filters.between"],
    "P3": ["operators.filters.greater_than"], "P4": ["operators.filters.not_equal_count"],
    "P5": ["operators.filters.flag_rides"],
    "P6": ["operators.quality.expect_or_drop", "operators.quality.expectation_counts"],
    "P7": ["operators.quality.count_violations"], "P8": ["operators.filters.positive_quantity"],
    "P9": ["operators.filters.clean_staging"], "P10": ["operators.filters.read_partition", "plans.orders_table.pruned_read"],
    "P11": ["operators.changes.update_where"], "P12": ["plans.taxi.flagged"],
    "P13": ["operators.filters.with_columns", "plans.orders_table.with_order_date"],
    "P14": ["operators.filters.with_columns"], "P15": ["operators.filters.case_flag"],
    "P16": ["operators.clean.fill_missing"], "P17": ["operators.clean.fill_median"],
    "J1": ["operators.keyed.left_lookup"], "J2": ["operators.keyed.upsert", "sources.tables.KeyedTable.merge"],
    "J3": ["operators.keyed.orphans"], "J4": ["operators.synth.synth_sales"],
    "G1": ["operators.stats.group_sum"], "G2": ["operators.stats.mean_of"],
    "G3": ["operators.stats.group_mean"], "G4": ["operators.stats.group_means"],
    "G5": ["operators.stats.group_count"], "G6": ["operators.quality.expectation_counts", "operators.checks.run_checks"],
    "G7": ["operators.stats.describe_exact"], "G8": ["operators.stats.median_of", "operators.stats.exact_quantiles"],
    "G9": ["operators.synth.synth_sales"], "G10": ["operators.stats.distinct_lists"],
    "G11": ["operators.stats.row_count"],
    "W1": ["operators.keyed.latest_per_key"], "W2": ["operators.keyed.first_per_key"],
    "W3": ["operators.keyed.last_per_key"],
    "O1": ["pyspark DataFrame.orderBy"], "O2": ["operators.stats.top_n"],
    "O3": ["operators.stats.top_group"], "O4": ["operators.stats.top_n"],
    "U1": ["operators.changes.concat"], "U2": ["sources.tables.ParquetTable.append"],
    "X1": ["functions.scalar.to_timestamp_or_null"], "X2": ["functions.scalar.to_number_or_null"],
    "X3": ["functions.scalar.to_ts"], "X4": ["functions.scalar.to_day"],
    "X5": ["functions.scalar.week_start"], "X6": ["functions.scalar.round_half_up"],
    "X7": ["functions.scalar.round_half_even"], "X8": ["functions.scalar.weighted_sum"],
    "X9": ["functions.scalar.flag01"], "X10": ["functions.scalar.run_timestamp"],
    "X11": ["functions.scalar.record_json"], "X12": ["functions.scalar.int_or_zero"],
    "X13": ["operators.synth.synth_sales"], "X14": ["functions.scalar.one_of"],
    "T1": ["streaming.taxi.ingest_stream"], "T2": ["streaming.taxi.flag_stream"],
    "T3": ["streaming.taxi.partials_stream", "streaming.taxi.refresh_weekly_from_partials", "streaming.taxi.weekly_stream"],
    "T4": ["streaming.taxi.refresh_top_n"],
    "V1": ["operators.changes.update_where", "sources.tables.ParquetTable.change"],
    "V2": ["operators.changes.delete_where", "sources.tables.ParquetTable.change"],
    "V3": ["operators.keyed.upsert", "sources.tables.ParquetTable.merge"],
    "V4": ["sources.history.HistoryTable.as_of"], "V5": ["sources.history.HistoryTable.history"],
    "V6": ["sources.tables.ParquetTable.append"], "V7": ["sources.compaction.compact_files"],
    "V8": ["operators.layout.cluster_by"], "V9": ["plans.shop_daily.load_day", "sources.tables.ParquetTable.merge"],
    "Q1": ["operators.checks.not_empty"], "Q2": ["operators.checks.no_nulls", "operators.quality.check_no_nulls"],
    "Q3": ["operators.checks.equal_counts"], "Q4": ["operators.quality.require", "operators.quality.all_passed"],
    "Q5": ["operators.quality.volume_status"], "Q6": ["operators.synth.synth_sales"],
}


def resolve(path: str):
    """The function of a dotted path, and the object that holds it."""
    parts = path.split(".")
    for cut in range(len(parts), 0, -1):
        try:
            owner = importlib.import_module("tessera." + ".".join(parts[:cut]))
        except ModuleNotFoundError:
            continue
        for attr in parts[cut:-1]:
            owner = getattr(owner, attr)
        return (owner if parts[cut:] else None), (getattr(owner, parts[-1]) if parts[cut:] else owner)
    raise ImportError(path)


def traced(paths: set[str], called: set[str]) -> None:
    """Wrap the functions wherever the library holds them, so that calls are recorded."""
    for path in paths:
        owner, fn = resolve(path)
        if not callable(fn):
            continue

        def wrapper(*a, _fn=fn, _path=path, **k):
            called.add(_path)
            return _fn(*a, **k)

        if isinstance(owner, type):
            setattr(owner, fn.__name__, wrapper)
            continue
        for name, module in list(sys.modules.items()):
            if name.startswith("tessera") and ".llm" not in name:
                for attr, value in list(vars(module).items()):
                    if value is fn:
                        setattr(module, attr, wrapper)


def main(sf: str = "/root/testdata/sf0.001") -> None:
    from tessera.plans.catalog import ORACLE, QUERIES, load_all
    from tessera.session import build_session
    load_all()
    called: set[str] = set()
    paths = {f for fs in FUNCS.values() for f in fs if not f.startswith("pyspark")}
    traced(paths, called)
    spark, by_func = build_session(), {}
    for name, fn in sorted(QUERIES.items()):
        called.clear()
        fn(spark, sf)
        for path in called:
            by_func.setdefault(path, []).append(name)
    lines = ["# Coverage of SURVEY §2", "",
             "Generated by `python tools/coverage.py`, which builds every catalogue query and records the calls.",
             "", "| id | library | queries that call it |", "| --- | --- | --- |"]
    sizes = (("S", 7), ("K", 9), ("P", 17), ("J", 4), ("G", 11), ("W", 3),
             ("O", 4), ("U", 2), ("X", 14), ("T", 4), ("V", 9), ("Q", 6))
    order = [f"{p}{n}" for p, k in sizes for n in range(1, k + 1)]
    missing = []
    for i in order:
        q = sorted({n for f in FUNCS[i] for n in by_func.get(f, [])})
        plain = all(f.startswith("pyspark") or not callable(resolve(f)[1]) for f in FUNCS[i])
        if not q and not plain:
            missing.append(i)
        assert all(n in ORACLE for n in q)
        lines.append(f"| {i} | {', '.join(f'`{f}`' for f in FUNCS[i])} | "
                     f"{', '.join(f'`{n}`' for n in q) or ('Spark itself' if plain else '(tests only)')} |")
    lines += ["", f"{len(order)} ids; called by no query, tested only: {', '.join(missing) or 'none'}."]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "COVERAGE.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    print(lines[-1])


if __name__ == "__main__":
    main(*sys.argv[1:])
