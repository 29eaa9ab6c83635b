"""Split array files, radix quantiles, tables with history, compaction of small files."""

import glob
import json
import math
import os
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tessera.operators import stats
from tessera.sources.compaction import HIDDEN, compact_files, finish
from tessera.sources.files import read_json_records
from tessera.sources.history import OPEN, HistoryTable
from tessera.sources.json_arrays import elements
from tessera.sources.tables import ParquetTable

# ---- array files ---------------------------------------------------------------

SPLIT = {"spark.sql.files.maxPartitionBytes": "61", "spark.sql.files.openCostInBytes": "1",
         "spark.sql.files.minPartitionNum": "1"}


@pytest.fixture()
def tiny_splits(spark):
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield
    for k in SPLIT:
        spark.conf.unset(k)


TEXT = st.text(st.sampled_from(list('ab{}[]",:\\/ \n\té漢')), max_size=12)
VALUE = st.recursive(st.one_of(st.none(), st.booleans(), st.integers(-10 ** 6, 10 ** 6), TEXT),
                     lambda v: st.one_of(st.lists(v, max_size=3), st.dictionaries(TEXT, v, max_size=3)), max_leaves=8)
RECORD = st.dictionaries(st.sampled_from(["id", 'k"{', "x\\", "n"]), VALUE, max_size=4)
ELEMENT = st.one_of(RECORD, RECORD, RECORD, VALUE)


def _plain(x):
    return {k: _plain(v) for k, v in x.items()} if isinstance(x, dict) else [_plain(v) for v in x] if isinstance(x, list) else x


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.lists(ELEMENT, max_size=12), st.sampled_from([None, 0, 1, 3]), st.booleans(),
                          st.sampled_from(["", "\n", " \n\n"])), min_size=1, max_size=6))
def test_split_array_files_equal_json_loads(spark, tmp_path_factory, tiny_splits, files):
    folder = tmp_path_factory.mktemp("arrays")
    for k, (records, indent, ascii_only, end) in enumerate(files):
        (folder / f"f{k}.json").write_text(json.dumps(records, indent=indent, ensure_ascii=ascii_only) + end)
    rows = elements(spark, str(folder)).orderBy("at.file", "at.block", "at.line", "pos").collect()
    for k, (records, *_) in enumerate(files):
        got = [r["text"] for r in rows if r["at"]["file"].endswith(f"f{k}.json")]
        want = [x if isinstance(x, str) else json.dumps(x) for x in records]  # text elements come without quotes
        assert len(got) == len(want)
        for g, w, x in zip(got, want, records, strict=True):
            assert (g == x if isinstance(x, str) else x is None and g is None or json.loads(g) == json.loads(w))


def test_one_array_file_is_read_by_many_tasks(spark, tmp_dir, tiny_splits):
    r = random.Random(3)
    records = [{"order_id": f"o{i}", "note": r.choice(['a "quoted" } brace', "plain", "back\\slash}", "[{"]) * r.randrange(9),
                "items": [{"n": i, "tags": ["}", "{"]}] * r.randrange(3)} for i in range(400)]
    path = os.path.join(tmp_dir, "one.json")
    for text in (json.dumps(records), json.dumps(records, indent=2)):
        with open(path, "w") as f:
            f.write(text)
        schema = spark.createDataFrame([], "order_id string, note string, items array<struct<n:int,tags:array<string>>>").schema
        df = read_json_records(spark, path, schema, ingest_order=True, raw="raw", split=True)
        rows = df.orderBy("_ingest.file", "_ingest.block", "_ingest.pos").collect()
        assert [json.loads(x["raw"]) for x in rows] == records
        assert [(x["order_id"], x["note"], len(x["items"])) for x in rows] == [
            (x["order_id"], x["note"], len(x["items"])) for x in records]
        from tessera.sources.json_arrays import pieces
        assert pieces(spark, path).rdd.getNumPartitions() > 100
        assert len({x["_ingest"]["block"] for x in rows}) > 100


def test_small_and_odd_files_are_read_alike(spark, tmp_dir):
    texts = ["[]", " [ ] ", '{"a": 1, "b": {"c": 2}}', '{"a":1}', "", "[1, 2]", '[{"a": 7}, 5, null, {"a": 8}, "x"]', "nonsense }",
             '[{"a":9}]\n']
    for k, t in enumerate(texts):
        with open(os.path.join(tmp_dir, f"{k}.json"), "w") as f:
            f.write(t)
    schema = spark.createDataFrame([], "a long").schema
    read = lambda split: sorted((x["_ingest"]["file"][-6:], str(x["a"]), str(x["raw"])) for x in read_json_records(
        spark, tmp_dir, schema, ingest_order=True, raw="raw", split=split).collect())
    assert read(True) == read(False) and len(read(None)) == len(read(True)) == 8


def test_broken_array_gives_its_elements_before_the_fault(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "cut.json"), "w") as f:
        f.write('[{"a": 1}, {"a": 2}, {"a": ')
    schema = spark.createDataFrame([], "a long").schema
    got = {r["a"] for r in read_json_records(spark, tmp_dir, schema, split=True).collect()}
    assert got - {None} == {1, 2}


# ---- radix quantiles -----------------------------------------------------------

SPECIAL = [0.0, -0.0, 5e-324, -5e-324, 2.0 ** -1022, -(2.0 ** -1022), 2.0 ** -1023, 1.0, -1.0, 1.0 - 2 ** -53, 1.0 + 2 ** -52, 2.0 ** 1023,
           1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf, 0.1, 3.0, 8.0, 7.999999999999999, 2.0 ** 52, 2.0 ** -52]


def test_ordered_bits_keep_order_and_value(spark):
    r = random.Random(1)
    values = SPECIAL + [r.uniform(-1, 1) * 2.0 ** r.randint(-1070, 1020) for _ in range(3000)]
    values += [math.nextafter(2.0 ** e, d) for e in range(-1074, 1024, 7) for d in (-math.inf, math.inf)] + [2.0 ** e for e in range(-1074, 1024)]
    df = spark.createDataFrame([(v,) for v in values], "v double").withColumn("k", stats.ordered_bits(F.col("v")))
    rows = df.withColumn("back", stats.from_ordered_bits(F.col("k"))).collect()
    assert all(x["v"] == x["back"] for x in rows)
    bits = lambda v: int(np.array(abs(v)).view(np.int64)) * (-1 if v < 0 else 1)
    assert [x["k"] for x in rows] == [bits(x["v"]) for x in rows]
    odd = spark.createDataFrame([(None,), (math.nan,)], "v double").select(stats.ordered_bits(F.col("v")).alias("k"))
    assert [x["k"] for x in odd.collect()] == [None, None]


def _same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g == pytest.approx(w, rel=1e-12, abs=1e-300)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64, min_value=-1e300, max_value=1e300), min_size=1, max_size=60),
       st.floats(-1e6, 1e6), st.integers(0, 90))
def test_radix_quantiles_equal_numpy(spark, values, hot, times):
    values = values + [hot] * times
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = stats.exact_quantiles(spark.createDataFrame([(v,) for v in values], "v double"), "v", probs).first()
    x = np.sort(values)
    h = [(len(x) - 1) * p for p in probs]
    want = [x[math.floor(k)] * (1 - (k - math.floor(k))) + x[min(math.floor(k) + 1, len(x) - 1)] * (k - math.floor(k)) for k in h]
    _same(list(got), want)


def test_radix_quantiles_of_groups_with_close_values(spark):
    rows = [(g, 100.0 + k * 2.0 ** -45) for g in ("a", None) for k in range(300)] + [("b", -3.5)] + [("c", None), ("d", math.nan)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    for few in (True, False):
        got = {r["g"]: tuple(r)[1:] for r in stats.exact_quantiles(df, "v", [0.0, 0.5, 1.0], by=["g"], few_groups=few).collect()}
        ends = (100.0, 100.0 + 149.5 * 2.0 ** -45, 100.0 + 299 * 2.0 ** -45)
        assert got == {"a": ends, None: ends, "b": (-3.5,) * 3}


def test_quantiles_write_and_sample_nothing(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    plan = stats.exact_quantiles(df, "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan.lower() and "Scan ExistingRDD" not in plan and "CartesianProduct" not in plan


# ---- tables with history -----------------------------------------------------------

def _files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(path + "/**/part-*", recursive=True) if HIDDEN not in f}


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_history_of_changes(spark, tmp_dir):
    first = spark.createDataFrame([(i, f"v{i}", "ab"[i % 2]) for i in range(8)] + [(8, None, None)], "id long, v string, p string")
    t = HistoryTable(spark, os.path.join(tmp_dir, "h"), first.schema, ("p",)).overwrite(first)
    states = [_rows(t.read())]
    before = _files(t.path)
    t = t.change("id = 2", lambda df: df.withColumn("v", F.lit("new")))
    states.append(_rows(t.read()))
    assert {f for f in before if "p=b" in f} <= set(_files(t.path))  # other partitions untouched
    t = t.append(first.limit(0).withColumn("w", F.lit(1)).unionByName(
        spark.createDataFrame([(9, "nine", "b", 5)], "id long, v string, p string, w int")), merge_schema=True)
    states.append(_rows(t.read()))
    t = t.change("id >= 6", lambda df: df.limit(0))
    states.append(_rows(t.read()))
    source = spark.createDataFrame([(0, "v0", "a", None), (1, "moved", "a", 2), (77, "x", "c", 3), (None, "n", "c", 4)], t.schema)
    t = t.merge(source, "id")
    states.append(_rows(t.read()))
    kept = {f: m for f, m in _files(t.path).items() if f"valid_to={OPEN}" not in f}
    t = t.merge(source.where("id is not null"), "id")  # the same again: nothing ends or begins
    states.append(_rows(t.read()))
    assert states[5] == states[4] and kept == {f: m for f, m in _files(t.path).items() if f in kept}
    t = t.compact()
    t = t.overwrite(spark.createDataFrame([(1, "only", "a", None)], t.schema))
    assert _rows(t.read()) == [(1, "only", "a", None)]
    for k, want in enumerate(states):
        assert _rows(t.as_of(k)) == want
    assert t.as_of(1).columns == ["id", "v", "p"] and t.as_of(3).columns == ["id", "v", "p", "w"]
    assert [x[0] for x in states[3]] == [0, 1, 2, 3, 4, 5] and len(states[4]) == 8
    log = [tuple(r) for r in t.history().orderBy("version").select("version", "operation", "opened", "closed", "num_rows").collect()]
    assert log == [(0, "WRITE", 9, 0, 9), (1, "UPDATE", 1, 1, 9), (2, "WRITE", 1, 0, 10), (3, "DELETE", 0, 4, 6),
                   (4, "MERGE", 3, 1, 8), (5, "MERGE", 0, 0, 8), (6, "OPTIMIZE", 0, 0, 8), (7, "WRITE", 1, 8, 1)]
    with pytest.raises(ValueError):
        t.as_of(8)


def test_as_of_reads_only_folders_of_its_state(spark, tmp_dir):
    t = HistoryTable(spark, os.path.join(tmp_dir, "h"), spark.range(1).schema).overwrite(spark.range(50))
    for k in range(3):
        t = t.change(f"id < {10 * (k + 1)}", lambda df: df.withColumn("id", F.col("id") + 1000))
    plan = t.as_of(1)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "valid_from" in filters and "valid_to" in filters
    held = t.as_of(1).select(F.col("_metadata.file_path").alias("f")).distinct().collect()
    assert {r["f"].split("valid_to=")[1].split("/")[0] for r in held} == {"2", "3", str(OPEN)}


def test_broken_off_change_is_taken_back(spark, tmp_dir, monkeypatch):
    t = HistoryTable(spark, os.path.join(tmp_dir, "h"), spark.range(1).schema).overwrite(spark.range(10))
    done = HistoryTable._done
    for attempt in (lambda: t.change("id < 4", lambda df: df.withColumn("id", -F.col("id") - 1)), lambda: t.append(spark.range(90, 95))):
        monkeypatch.setattr(HistoryTable, "_done", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            attempt()
        assert _rows(t.read()) == [(i,) for i in range(10)]  # the version does not count
    monkeypatch.setattr(HistoryTable, "_done", done)
    t = t.change("id >= 8", lambda df: df.limit(0))
    assert _rows(t.read()) == [(i,) for i in range(8)] and _rows(t.as_of(0)) == [(i,) for i in range(10)]
    assert t.history().orderBy("version").select("num_rows").collect() == [(10,), (8,)]


# ---- compaction ----------------------------------------------------------------------

def _small_table(spark, path):
    schema = spark.createDataFrame([], "id long, text string, p string").schema
    t = ParquetTable(spark, path, schema, ("p",))
    noise = F.concat_ws("", *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(k))), 256) for k in range(8)])
    rows = lambda lo, hi, p: spark.range(lo, hi).select("id", noise.alias("text"), F.lit(p).alias("p"))
    t.append(rows(0, 3000, "big one").coalesce(1), as_is=True)
    for k in range(9):
        t.append(rows(10_000 + 40 * k, 10_040 + 40 * k, "big one").coalesce(1), as_is=True)
    for k in range(3):
        t.append(rows(20_000 + k, 20_001 + k, "a/b=%").coalesce(1), as_is=True)
    t.append(rows(30_000, 30_010, "alone").coalesce(1), as_is=True)
    t.append(rows(40_000, 40_010, None).withColumn("p", F.lit(None).cast("string")).repartition(4), as_is=True)
    return t


def test_only_small_files_are_rewritten(spark, tmp_dir):
    t = _small_table(spark, os.path.join(tmp_dir, "t"))
    rows, before = _rows(t.read()), _files(t.path)
    large = max(before, key=os.path.getsize)
    assert compact_files(t.read(), t.path, t.partition_by, target_bytes=400_000) == 16
    after = {f for f in glob.glob(t.path + "/p=*/*.parquet")}
    assert _rows(t.read()) == rows and not os.path.exists(f"{t.path}/{HIDDEN}")
    kept = after & set(before)
    assert large in kept and len(kept) == 2 and {os.path.getmtime(f) for f in kept} == {before[f] for f in kept}  # and the one alone
    assert len(after) == 2 + 1 + 1 + 1  # one bin in each of three folders
    assert compact_files(t.read(), t.path, t.partition_by, target_bytes=400_000) == 0 and _rows(t.read()) == rows


def test_bins_are_bounded_and_unpartitioned_tables_compact(spark, tmp_dir):
    t = ParquetTable(spark, os.path.join(tmp_dir, "t"), spark.range(1).schema)
    for k in range(12):
        t.append(spark.range(200 * k, 200 * k + 200).coalesce(1), as_is=True)
    size = max(os.path.getsize(f) for f in _files(t.path))
    t.compact(target_bytes=int(2.5 * size), small_bytes=2 * size)
    assert len(glob.glob(t.path + "/*.parquet")) == 5 and sorted(t.read().collect()) == [(i,) for i in range(2400)]
    assert max(os.path.getsize(f) for f in glob.glob(t.path + "/*.parquet")) <= 3.5 * size


def test_broken_off_compaction_is_ended_by_the_next(spark, tmp_dir, monkeypatch):
    import tessera.sources.compaction as c
    t = _small_table(spark, os.path.join(tmp_dir, "t"))
    rows = _rows(t.read())
    calls = []
    monkeypatch.setattr(c, "finish", lambda *a: calls.append(a) if len(calls) else calls.append(a))
    c.compact_files(t.read(), t.path, t.partition_by, target_bytes=400_000)  # the new files are written, nothing is moved
    assert os.path.exists(f"{t.path}/{HIDDEN}/files/_SUCCESS") and _rows(t.read()) == rows
    monkeypatch.undo()
    os.remove(next(f for f in _files(t.path) if "big one" in f.replace("%20", " ") and os.path.getsize(f) < 40_000))  # one old file is gone
    finish(spark, t.path)
    finish(spark, t.path)
    assert _rows(t.read()) == rows and not os.path.exists(f"{t.path}/{HIDDEN}")
    os.makedirs(f"{t.path}/{HIDDEN}/files")  # one that had written nothing yet
    finish(spark, t.path)
    assert _rows(t.read()) == rows


# ---- wider types -----------------------------------------------------------------------

WIDER = [("tinyint", "int"), ("smallint", "bigint"), ("int", "bigint"), ("int", "double"), ("int", "decimal(10,0)"),
         ("int", "decimal(14,4)"), ("bigint", "decimal(20,0)"), ("bigint", "decimal(24,2)"), ("float", "double"),
         ("decimal(9,2)", "decimal(12,2)"), ("decimal(9,2)", "decimal(20,6)"), ("decimal(5,2)", "decimal(9,4)")]
OTHER = [("bigint", "int"), ("bigint", "double"), ("double", "float"), ("int", "float"), ("int", "string"), ("int", "decimal(9,0)"),
         ("bigint", "decimal(20,2)"), ("decimal(9,2)", "decimal(12,1)"), ("decimal(9,2)", "decimal(9,3)"), ("string", "int"),
         ("double", "decimal(38,2)"), ("date", "timestamp"), ("decimal(9,2)", "double")]


@pytest.mark.parametrize("old, new", WIDER)
def test_appended_wider_types_read_back(spark, tmp_dir, old, new):
    rows = lambda kind, lo: spark.range(lo, lo + 5).select(
        "id", F.when(F.col("id") != lo, (F.col("id") * -1 if lo % 2 else F.col("id")).cast("double")).cast(kind).alias("v"))
    first, second = rows(old, 1), rows(new, 100)
    t = ParquetTable(spark, os.path.join(tmp_dir, "t"), first.schema).overwrite(first)
    with pytest.raises(ValueError):
        t.append(second)
    before = _files(t.path)
    t = t.append(second, merge_schema=True)
    assert set(before) < set(_files(t.path)) and t.read().schema["v"].dataType.simpleString() == new
    got = {r["id"]: None if r["v"] is None else float(r["v"]) for r in t.read().collect()}
    assert got == {**{i: -float(i) for i in range(2, 6)}, 1: None, **{i: float(i) for i in range(101, 105)}, 100: None}
    assert t.read().where("v < -2").count() == 3  # pushed down to files of both types


@pytest.mark.parametrize("old, new", OTHER)
def test_other_types_are_refused(spark, tmp_dir, old, new):
    empty = lambda kind: spark.createDataFrame([], f"v {kind}")
    t = ParquetTable(spark, os.path.join(tmp_dir, "t"), empty(old).schema)
    with pytest.raises(ValueError):
        t.append(empty(new), merge_schema=True)


# ---- keyed tables, checks ------------------------------------------------------------------

def test_upsert_leaves_other_buckets_alone(spark, tmp_dir):
    from tessera.sources.tables import KeyedTable
    first = spark.createDataFrame([(f"k{i}", i) for i in range(200)] + [(None, -1)], "id string, v int")
    t = KeyedTable(spark, os.path.join(tmp_dir, "t"), first.schema, ("id",), 8).overwrite(first)
    before = _files(t.path)
    assert len({f.split("key_bucket=")[1].split("/")[0] for f in before}) == 8
    t.merge(spark.createDataFrame([("k7", 700)], "id string, v int"))
    after = _files(t.path)
    assert len(set(before) - set(after)) == 1 and all(after[f] == before[f] for f in set(before) & set(after))
    t.merge(spark.createDataFrame([("new", 1), ("k9", None)], "id string, v int"))
    t.merge(first.limit(0))
    want = {**{f"k{i}": i for i in range(200)}, None: -1, "k7": 700, "new": 1, "k9": None}
    assert {r["id"]: r["v"] for r in t.read().collect()} == want and t.read().count() == len(want)


def test_fused_checks(spark):
    from tessera.operators import checks as c
    from tessera.operators.quality import require
    dim = spark.createDataFrame([(1,)], "id long")
    fact = spark.createDataFrame([(1, "a", 5), (2, None, 5), (None, "b", 6), (None, None, None)], "id long, k string, day int")
    tables = {"dim": dim, "none": dim.limit(0), "fact": fact}
    rules = [c.not_empty("dim", "dim there"), c.not_empty("none", "none there"), c.no_nulls("fact", ["id", "k"], "keys"),
             c.no_row("fact", F.col("day") > 5, "late"), c.equal_counts("fact", F.col("day") == 5, "fact", F.col("id") > 0, "same"),
             c.equal_counts("dim", F.lit(True), "fact", F.col("k") == "zz", "unlike")]
    got = {r["check"]: (r["observed"], r["passed"]) for r in c.run_checks(tables, rules).collect()}
    assert got == {"dim there": (1, True), "none there": (0, False), "keys": (3, False), "late": (1, False), "same": (2, True),
                   "unlike": (1, False)}
    bad = sorted((r["check"], r["table"], json.loads(r["row"])["day"]) for r in c.failing_rows(tables, rules).collect() if r["check"] != "keys")
    assert bad == [("late", "fact", 6)]
    assert c.failing_rows(tables, rules).where("check = 'keys'").count() == 3
    with pytest.raises(ValueError):
        require(c.run_checks(tables, rules))
    require(c.run_checks(tables, rules[:1]))
    plan = c.run_checks(tables, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") <= 3
    with pytest.raises(ValueError):
        c.failing_rows({"dim": dim}, rules)


def test_weekly_view_from_partials_equals_recompute(spark, tmp_dir):
    from tessera import schemas
    from tessera import testviews as tv
    from tessera.plans import taxi
    from tessera.streaming import taxi as stream
    src, base = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    trips = tv.trips(spark, "/root/testdata/sf0.001")
    gaps = trips.limit(40).withColumn("fare_amount", F.lit(None).cast("double")).unionByName(
        trips.limit(3).withColumn("tpep_pickup_datetime", F.lit(None).cast("timestamp_ntz")))
    for part in (trips.where("pickup_zip < 4"), trips.where("pickup_zip >= 4"), gaps):  # late files of weeks seen before
        part.repartition(2).write.mode("append").parquet(src)
        stream.ingest_stream(spark, stream.read_stream(spark, src, schemas.TRIPS, max_files=1), f"{base}/bronze", f"{base}/_b",
                             metrics=f"{base}/metrics")
        stream.partials_stream(spark, f"{base}/bronze", schemas.TRIPS, f"{base}/partials", f"{base}/_p")
        got = stream.refresh_weekly_from_partials(spark, f"{base}/partials", f"{base}/weekly")
        want = stream.refresh_weekly(spark, f"{base}/bronze", schemas.TRIPS, f"{base}/again", exact_scale=6)
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    counts = stream.total_counts(spark, f"{base}/metrics").first()
    assert counts["rows_kept"] == stream.read_bronze(spark, f"{base}/bronze", schemas.TRIPS).count()


def test_counts_and_rows_agree_after_a_failure_between_them(spark, tmp_dir, monkeypatch):
    from tessera import schemas
    from tessera import testviews as tv
    from tessera.streaming import taxi as stream
    src, base = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    tv.trips(spark, "/root/testdata/sf0.001").limit(300).repartition(3).write.parquet(src)
    run = lambda: stream.ingest_stream(spark, stream.read_stream(spark, src, schemas.TRIPS, max_files=1),
                                       f"{base}/bronze", f"{base}/_b", metrics=f"{base}/metrics")
    write, calls = stream.write_counts, []

    def fails_once(*a):
        calls.append(a)
        if len(calls) == 2:
            raise RuntimeError("lost")
        write(*a)

    monkeypatch.setattr(stream, "write_counts", fails_once)
    with pytest.raises(Exception):
        run()
    assert os.path.exists(f"{base}/bronze/batch=1") and not os.path.exists(f"{base}/metrics/batch=1")
    run()
    counts = stream.total_counts(spark, f"{base}/metrics").first()
    bronze = stream.read_bronze(spark, f"{base}/bronze", schemas.TRIPS)
    assert (counts["rows_seen"], counts["rows_kept"]) == (300, bronze.count())


def test_distinct_lists_in_one_scan(spark):
    df = spark.createDataFrame([(1, "a", None), (1, None, 2.5), (2, "a", 2.5)], "x long, y string, z double")
    got = {(r["dim"], r["value"]) for r in stats.distinct_lists(df, ["x", "y", "z"], {"y": "NONE"}).collect()}
    assert got == {("x", "1"), ("x", "2"), ("y", "a"), ("y", "NONE"), ("z", None), ("z", "2.5")}


def test_chunks_of_few_pieces_give_the_same_elements(spark, tmp_dir, monkeypatch):
    from tessera.sources import json_arrays
    records = [{"n": i, "t": 'a "}" [b' * (i % 3), "in": [{"x": {}}] * (i % 5)} for i in range(300)]
    for name, indent in (("a", None), ("b", 2)):
        with open(os.path.join(tmp_dir, f"{name}.json"), "w") as f:
            json.dump(records, f, indent=indent)
    monkeypatch.setattr(json_arrays, "CHUNK", 4)
    monkeypatch.setattr(json_arrays, "TASK_BYTES", 2000)
    df = json_arrays.elements(spark, tmp_dir)
    rows = df.orderBy("at.file", "at.block", "at.line", "pos").collect()
    assert [json.loads(r["text"]) for r in rows] == records + records
    # one split is read by many tasks after the scan, whatever spark.sql.shuffle.partitions is
    assert json_arrays._tasks(spark, tmp_dir) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert json_arrays.pieces(spark, tmp_dir).select("file", "block", "chunk").distinct().count() > 50


def test_scan_for_chunk_starts_moves_no_text(spark, tmp_dir):
    from tessera.sources import json_arrays
    with open(os.path.join(tmp_dir, "a.json"), "w") as f:
        f.write('[{"a": 1}, {"a": 2}]')
    plan = json_arrays.chunk_starts(json_arrays.pieces(spark, tmp_dir), 3)._jdf.queryExecution().sparkPlan().toString()
    moved = [x for x in plan.split("\n") if "Exchange" in x or "RepartitionByExpression" in x]
    assert moved and not any("value" in x for x in moved)


def test_array_split_file_is_one_array_whatever_the_order_of_its_parts(spark, tmp_dir, monkeypatch):
    """The brackets are placed by a sort: a reader of one partition may get its blocks in any order."""
    from tessera.plans import q_shop
    rows = spark.range(200).selectExpr("cast(id as string) order_id", "cast(id % 7 as int) line_no", "'c' customer_id", "'O' status",
                                       "'USD' currency").repartition(5)
    path = os.path.join(tmp_dir, "one")
    monkeypatch.setattr(q_shop.tv, "shop_landing_orders", lambda spark, sf: rows)
    monkeypatch.setattr(q_shop, "scratch_path", lambda spark, name: path)
    assert q_shop.q_landing_array_split(spark, "").count() == 200
    (name,) = glob.glob(path + "/*.txt")
    with open(name) as f:
        text = f.read()
    assert len(json.loads(text)) == 201 and text.startswith("[")


# ---- files that tasks write many of, one row each -------------------------------

def test_landing_files_are_written_by_few_tasks(spark):
    from tessera.plans import q_shop
    assert q_shop._tasks(spark, 0) == q_shop._tasks(spark, 1000) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert q_shop._tasks(spark, 36_000_000) == 144  # not one per file of 500 rows


def test_change_of_a_partitioned_table_moves_side_files_without_a_shuffle(spark, tmp_dir, monkeypatch):
    from tessera.sources import tables
    df = spark.range(1000).selectExpr("id", "cast(id % 3 as int) p", "'x' v")
    t = ParquetTable(spark, os.path.join(tmp_dir, "t"), df.schema, ("p",)).overwrite(df)
    balanced = []
    real = type(df).hint
    monkeypatch.setattr(type(df), "hint", lambda self, name, *a: balanced.append(name) or real(self, name, *a))
    t.merge(spark.range(990, 1010).selectExpr("id", "cast(id % 2 as int) p", "'y' v"), "id")
    assert balanced == ["rebalance"]  # the side write only
    got = {r["id"]: (r["p"], r["v"]) for r in t.read().collect()}
    assert got == {i: (i % 2, "y") if i >= 990 else (i % 3, "x") for i in range(1010)}


def test_landing_days_hold_their_records_in_ingest_order(spark, tmp_dir, monkeypatch):
    from tessera.plans import q_shop
    rows = spark.range(60).selectExpr(
        "cast(id % 4 as string) order_id", "timestamp_ntz'2024-01-01 00:00:00' order_timestamp", "'c' customer_id", "'p' product_id",
        "if(id % 5 = 0, null, cast(id as string)) quantity", "1.5D total_amount", "'USD' currency", "'O' status",
        "cast(id % 7 as int) line_no", "if(id % 2 = 0, date'2025-01-01', date'2025-01-02') landing_date").repartition(4)
    monkeypatch.setattr(q_shop.tv, "shop_landing_orders", lambda spark, sf: rows)
    none = lambda names: lambda spark, sf: spark.createDataFrame([], names)
    monkeypatch.setattr(q_shop.tv, "shop_customers", none("customer_id string, first_name string, signup_date date"))
    monkeypatch.setattr(q_shop.tv, "shop_products", none("product_id string, unit_price decimal(10,2)"))
    monkeypatch.setattr(F, "array_sort", None)  # its comparator is called row by row
    q_shop._landing_files(spark, "", tmp_dir)
    for day, odd in (("20250101", 0), ("20250102", 1)):
        texts = [r.value for r in spark.read.text(f"{tmp_dir}/orders/orders_{day}.json").collect()]
        got = [x.get("quantity") for t in texts for x in json.loads(t)]
        want = sorted((i for i in range(60) if i % 2 == odd), key=lambda i: (i % 7, i % 5 != 0, i))
        assert got == [None if i % 5 == 0 else str(i) for i in want]


# ---- disk: many small array files ------------------------------------------------

def test_small_array_files_are_read_together(spark, tmp_dir, monkeypatch):
    import gzip
    from tessera.sources import files
    n = 4 * spark.sparkContext.defaultParallelism
    for k in range(n):
        text = json.dumps([{"a": k * 10 + i} for i in range(3)])
        with (gzip.open(os.path.join(tmp_dir, f"{k}.json.gz"), "wt") if k % 2 else open(os.path.join(tmp_dir, f"{k}.json"), "w")) as f:
            f.write(text)
    schema = spark.createDataFrame([], "a long").schema
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")  # less than a file's open cost: a scan task per file
    try:
        df = read_json_records(spark, tmp_dir, schema, ingest_order=True)
        assert df.rdd.getNumPartitions() == n // 4
        rows = df.orderBy("_ingest.file", "_ingest.block", "_ingest.pos").collect()
        assert len({r["_ingest"]["file"] for r in rows}) == n and [r["a"] % 10 for r in rows] == [0, 1, 2] * n
        assert sorted(r["a"] for r in rows) == [k * 10 + i for k in range(n) for i in range(3)]
        monkeypatch.setattr(files, "TASK_BYTES", 60)
        assert n // 4 < read_json_records(spark, tmp_dir, schema).rdd.getNumPartitions() <= n  # tasks follow the text
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_large_compressed_array_files_are_split(spark, tmp_dir):
    import gzip
    records = [{"a": i, "t": "}]["} for i in range(2000)]
    with gzip.open(os.path.join(tmp_dir, "a.json.gz"), "wt") as f:
        json.dump(records, f)
    size = os.path.getsize(os.path.join(tmp_dir, "a.json.gz"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(2 * size))  # more than the file, less than its text
    try:
        df = read_json_records(spark, tmp_dir, spark.createDataFrame([], "a long, t string").schema)
        assert "Window" in df._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(tuple, df.collect())) == [(i, "}][") for i in range(2000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


LANDING = ["cast(id % 40 as string) order_id", "timestamp_ntz'2024-01-01 00:00:00' order_timestamp", "'c' customer_id", "'p' product_id",
           "if(id % 5 = 0, null, cast(id as string)) quantity", "1.5D total_amount", "'USD' currency", "concat('O', id) status",
           "cast(id as int) line_no"]


def test_array_files_are_compressed_and_hold_whole_records(spark, tmp_dir, monkeypatch):
    from tessera.plans import q_shop
    rows = spark.range(4000).selectExpr(*LANDING, "date'2025-01-01' landing_date").repartition(5)
    path = os.path.join(tmp_dir, "arrays")
    monkeypatch.setattr(q_shop.tv, "shop_landing_orders", lambda spark, sf: rows)
    monkeypatch.setattr(q_shop, "scratch_path", lambda spark, name: path)
    got = {r["order_id"]: (r["quantity"], r["raw_status"], r["raw_line"], r["raw_missing"]) for r in q_shop.q_landing_array_files(spark, "").collect()}
    last = {str(i % 40): i for i in range(4000) if i % 5}  # the last of an order whose quantity is known
    assert got == {k: (i, f'"O{i}"', i, True) for k, i in last.items()}
    names = glob.glob(path + "/part-*")
    assert len(names) == 8 and all(f.endswith(".gz") for f in names)
    texts = [json.loads(r.value) for r in spark.read.text(path, wholetext=True).collect()]
    assert sum(map(len, texts)) == 4000 and all(x["missing"] is None for t in texts for x in t)


def test_staging_moves_the_quantity_once_where_the_record_is_kept(spark):
    from tessera import testviews as tv
    from tessera.plans import shop_daily as shop
    plain = spark.range(8).selectExpr(*LANDING)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    staged = shop.stage_orders(plain.withColumn("raw_json", F.lit("{}")), tv.SHOP_ORDERS_INGEST)
    assert "_quantity_text" not in plan(staged) and {r["raw_json"] for r in staged.collect()} == {"{}"}
    built = shop.stage_orders(plain, tv.SHOP_ORDERS_INGEST).collect()
    assert all(json.loads(r["raw_json"])["quantity"] == str(r["quantity"]) for r in built) and len(built) == 6


def test_landing_days_are_compressed(spark, tmp_dir, monkeypatch):
    from tessera.plans import q_shop
    rows = spark.range(300).selectExpr(*LANDING, "if(id % 3 = 0, date'2025-01-01', date'2025-01-02') landing_date").repartition(3)
    monkeypatch.setattr(q_shop.tv, "shop_landing_orders", lambda spark, sf: rows)
    none = lambda names: lambda spark, sf: spark.createDataFrame([], names)
    monkeypatch.setattr(q_shop.tv, "shop_customers", none("customer_id string, first_name string, signup_date date"))
    monkeypatch.setattr(q_shop.tv, "shop_products", none("product_id string, unit_price decimal(10,2)"))
    q_shop._landing_files(spark, "", tmp_dir)
    for day, of in (("20250101", [i for i in range(300) if i % 3 == 0]), ("20250102", [i for i in range(300) if i % 3])):
        names = glob.glob(f"{tmp_dir}/orders/orders_{day}.json/part-*")
        assert names and all(f.endswith(".gz") for f in names)
        (text,) = [r.value for r in spark.read.text(f"{tmp_dir}/orders/orders_{day}.json", wholetext=True).where("value <> ''").collect()]
        assert [x["status"] for x in json.loads(text)] == [f"O{i}" for i in of]  # in ingest order
        assert [x.get("quantity") for x in json.loads(text)] == [str(i) if i % 5 else None for i in of]


def test_fact_rows_move_no_record_text(spark):
    from tessera import schemas
    from tessera.plans import shop_daily as shop
    stg = schemas.conform(spark.range(120).selectExpr(*LANDING, "repeat(cast(id as string), 9) raw_json"), schemas.STG_ORDERS)
    fact = shop.fact_rows(stg, "2025-01-01")
    assert "repeat(" not in fact._jdf.queryExecution().optimizedPlan().toString()
    got = {r["order_id"]: (r["quantity"], r["status"]) for r in fact.collect()}
    assert len(got) == 40 and got["0"] == (None, "O80") and got["1"] == (81, "O81")  # a null quantity comes first


def test_change_does_not_move_a_table_by_partition(spark, tmp_dir, monkeypatch):
    """All rows of a partition value would go through one task."""
    from tessera.sources import tables
    df = spark.range(4000).selectExpr("id", "cast(id % 3 as int) p", "sha2(cast(id as string), 256) v")
    t = ParquetTable(spark, os.path.join(tmp_dir, "t"), df.schema, ("p",)).overwrite(df)
    plans, real = [], tables._semi

    def semi(*a):
        out = real(*a)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(tables, "_semi", semi)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")  # less than the table, more than the partitions' names
    try:
        t.merge(spark.range(3990, 4010).selectExpr("id", "cast(null as int) p", "'y' v"), "id")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0] and "Exchange hashpartitioning" not in plans[0]
    got = {r["id"]: (r["p"], r["v"] == "y") for r in t.read().collect()}
    assert got == {i: (i % 3, False) if i < 3990 else (None, True) for i in range(4010)}
