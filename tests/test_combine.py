"""Unions, suffix matching, conflict policies, single-scan ≡ fold, path tags, plans."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from conftest import SMALL, rows
from tessera.operators.align import SchemaConflict
from tessera.operators.combine import (combine_by_suffix, combine_parquet_tables, combine_tables, match_suffix,
                                       tag, union_by_name, union_positional, union_tagged)


def test_match_suffix_is_exact_and_undelimited():
    names = ["shop_p_order", "shop_p_order_totals", "reorder", "Order", "combined_order"]
    assert match_suffix(names, "order", exclude=["combined_order"]) == ["shop_p_order", "reorder"]
    assert match_suffix(names, "_order_totals") == ["shop_p_order_totals"]


def test_tag_positions(spark):
    df = spark.createDataFrame([(1, "x")], "id int, source_table string")
    assert tag(df, "t", "source").columns == ["source", "id", "source_table"]
    replaced = tag(df, "t", "SOURCE_TABLE", "last")
    assert replaced.columns == ["id", "SOURCE_TABLE"] and replaced.first()[1] == "t"


def test_positional_union_width_mismatch(spark):
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    b = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        union_positional([a, b])


def test_union_tagged_names_from_first_branch_and_duplicates_kept(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(1, "x"), (1, "x")], "k int, n string")
    out = union_tagged([("a", a), ("b", b)])
    assert out.columns == ["source", "id", "name"]
    assert rows(out) == [("a", 1, "x"), ("b", 1, "x"), ("b", 1, "x")]


def test_by_name_order_and_null_fill(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, "z")], "id int, z string")
    out = combine_tables({"ta": a, "tb": b})
    assert out.columns == ["id", "a", "source_table", "z"]
    assert rows(out) == [(1, "x", "ta", None), (2, None, "tb", "z")]


def test_by_name_nested_struct_missing_fields(spark):
    a = spark.createDataFrame([(1, (1, 2))], "id int, s struct<p:int,q:int>")
    b = spark.createDataFrame([(2, (3,))], "id int, s struct<p:int>")
    out = union_by_name([a, b])
    assert rows(out.select("id", "s.q")) == [(1, 2), (2, None)]


def test_conflict_policies(spark):
    a = spark.createDataFrame([(1, 10)], "id int, v int")
    b = spark.createDataFrame([(2, "x")], "id int, v string")
    assert rows(union_by_name([a, b], on_conflict="string")) == [(1, "10"), (2, "x")]
    with pytest.raises(SchemaConflict):
        union_by_name([a, b], on_conflict="fail")
    c = spark.createDataFrame([(3, 7)], "id int, v bigint")
    widened = union_by_name([a, c], on_conflict="widen")
    assert dict(widened.dtypes)["v"] == "bigint"


def test_combine_by_suffix_skips_unmatched_and_outputs(spark):
    t = {n: spark.createDataFrame([(1,)], "id int") for n in ["x_order", "y_order", "x_conf", "all_order"]}
    out = combine_by_suffix(t, {"_order": "all_order", "_missing": "nothing"})
    assert list(out) == ["all_order"]
    assert sorted(r.source_table for r in out["all_order"].collect()) == ["x_order", "y_order"]


def _write_tables(spark, base, n, names=None):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    roots = {}
    for i in range(n):
        name = names[i] if names else f"t{i:02d}_order"
        part = orders.where(F.col("o_orderkey") % n == i)
        if i % 3 == 1:
            part = part.drop("o_totalprice")
        if i % 3 == 2:
            part = part.withColumn("extra", F.lit(i))
        roots[name] = f"{base}/{name}"
        part.write.parquet(f"{roots[name]}/batch {i % 2}")
    return roots


def test_single_scan_equals_fold(spark, tmp_base):
    roots = _write_tables(spark, tmp_base, 18)
    fold = combine_parquet_tables(spark, roots, plan="fold", partition_levels=1)
    scan = combine_parquet_tables(spark, roots, plan="scan", partition_levels=1)
    auto = combine_parquet_tables(spark, roots, partition_levels=1)
    assert fold.columns == scan.columns == auto.columns
    assert rows(fold) == rows(scan)
    assert "Union" not in auto._jdf.queryExecution().optimizedPlan().toString()
    assert scan.where("partition_0 = 'batch 1'").count() + scan.where("partition_0 = 'batch 0'").count() == scan.count()


def test_input_order_does_not_change_rows(spark, tmp_base):
    roots = _write_tables(spark, tmp_base, 4)
    a = combine_parquet_tables(spark, roots, plan="fold")
    b = combine_parquet_tables(spark, dict(reversed(list(roots.items()))), plan="fold")
    assert rows(a.select(sorted(a.columns))) == rows(b.select(sorted(a.columns)))


def test_path_tags_with_awkward_names(spark, tmp_base):
    names = ["a b_order", "p%c+t_order", "日本_order"]
    roots = _write_tables(spark, tmp_base, 3, names)
    for plan in ("scan", "fold"):
        out = combine_parquet_tables(spark, roots, plan=plan, partition_levels=1)
        got = {r.source_table for r in out.select("source_table").distinct().collect()}
        assert got == set(names)
        assert {r.partition_0 for r in out.select("partition_0").distinct().collect()} == {"batch 0", "batch 1"}


def test_file_directly_under_root_has_no_partition(spark, tmp_base):
    spark.range(3).write.parquet(f"{tmp_base}/t_x")
    out = combine_parquet_tables(spark, {"t_x": f"{tmp_base}/t_x"}, partition_levels=1)
    assert {r.partition_0 for r in out.collect()} == {None}


def test_rows_out_equal_sum_of_inputs(spark, tmp_base):
    roots = _write_tables(spark, tmp_base, 5)
    out = combine_parquet_tables(spark, roots)
    counts = {r.source_table: r["count"] for r in out.groupBy("source_table").count().collect()}
    for name, root in roots.items():
        assert counts[name] == spark.read.option("recursiveFileLookup", "true").parquet(root).count()


def test_provenance_filter_prunes_branches_and_columns(spark):
    t = {n: spark.read.parquet(f"{SMALL}/{n}.parquet").selectExpr(f"{k} AS id", f"{c} AS name")
         for n, k, c in [("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name")]}
    out = union_tagged(list(t.items())).where("source = 'supplier'").select("id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "supplier.parquet" in plan
    assert "ReadSchema: struct<s_suppkey:bigint>" in plan


def test_filter_reaches_every_branch_scan(spark):
    t = {n: spark.read.parquet(f"{SMALL}/{n}.parquet").selectExpr(f"{k} AS id")
         for n, k in [("customer", "c_custkey"), ("supplier", "s_suppkey")]}
    plan = union_tagged(list(t.items())).where("id < 10")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(c_custkey), LessThan(c_custkey,10)]" in plan
    assert "PushedFilters: [IsNotNull(s_suppkey), LessThan(s_suppkey,10)]" in plan


def test_known_schema_skips_inference(spark, tmp_base):
    roots = _write_tables(spark, tmp_base, 6)
    fold = combine_parquet_tables(spark, roots, plan="fold", partition_levels=1)
    schema = spark.read.parquet(f"{SMALL}/orders.parquet").schema.add("extra", IntegerType())
    given = combine_parquet_tables(spark, roots, partition_levels=1, schema=schema)
    cols = sorted(fold.columns)
    assert sorted(given.columns) == cols
    assert rows(given.select(cols)) == rows(fold.select(cols))


def test_many_roots_with_awkward_names_use_lookup_join(spark, tmp_base):
    spark.range(40 * 3).selectExpr("id", "CAST(id % 40 AS INT) AS t").write.partitionBy("t").parquet(
        f"{tmp_base}/d x+%")
    roots = {f"table {i:02d}": f"{tmp_base}/d x+%/t={i}" for i in range(40)}
    out = combine_parquet_tables(spark, roots, plan="scan")
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    got = {(r.source_table, r["count"]) for r in out.groupBy("source_table").count().collect()}
    assert got == {(f"table {i:02d}", 3) for i in range(40)}


def test_combine_job_reports_failures_when_asked(spark, tmp_base):
    from tessera.operators.align import SchemaConflict
    from tessera.plans.consolidation import consolidate_by_suffix
    spark.createDataFrame([(1,)], "v int").write.parquet(f"{tmp_base}/in/a_x")
    spark.createDataFrame([("z",)], "v string").write.parquet(f"{tmp_base}/in/b_x")
    spark.createDataFrame([(2,)], "v int").write.parquet(f"{tmp_base}/in/a_y")
    roots = {n: f"{tmp_base}/in/{n}" for n in ["a_x", "b_x", "a_y"]}
    suffixes = {"_x": "all_x", "_y": "all_y", "_z": "all_z"}
    with pytest.raises(SchemaConflict):
        consolidate_by_suffix(spark, roots, suffixes, f"{tmp_base}/out1", on_conflict="fail")
    report = {r.suffix: (r.n_tables, r.n_rows, r.status.split(":")[0])
              for r in consolidate_by_suffix(spark, roots, suffixes, f"{tmp_base}/out2", on_conflict="fail",
                                             on_error="report").collect()}
    assert report == {"_x": (2, 0, "failed"), "_y": (1, 1, "written"), "_z": (0, 0, "no match")}


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.sets(st.sampled_from(["a", "b", "c", "d"])), st.integers(0, 5), st.booleans()),
                min_size=1, max_size=6))
def test_fold_equals_scan_property(spark, tables):
    # Random tenant tables: a random subset of a column pool (one type per
    # name), 0-5 rows, files directly under the root or one level down.
    import uuid as _uuid

    from tessera.session import scratch_path
    base = scratch_path(spark, "prop")
    types = {"a": "int", "b": "string", "c": "double", "d": "boolean"}
    roots = {}
    for i, (cols, n, nested) in enumerate(tables):
        cols = sorted(cols) or ["a"]
        df = spark.range(n).selectExpr("id AS k", *[f"CAST(id AS {types[c]}) AS {c}" for c in cols])
        name = f"t{i}_{_uuid.uuid4().hex[:4]}"
        roots[name] = f"{base}/{name}"
        df.write.parquet(roots[name] + ("/part one" if nested else ""))
    fold = combine_parquet_tables(spark, roots, plan="fold")
    scan = combine_parquet_tables(spark, roots, plan="scan")
    assert fold.columns == scan.columns
    assert rows(fold) == rows(scan)


def test_positional_conflicts_are_checked_by_position(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([("k2", "y")], "code string, label string")
    out = union_tagged([("a", a), ("b", b)])
    assert out.columns == ["source", "id", "name"] and dict(out.dtypes)["id"] == "string"
    assert rows(out) == [("a", "1", "x"), ("b", "k2", "y")]
    with pytest.raises(SchemaConflict):
        union_tagged([("a", a), ("b", b)], on_conflict="fail")


def _tables(spark, base, many):
    """``many`` one-folder tables at two depths, one nested inside another, one under three names."""
    roots = {}
    for k in range(many):
        roots[f"t{k}_order"] = f"{base}/a/t{k}_order" if k % 2 else f"{base}/b/deep er/t{k}_order"
        spark.createDataFrame([(k, f"v{k}")], "id int, v string").write.parquet(f"{roots[f't{k}_order']}/batch {k}")
    roots["inner"] = f"{roots['t1_order']}/more"
    spark.createDataFrame([(1000, "x")], "id int, v string").write.parquet(roots["inner"] + "/b")
    roots["alpha"] = roots["beta"] = roots["t0_order"]
    roots["table"] = roots["t0_order"] + "/"
    return roots


@pytest.mark.parametrize("many", [2, 13, 40])
def test_fold_and_scan_agree_on_aliases_nesting_and_depths(spark, tmp_base, many):
    roots = _tables(spark, tmp_base, many)
    plans = {p: combine_parquet_tables(spark, roots, plan=p, partition_levels=1) for p in ("fold", "scan", "auto")}
    fold = rows(plans["fold"])
    assert len(fold) == many + 1 + 1 + 3  # the nested file belongs to both tables around it
    assert rows(plans["scan"]) == fold and rows(plans["auto"]) == fold
    assert plans["scan"].columns == plans["fold"].columns
    known = plans["fold"].select("id", "v").schema
    assert len(combine_parquet_tables(spark, roots, schema=known).collect()) == len(fold)


def test_columns_of_later_batches_are_kept(spark, tmp_base):
    roots = {n: f"{tmp_base}/{n}" for n in ("a_order", "b_order")}
    for root in roots.values():
        spark.createDataFrame([(1,)], "id int").write.parquet(f"{root}/b1")
        spark.createDataFrame([(2 ** 40, "x")], "id bigint, late string").write.parquet(f"{root}/b2")
    want = sorted([(1, None, n) for n in roots] + [(2 ** 40, "x", n) for n in roots], key=str)
    for plan in ("fold", "auto"):
        assert sorted((tuple(r) for r in combine_parquet_tables(spark, roots, plan=plan).collect()), key=str) == want
    same = {n: f"{tmp_base}/c/{n}" for n in ("c_order", "d_order")}
    for root in same.values():
        spark.createDataFrame([(1,)], "id int").write.parquet(f"{root}/b1")
        spark.createDataFrame([(2, "x")], "id int, late string").write.parquet(f"{root}/b2")
    for plan in ("fold", "scan", "auto"):
        assert rows(combine_parquet_tables(spark, same, plan=plan).select("id", "late")) == rows(
            spark.createDataFrame([(1, None), (2, "x")] * 2, "id int, late string"))


def test_lossless_widening():
    from pyspark.sql.types import (ArrayType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType,
                                   StringType, StructField, StructType, TimestampNTZType, TimestampType)
    from tessera.operators.align import widened
    i, b, d = IntegerType(), LongType(), DoubleType()
    for x, y, want in ((i, b, b), (ShortType(), i, i), (i, d, d), (b, d, None), (FloatType(), d, d), (i, FloatType(), d),
                       (DecimalType(10, 2), DecimalType(8, 4), DecimalType(12, 4)), (b, DecimalType(10, 2), DecimalType(21, 2)),
                       (DecimalType(38, 0), DecimalType(10, 2), None), (DateType(), TimestampNTZType(), TimestampNTZType()),
                       (DateType(), TimestampType(), None), (StringType(), i, None), (ArrayType(i), ArrayType(b), ArrayType(b))):
        assert widened(x, y) == want and widened(y, x) == want
    one, two = StructType([StructField("a", i)]), StructType([StructField("a", b), StructField("c", i)])
    assert widened(one, two) == two


def test_text_of_nested_and_binary_values(spark):
    a = spark.sql("SELECT named_struct('x', 1) AS s, X'FF00' AS b")
    c = spark.sql("SELECT 's' AS s, 'b' AS b")
    assert rows(union_by_name([a, c])) == [("s", "b"), ('{"x":1}', "/wA=")]
    wider = spark.sql("SELECT named_struct('x', 5000000000L, 'y', 2) AS s, X'01' AS b")
    assert [r["s"].asDict() for r in union_by_name([a, wider]).collect()] == [{"x": 1, "y": None}, {"x": 5000000000, "y": 2}]


def test_empty_matched_tables_are_counted(spark):
    from tessera.operators.combine import suffix_match_counts
    frames = {"a_order": spark.createDataFrame([(1,)], "id int"), "b_order": spark.createDataFrame([], "id int")}
    counts = suffix_match_counts(combine_tables(frames), names=list(frames))
    assert rows(counts) == [("a_order", 1, 2), ("b_order", 0, 2)]
