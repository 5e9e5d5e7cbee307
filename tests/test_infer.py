"""Schema inference: leaf paths, type lattice, spec building."""

import json

import pytest
from pyspark.sql import types as T

from logweir.operators import infer
from logweir.operators.extract import extract_table
from logweir.operators.infer import InferOptions
from logweir.plans.spec import SchemaSpec, SpecError
from logweir.sources.lines import parse_lines


def lines(spark, *values):
    return spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v),) for v in values], "value string")


def folded(spark, values, **options):
    rows = infer.fold_types(infer.leaf_summary(lines(spark, *values), InferOptions(**options))).collect()
    return {r.path: (r.type, r.max_len) for r in rows}


PARCELS = [{"code": "K-1704", "grams": 12850, "stops": ["north", "mill"]}, {"code": "K-9", "grams": 3}, {"code": None, "grams": 77, "stops": []}]


def test_parcels(spark):
    table = infer.infer_table(lines(spark, *PARCELS))
    assert [(c.log_key, c.sql_attr, c.is_json) for c in table.columns] == [
        ("code", "varchar(8)", False), ("grams", "int4", False), ("stops", "varchar(65535)", True)]
    got = extract_table(parse_lines(lines(spark, *PARCELS)), table).collect()
    assert [(r.code, r.grams, r.stops) for r in got] == [("K-1704", 12850, '["north","mill"]'), ("K-9", 3, "null"), (None, 77, "[]")]


def test_long_lists_survive_inference_and_extraction(spark):
    document = {"marks": ["m" * 99] * 900}
    frame = lines(spark, document)
    got = extract_table(parse_lines(frame), infer.infer_table(frame)).first()
    assert json.loads(got.marks) == document["marks"] and len(got.marks) > 70_000


def test_dicts_keyed_by_data_are_reported(spark):
    frame = lines(spark, *[{"by_user": {f"u{n}": 1}, "day": {"n": n}} for n in range(30)])
    summary = infer.leaf_summary(frame)
    assert [tuple(r) for r in infer.wide_dicts(summary, 10).collect()] == [("by_user", 30)]
    assert len(infer.infer_table(frame).columns) == 31


@pytest.mark.parametrize("values, kind", [
    ([1, 2], "int"), ([1, 2**70], "long"), ([2**70, 1.5], "float"), ([1, 1.5, 2**70], "float"), ([1.5, 1], "float"),
    ([None, 1], "int"), ([None, None], "null"), (["a", "é"], "str"), ([True, None], "bool"), ([[1], None], "list"),
    ([True, 1], "mismatch"), (["a", 1], "mismatch"), ([[1], "a"], "mismatch"), ([{}, 1], "int"), ([[1], {"q": 1}], "list"),
])
def test_lattice(spark, values, kind):
    assert folded(spark, [{"x": v} for v in values])["x"][0] == kind


@pytest.mark.parametrize("value, length", [("Jimbo", 7), ("é", 8), (-12, 3), (1.5, 3), (1e22, 5), (True, 4), ([1, 2], 6), ('"\n', 6)])
def test_rendered_length(spark, value, length):
    assert folded(spark, [{"x": value}])["x"][1] == length


NESTED = {"a": {"b": {"c": 1, "d": "x"}, "e": [1]}, "k": {"10": {"v": 1}, "20": {"v": 2.5}}, "id": 7, "n": {}}


@pytest.mark.parametrize("options, paths", [
    ({}, {"a.b.c", "a.b.d", "a.e", "k.10.v", "k.20.v", "id"}),
    ({"depth": 1}, {"a", "k", "id", "n"}),
    ({"depth": 2}, {"a.b", "a.e", "k.10", "k.20", "id"}),
    ({"depth": 0}, {"value"}),
    ({"exclude": ("a.b", "k")}, {"a.e", "id"}),
    ({"prune": ("a.b", "k")}, {"a.b", "a.e", "k", "id"}),
    ({"source": "a"}, {"b.c", "b.d", "e"}),
    ({"source": "a.b", "foreign": ("id", "zz")}, {"c", "d", "id"}),
    ({"source": "k", "source_type": "sparse_list"}, {"v"}),
    ({"source": "a.e", "source_type": "list"}, {"value"}),
    ({"source": "zz"}, set()),
])
def test_options(spark, options, paths):
    assert set(folded(spark, [NESTED], **options)) == paths


def test_deep_documents_are_read_once(spark, tmp_path, monkeypatch):
    """Twenty levels, dicts inside lists left whole, an empty dict at the bottom; the plan holds one scan of the lines."""
    deep = {"x": 1, "empty": {}, "list": [{"y": {"z": 1}}]}
    for n in range(20):
        deep = {f"d{n}": deep, "n": n}
    frame = lines(spark, deep, {"n": 2.5}, {"d19": None, "n": None})
    frame.write.text(folder := str(tmp_path / "lines"))
    plans = []
    monkeypatch.setattr(infer, "stored", lambda rows, label: (plans.append(rows._jdf.queryExecution().optimizedPlan().toString()), rows)[1])
    got = {r.path: r.type for r in infer.fold_types(infer.leaf_summary(spark.read.text(folder))).collect()}
    path = ".".join(f"d{n}" for n in range(19, -1, -1))
    assert got[f"{path}.x"] == "int" and got[f"{path}.list"] == "list" and f"{path}.empty" not in got and got["n"] == "float"
    assert got["d19"] == "null" and len(got) == 23
    assert plans[0].count("Relation") == 1


def test_kinds_without_lengths(spark):
    lines = spark.createDataFrame([(json.dumps({"a": v, "b": {"c": {"d": {"e": {"f": v}}}}}),) for v in (
        1, 2**70, 1.5, 1e300, "x", 'q"\\', "5", "true", "\u00e9", True, None, [], [1, "a", {}], [None])], "value string")
    whole, kinds = infer.leaf_summary(lines), infer.leaf_summary(lines, lengths=False)
    assert not whole.where("max_len IS NULL").count() and not kinds.where("max_len IS NOT NULL").count()
    columns = ["path", "kind", "is_foreign"]
    assert sorted(map(tuple, whole.select(columns).collect())) == sorted(map(tuple, kinds.select(columns).collect()))
    assert {(r.path, r.kind) for r in kinds.collect()} == {(p, k) for p in ("a", "b.c.d.e.f") for k in (
        "int", "long", "float", "str", "bool", "null", "list")}


def test_order_does_not_matter(spark):
    values = [{"x": v} for v in (1, None, 2.5, 2**70, 12345)]
    forward, backward = folded(spark, values), folded(spark, values[::-1])
    assert forward == backward == {"x": ("float", len(str(2**70)))}


def test_table_of_a_list(spark):
    docs = [{"id": i, "results": [{"score": 0.5, "tags": ["a"], "deep": {"n": 123456}}, {"score": 1, "none": None}]} for i in range(3)]
    table = infer.infer_table(lines(spark, *docs), InferOptions("results", "list", foreign=("id",)), ["id"], add_source_filename=True)
    assert [(c.out_name, c.sql_attr, c.is_json, c.is_foreign) for c in table.columns] == [
        ("index", "smallint not null", False, False), ("__source_filename__", "varchar(4096)", False, False),
        ("id", "int2", False, True), ("deep_n", "int4", False, False), ("score", "float8", False, False), ("tags", "varchar(65535)", True, False)]


def test_errors(spark):
    with pytest.raises(infer.TypeMismatch, match="'x'"):
        infer.infer_table(lines(spark, {"x": 1}, {"x": "a"}))
    with pytest.raises(SpecError, match="a_b: the name is taken"):
        infer.infer_table(lines(spark, {"a": {"b": 1}, "a_b": 2}))
    with pytest.raises(ValueError, match="unsupported"):
        infer.leaf_summary(lines(spark), InferOptions(source_type="tree"))
    with pytest.raises(Exception, match="no JSON document"):
        infer.infer_table(lines(spark, "{"))
    assert len(infer.infer_table(lines(spark, "{", {"x": 1}), on_error="skip").columns) == 1


@pytest.mark.parametrize("kind, length, attr", [
    ("int", 4, "int2"), ("int", 5, "int4"), ("int", 9, "int4"), ("int", 10, "int8"), ("int", None, "int8"), ("long", 3, "int8"),
    ("float", 3, "float8"), ("bool", 5, "bool"), ("str", 9, "varchar(9)"), ("dict", 2, "varchar(65535)"), ("null", 4, None),
])
def test_sql_attr(kind, length, attr):
    assert infer.sql_attr_of(kind, length) == attr


def test_unknown_kind():
    with pytest.raises(infer.TypeUnknown):
        infer.sql_attr_of("bytes", 1)


def test_declared_struct():
    struct = T.StructType([
        T.StructField("id", T.LongType(), False),
        T.StructField("s", T.StructType([T.StructField("name", T.StringType(), False, {"max_len": 9}),
                                         T.StructField("deep", T.StructType([T.StructField("x", T.IntegerType())]))]), False),
        T.StructField("opt", T.StructType([T.StructField("y", T.DoubleType(), False)])),
        T.StructField("list", T.ArrayType(T.LongType()), False), T.StructField("map", T.MapType(T.StringType(), T.LongType())),
    ])
    table = infer.table_of_struct(struct, depth=2, exclude=("map",))
    assert [(c.out_name, c.sql_attr) for c in table.columns] == [
        ("id", "int8 not null"), ("list", "varchar(65535) not null"), ("opt_y", "float8"), ("s_name", "varchar(9) not null")]
    with pytest.raises(infer.TypeUnknown):
        infer.table_of_struct(T.StructType([T.StructField("b", T.BinaryType())]))


def test_merge():
    table = infer.build_table([{"path": "x", "type": "int", "max_len": 1, "is_json": False, "is_foreign": False}])
    spec = infer.merge_table(infer.merge_table(SchemaSpec(version=3), "t", table), "t", table.add_column("y", "int8", "y"))
    assert spec.version == 5 and len(spec.tables["t"].columns) == 2


def test_executors_need_not_have_the_package(tmp_path):
    """Workers started elsewhere cannot import this package; the walk must reach them by value."""
    import os
    import subprocess
    import sys

    from conftest import ROOT

    script = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from logweir.operators.infer import infer_table
print([c.out_name for c in infer_table(spark.createDataFrame([('{{"a": 1}}',)], "value string")).columns])
"""
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=120)
    assert "['a']" in done.stdout, done.stderr[-2000:]
