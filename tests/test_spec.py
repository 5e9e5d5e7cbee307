"""Spec loading, validation, typing, edits, DDL."""

import pytest
from pyspark.sql import types as T

from logweir.plans import spec as sp
from logweir.plans.paths import split_path, step_text

KILN_SPEC = """
version: 8
tables:
  firings:
    src: kiln.firing
    src_type: dict
    columns:
    - {log_key: peak, sql_attr: "decimal(6, 1)"}
    - {log_key: glaze, sql_attr: varchar(30) default 'none'}
    - {log_key: opened, sql_attr: timestamp}
    - {log_key: kiln.id, name: kiln, sql_attr: int4 not null distkey, is_foreign: true, is_mandatory: true}
    - {log_key: notes, sql_attr: varchar(65535), is_json: true}
    sortkey_attr: [kiln, opened]
  readings:
    src: kiln.firing.readings
    src_type: sparse_list
    columns:
    - {log_key: celsius, sql_attr: float8}
    - {log_key: index, name: minute, sql_attr: int4}
    sortkey_attr: []
  pots:
    src: kiln.pots
    src_type: list
    columns:
    - {name: __source_filename__, sql_attr: varchar(4096), is_derived: true}
    - {log_key: maker, sql_attr: varchar(20)}
    - {log_key: grams, sql_attr: int8}
    sortkey_attr: [grams]
"""


def table(*columns, **more):
    raw = {"src": "", "src_type": "dict", "columns": list(columns), "sortkey_attr": []}
    return sp.TableSpec.from_dict({**raw, **more})


def test_spec_of_three_tables():
    spec = sp.parse_spec(KILN_SPEC)
    assert spec.identity == "firings pots readings 8"
    firings, readings, pots = (spec.tables[n] for n in ("firings", "readings", "pots"))
    assert firings.distkeys == ["kiln"] and firings.sortkey_attr == ("kiln", "opened") and not readings.distkeys
    assert firings.struct_type["kiln"] == T.StructField("kiln", T.IntegerType(), False)
    assert (firings.column("peak").data_type, firings.column("glaze").default, firings.column("glaze").char_width) == (T.DecimalType(6, 1), "none", 30)
    assert [c.out_name for c in readings.columns] == ["celsius", "minute"] and pots.columns[0].is_derived
    assert sp.SchemaSpec.from_dict(spec.to_dict()) == spec == sp.parse_spec(sp.spec_text(spec))


def test_old_style_versions():
    column = {"log_key": "id", "sql_attr": "int8 not null"}
    raw = {n: {"version": v, "src": "", "src_type": "dict", "columns": [column]} for n, v in (("reefs", 4), ("buoys", 9), ("tides", 2))}
    spec = sp.SchemaSpec.from_dict(raw)
    assert spec.version == 9
    assert spec.identity == "buoys: 9 reefs: 4 tides: 2"


def test_new_style_identity():
    spec = sp.SchemaSpec({n: table() for n in ("tides", "buoys", "reefs")}, 6)
    assert spec.identity == "buoys reefs tides 6"


def test_inline_sortkeys_are_lifted():
    raw = {"version": 1, "tables": {"t": {"src": "", "src_type": "dict", "columns": [
        {"log_key": "a", "sql_attr": "TIMESTAMP sortkey"}, {"log_key": "b", "name": "c", "sql_attr": "int8 sortkey not null"}]}}}
    t = sp.SchemaSpec.from_dict(raw).tables["t"]
    assert t.sortkey_attr == ("a", "c")
    assert [c.sql_attr for c in t.columns] == ["TIMESTAMP", "int8 not null"]
    assert table(sortkey_attr="a").sortkey_attr == ("a",)


@pytest.mark.parametrize("broken", [
    {"src": "", "src_type": "dict", "columns": []},
    {"src": "", "src_type": "tree", "columns": [], "sortkey_attr": []},
    {"src": "", "src_type": "dict", "columns": {}, "sortkey_attr": []},
    {"src": "", "src_type": "dict", "columns": [{"log_key": "a"}], "sortkey_attr": []},
    {"src": "", "src_type": "dict", "columns": [{"sql_attr": "int8"}], "sortkey_attr": []},
    {"src": "", "src_type": "dict", "columns": [{"log_key": "a", "sql_attr": "int8", "is_json": "yes"}], "sortkey_attr": []},
])
def test_invalid_tables(broken):
    with pytest.raises(sp.SpecError):
        sp.TableSpec.from_dict(broken)


@pytest.mark.parametrize("attr, expected", [
    ("int2", T.ShortType()), ("smallint not null", T.ShortType()), ("int4", T.IntegerType()), ("int8", T.LongType()),
    ("float8", T.DoubleType()), ("float4", T.FloatType()), ("bool", T.BooleanType()), ("TIMESTAMP not null", T.TimestampType()),
    ("date", T.DateType()), ("varchar(7)", T.StringType()), ("CHAR(3)", T.StringType()), ("decimal(10, 2)", T.DecimalType(10, 2)),
])
def test_types(attr, expected):
    assert sp.ColumnSpec(attr, "x").data_type == expected


def test_unknown_types():
    for attr in ("UNKNOWN", "geometry"):
        with pytest.raises(sp.SpecError):
            sp.create_table_sql("t", table({"log_key": "a", "sql_attr": attr}))


@pytest.mark.parametrize("attr, default", [
    ("int8", None), ("int8 default 7", "7"), ("varchar(3) default 'a b'", "a b"), ('varchar(3) default "x"', "x"),
    ("int8 default (5) not null", "5"), ("bool default false", "false"),
])
def test_defaults(attr, default):
    assert sp.ColumnSpec(attr, "x").default == default


def test_attributes_are_read_in_any_order():
    attr = sp.read_attribute("varchar (9) DEFAULT 'not null' distkey NOT NULL")
    assert (attr.word, attr.sizes, attr.default, attr.distkey, attr.not_null, attr.sortkey) == ("varchar", (9,), "not null", True, True, False)


def test_all_problems_of_a_column_are_reported():
    t = sp.new_table("", "dict").add_column("n", "int8", "n")
    with pytest.raises(sp.SpecError, match="varchar.*log_key.*taken.*with_sortkeys"):
        t.add_column("n", "int8 sortkey", is_json=True, is_foreign=True)


def test_edits():
    t = sp.new_table("a.b", "list", add_source_filename=True)
    assert [c.out_name for c in t.columns] == ["index", "__source_filename__"]
    t = t.add_column("n", "int8 not null", "x.n").add_column("gap", "int8", is_noop=True).add_column("d", "int8")
    assert t.column("n").is_mandatory and t.column("gap").is_noop and t.column("d").is_derived
    for bad in (dict(name="n", sql_attr="int8"), dict(name="q", sql_attr="int8 sortkey"),
                dict(name="q", sql_attr="int8", is_json=True), dict(name="q", sql_attr="int8", is_foreign=True)):
        with pytest.raises(sp.SpecError):
            t.add_column(**bad)
    t = t.with_sortkeys(["n", "d"])
    assert t.remove_column("n").sortkey_attr == ("d",)
    for broken in (lambda: t.remove_column("zz"), lambda: t.with_sortkeys(["zz"])):
        with pytest.raises(sp.SpecError):
            broken()
    spec = sp.SchemaSpec().add_table("a", t)
    assert list(spec.rename_table("a", "b").tables) == ["b"]
    assert spec.edit_table("a", lambda x: x.remove_column("d")).tables["a"].columns[-1].out_name == "gap"
    assert "pipeline_errors" in spec.with_error_table().tables
    for broken in (lambda: spec.add_table("a", t), lambda: spec.remove_table("x"), lambda: spec.rename_table("x", "y")):
        with pytest.raises(sp.SpecError):
            broken()


def test_ddl(spark):
    t = table({"log_key": "id", "sql_attr": "int8 not null"}, {"log_key": "n", "sql_attr": "varchar(9) default 'it'"})
    assert sp.create_table_sql("t", t, None) == (
        "CREATE TABLE IF NOT EXISTS t (`id` BIGINT NOT NULL, `n` STRING DEFAULT 'it') USING parquet"
    )
    with pytest.raises(sp.SpecError):
        sp.create_table_sql("t", table({"log_key": "a", "sql_attr": "int8"}, {"log_key": "b", "name": "a", "sql_attr": "int8"}))
    names = [s.split()[5] for s in sp.create_tables_sql(sp.SchemaSpec({"b": t, "a": t}), "Logs")]
    assert names == ["logs.a", "logs.b"]
    assert sp.qualified_name("t", "PUBLIC") == "t"


def test_load_spec_from_file(spark, tmp_path):
    (tmp_path / "spec.yaml").write_text(KILN_SPEC)
    assert sp.load_spec(spark, str(tmp_path / "spec.yaml")) == sp.parse_spec(KILN_SPEC)


def test_paths():
    assert split_path("a.b") == ["a", "b"] and split_path("") == [] and split_path("$") == []
    assert step_text("a b-c") == "['a b-c']" and step_text("it's") == '["it\'s"]'
    for bad in ("", "a'\""):
        with pytest.raises(sp.SpecError):
            step_text(bad)
