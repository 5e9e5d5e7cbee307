"""Extraction cases: paths, lists, blobs, timestamps, mandatory keys, quarantine."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from logweir.operators import checks, sinks
from logweir.operators.extract import extract_table, extract_tables
from logweir.operators.quarantine import BAD_LINE, error_rows
from logweir.plans.spec import SchemaSpec, SpecError, TableSpec, parse_spec
from logweir.sources.lines import document, is_document, parse_lines
from test_spec import KILN_SPEC


def docs(spark, *lines):
    return parse_lines(spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in lines], "value string"))


def table(src, src_type, *columns):
    return TableSpec.from_dict({"src": src, "src_type": src_type, "columns": list(columns), "sortkey_attr": []})


def col(log_key, sql_attr="varchar(99)", **more):
    return {"log_key": log_key, "sql_attr": sql_attr, **more}


def rows(frame):
    return [tuple(r) for r in frame.collect()]


TRIP = {"trip": {"legs": [{"km": 4.5, "by": "foot"}, {"km": 310, "by": "rail"}, {"by": "boat"}], "paid": True}, "who": {"badge": "Q7"}}


@pytest.mark.parametrize("text, path, value, absent, null", [
    ({"a": {"b": 5}}, ["a", "b"], "5", False, False),
    ({"a": {"b": None}}, ["a", "b"], None, False, True),
    ({"a": None}, ["a", "b"], None, False, False),
    ({"a": {}}, ["a", "b"], None, True, False),
    ({}, ["a", "b"], None, True, False),
    ({"a": 5}, ["a", "real"], None, True, False),
    ("null", ["a"], None, False, False),
    ("5", ["a"], None, True, False),
    ({"it's": {"x y-z": 1}}, ["it's", "x y-z"], "1", False, False),
])
def test_walk(spark, text, path, value, absent, null):
    node = document(F.col("doc"))
    got = docs(spark, text).select(node.get(path), node.is_absent(path), node.is_null(path), node.get_or(path, "d")).first()
    assert tuple(got) == (value, absent, null, "d" if value is None else value)


def test_get_or_whole_document(spark):
    assert docs(spark, {"a": 1}).select(document(F.col("doc")).get_or("", "x")).first()[0] == '{"a":1}'


@pytest.mark.parametrize("line, good", [
    ('{"a":1}', True), (' {"a":1} \r', True), ("5", True), ("null", True), ("[1]", True), ('"x"', True),
    ("", False), ("   ", False), ('{"a":1', False), ('{"a":1} x', False), ('{"a":1}{"a":2}', False), ('{"a":1},', False),
    ('{"a":1},{"a":2}', False), ('{"a":1}]', False), ('{"a":1}],[1', False), ("{'a':1}", False), ('{"a":01}', False),
])
def test_one_document_per_line(spark, line, good):
    assert docs(spark, line).select(is_document(F.col("doc"))).first()[0] is good


def test_last_duplicate_key_wins(spark):
    assert rows(extract_table(docs(spark, '{"a":1,"a":2}'), table("", "dict", col("a", "int8")))) == [(2,)]


def test_dict_list_foreign_and_index(spark):
    legs = table("trip.legs", "list", col("index", "smallint not null", is_mandatory=True), col("by"), col("km", "float8"),
                 col("who.badge", name="badge", is_foreign=True))
    assert rows(extract_table(docs(spark, TRIP), legs)) == [(0, "foot", 4.5, "Q7"), (1, "rail", 310.0, "Q7"), (2, "boat", None, "Q7")]
    whole = table("trip", "dict", col("paid", "bool"), col("legs", "varchar(65535)", is_json=True), col("hole", "int4", is_noop=True))
    assert rows(extract_table(docs(spark, TRIP), whole)) == [(True, '[{"by":"foot","km":4.5},{"by":"rail","km":310},{"by":"boat"}]', None)]


def test_list_corner_cases(spark):
    listed = table("l", "list", col("index", "smallint"), col("test", "int8"), col("value", "varchar(9)"))
    lines = [{"l": [None, {"test": 1}, 7, [1, 2], {"value": None, "test": 2}]}, {"l": []}, {"l": None}, {}, {"l": {"test": 3}}]
    assert rows(extract_table(docs(spark, *lines), listed)) == [
        (0, None, None), (1, 1, None), (2, None, "7"), (3, None, "[1,2]"), (4, 2, None)]
    with pytest.raises(PySparkException, match="not a list"):
        extract_table(docs(spark, {}), listed, on_error="fail").collect()


def test_elements_are_read_in_one_go(spark):
    columns = [col("by"), col("km", "float8"), col("n", "int4"), col("at", "TIMESTAMP"), col("a`b c")]
    elements = [{"by": "x", "km": "1.5", "n": 5.7, "at": 60, "a`b c": [1, {"z": None}]}, {"By": "y", "n": "7", "km": None, "by": {"k": 1}}, 5, None, [], {"n": 2**40}]
    want = [("x", 1.5, None, 60, '[1,{"z":null}]'), ('{"k":1}', None, 7, None, None), *[(None,) * 5] * 4]
    for src_type, held in (("list", elements), ("sparse_list", {str(n): e for n, e in enumerate(elements)})):
        found = extract_table(docs(spark, {"l": held}, {"l": 5}, {}), table("l", src_type, *columns))
        assert rows(found.withColumn("at", F.unix_seconds("at"))) == want
        assert "VariantType,true)" not in found._jdf.queryExecution().executedPlan().toString()


def test_root_list(spark):
    assert rows(extract_table(docs(spark, [{"a": 1}, {"a": 2}]), table("$", "list", col("index", "int4"), col("a", "int8")))) == [(0, 1), (1, 2)]


def test_sparse_list(spark):
    sparse = table("e", "sparse_list", col("index", "int4"), col("value"), col("cohort"), col("id", "int8", is_foreign=True))
    lines = {"id": 9, "e": {"10": "on", "2": {"cohort": "b"}, "x": None}}
    assert sorted(rows(extract_table(docs(spark, lines), sparse)), key=str) == sorted(
        [(10, "on", None, 9), (2, None, "b", 9), (None, None, None, 9)], key=str)


def test_blob(spark):
    blob = table("", "dict", col("x", "varchar(65535)", is_json=True))
    fits, too_long = "a" * 65533, "a" * 65534
    got = rows(extract_table(docs(spark, {"x": {"b": 1, "a": [1.5, "q\"é"]}}, {"x": None}, {}, {"x": fits}, {"x": too_long}), blob))
    assert got == [('{"a":[1.5,"q\\"é"],"b":1}',), ("null",), ("null",), (f'"{fits}"',), (f'"{too_long}"',)]
    frame = docs(spark, {"x": fits}, {"x": too_long})
    assert rows(extract_table(frame, blob, json_limit=65535)) == [(f'"{fits}"',), (None,)]
    assert rows(checks.over_limit(extract_table(frame, blob), blob, "t", 65535)) == [("t", "x", 1)]


def test_times_out_of_range_are_counted(spark):
    spec = SchemaSpec({"d": table("", "dict", col("t", "TIMESTAMP")), "l": table("l", "list", col("ms", "timestamp"), col("v", "int8"))})
    frame = docs(spark, {"t": 10**12, "l": [{"ms": 5}, {"ms": 10**17}]}, {"t": 5}, {"t": -(10**12), "l": [{"ms": 10**18}]})
    assert sorted(rows(checks.times_out_of_range(frame, spec))) == [("d", "t", 2), ("l", "ms", 2)]


def test_scalars_as_text(spark):
    t = table("", "dict", col("x"))
    values = [True, 1.5, 12345678901234567890123, "t", {"b": 1, "a": 2}, [1]]
    assert [r[0] for r in rows(extract_table(docs(spark, *[{"x": v} for v in values]), t))] == [
        "true", "1.5", "12345678901234567890123", "t", '{"a":2,"b":1}', "[1]"]


def test_bad_values_become_null(spark):
    t = table("", "dict", col("x", "int2"))
    assert [r[0] for r in rows(extract_table(docs(spark, *[{"x": v} for v in (5, "6", 5.7, 70000, "a", True)]), t))] == [
        5, 6, None, None, None, None]


@pytest.mark.parametrize("attr, value, expected", [
    ("TIMESTAMP not null", 1, 1.0), ("TIMESTAMP", 1.9, 1.0), ("TIMESTAMP", "7", 7.0), ("timestamp", 1500, 1.5),
    ("TIMESTAMP", "x", None), ("TIMESTAMP", -5, -5.0), ("TIMESTAMP", -9223372036854775808, None), ("TIMESTAMP", 10**18, None),
])
def test_timestamps(spark, attr, value, expected):
    got = rows(extract_table(docs(spark, {"t": value}), table("", "dict", col("t", attr))).select(F.unix_micros("t")))
    assert got == [(None if expected is None else int(expected * 1e6),)]


def test_mandatory(spark):
    need = SchemaSpec({"t": table("search", "dict", col("a.b", is_mandatory=True))})
    lines = [{"search": {"a": {"b": 1}}}, {"search": {"a": {"b": None}}}, {"search": {"a": None}}, {"search": {"b": None}}, "bad"]
    assert rows(extract_tables(docs(spark, *lines), need)["t"]) == [("1",), (None,), (None,)]
    errors = error_rows(docs(spark, *lines), need).select("error_reason", "error_detail", "raw_line", "line_number")
    assert rows(errors) == [
        ("required key missing", "t: search: a.b", '{"search": {"b": null}}', None),
        (BAD_LINE, BAD_LINE, "bad", None)]
    with pytest.raises(PySparkException, match="required key missing: t: search: a.b"):
        extract_tables(docs(spark, *lines[:4]), need, on_error="fail")["t"].collect()


@pytest.mark.parametrize("mebibytes, reason", [(19, None), (20, BAD_LINE)])
def test_huge_documents(spark, mebibytes, reason):
    """Up to Spark's limit a text is extracted whole; beyond it the whole line is in the error table."""
    text = F.concat(F.lit('{"a":"'), F.repeat(F.lit("x" * 1024), F.lit(mebibytes * 1024)), F.lit('"}'))
    frame = parse_lines(spark.range(1).select(text.alias("value")))
    one = SchemaSpec({"t": table("", "dict", col("a", "text"))})
    good = rows(extract_tables(frame, one)["t"].select(F.length("a")))
    bad = rows(error_rows(frame, one).select("error_reason", F.length("raw_line")))
    assert good == ([] if reason else [(mebibytes * 2**20,)])
    assert bad == ([(reason, mebibytes * 2**20 + 8)] if reason else [])


def test_mandatory_in_lists_rejects_the_document(spark):
    spec = SchemaSpec({
        "l": table("l", "list", col("index", "int4", is_mandatory=True), col("x", "int8", is_mandatory=True),
                   col("id", "int8", is_foreign=True, is_mandatory=True)),
        "d": table("", "dict", col("id", "int8")),
    })
    lines = [{"id": 1, "l": [{"x": 1}, {"x": None}, None]}, {"id": 2, "l": [{"x": 1}, {}]}, {"l": [{"x": 1}]}, {"l": []}]
    tables = extract_tables(docs(spark, *lines), spec)
    assert rows(tables["l"]) == [(0, 1, 1), (1, None, 1), (2, None, 1)]
    assert rows(tables["d"]) == [(1,), (None,)]
    assert [r.error_detail for r in error_rows(docs(spark, *lines), spec).collect()] == ["l: l: x", "l: id"]


def test_derived(spark):
    t = table("l", "list", {"name": "even", "sql_attr": "bool", "is_derived": True}, {"name": "__source_filename__", "sql_attr": "varchar(9)", "is_derived": True})
    even = {"even": lambda row: row.get("n", "bigint") % 2 == 0}
    assert rows(extract_table(docs(spark, {"n": 4, "l": [1]}), t, even)) == [(True, None)]
    with pytest.raises(SpecError, match="no function"):
        extract_table(docs(spark, {}), t)


def test_python_metric(spark):
    @F.pandas_udf("string")
    def backwards(texts):
        return texts.str[::-1]

    t = table("", "dict", {"name": "r", "sql_attr": "varchar(9)", "is_derived": True})
    assert rows(extract_table(docs(spark, {"s": "abc"}), t, {"r": lambda row: backwards(row.get("s"))})) == [("cba",)]


def test_truncation(spark):
    t = table("", "dict", col("a", "varchar(3)"), col("b", "char(2)"), col("n", "int8"))
    got = extract_table(docs(spark, {"a": "éééé", "b": "x"}, {"a": "abc", "b": "xyz"}, {"a": "abcd"}), t)
    assert rows(checks.truncation_report(got, t, "t")) == [("t", "a", 2), ("t", "b", 1)]
    assert [tuple(r)[:2] for r in checks.truncate_columns(got, t).collect()] == [("ééé", "x"), ("abc", "xy"), ("abc", None)]
    assert [tuple(r)[:2] for r in checks.truncate_columns(got, t, "bytes").collect()] == [("é", "x"), ("abc", "xy"), ("abc", None)]


def test_all_outputs_agree(spark, tmp_path):
    """Direct tables, the stage, the one-pass lines and written tables hold the same rows."""
    from logweir.plans.spec import parse_spec
    from logweir.sources.psv import from_psv

    spec = parse_spec(KILN_SPEC)
    lines = [
        {"kiln": {"id": i, "pots": [{"maker": f"m|{k}\\\n", "grams": k} for k in range(i % 3)],
                  "firing": {"peak": 900 + i / 2, "glaze": f"g|{i}", "opened": i, "notes": {"wood": i}, "readings": {str(9 * i): {"celsius": i + 0.25}}}}}
        for i in range(1, 8)
    ] + ["broken", {"kiln": {"pots": [{}], "firing": {}}}]
    frame = docs(spark, *lines).withColumn("file_path", F.lit("f"))
    direct = {**extract_tables(frame, spec), "pipeline_errors": error_rows(frame, spec)}
    staged = sinks.staged_tables(frame, spec)
    fanned = sinks.psv_fan_out(frame, spec)
    results = sinks.load_tables(frame, spec, str(tmp_path))
    assert [(r["table_name"], r["status"]) for r in results] == [(n, "success") for n in direct]
    for name, want in direct.items():
        want = want.drop("starttime")
        expected = sorted(rows(want), key=str)
        assert expected and sorted(rows(staged[name].select(want.columns)), key=str) == expected
        assert sorted(rows(spark.read.parquet(f"{tmp_path}/{name}").select(want.columns)), key=str) == expected
        if name in spec.tables:
            back = from_psv(fanned.where(F.col("table") == name).select(F.col("line").alias("value")), spec.tables[name])
            assert sorted(rows(back), key=str) == expected
    assert fanned.where("table = 'pipeline_errors'").count() == 2


def test_failed_table_ends_the_load(spark, tmp_path):
    bad = SchemaSpec({"a": table("", "dict", {"name": "x", "sql_attr": "int8", "is_derived": True}), "b": table("", "dict", col("y"))})
    stop = {"x": lambda row: F.raise_error(F.lit("boom")).cast("bigint")}
    results = sinks.load_tables(docs(spark, {"y": 1}), bad, str(tmp_path), stop, stage=False)
    assert [(r["table_name"], r["status"]) for r in results] == [("a", "error")]
    assert "boom" in results[0]["error_info"]


ODD_TABLES = """
version: 1
tables:
  trips:
    src: trip
    src_type: dict
    columns:
    - {log_key: nr, sql_attr: int8, is_mandatory: true}
    - {log_key: seats, sql_attr: int4}
    - {log_key: fare, sql_attr: float8}
    - {log_key: at, sql_attr: timestamp}
    - {log_key: Seats, name: other_seats, sql_attr: text}
    - {log_key: crew, name: crew_text, sql_attr: text, is_json: true}
    - {log_key: crew.lead, name: lead, sql_attr: text}
    - {log_key: nr, name: nr_text, sql_attr: text}
    sortkey_attr: []
  stops:
    src: trip.stops
    src_type: list
    columns:
    - {log_key: index, sql_attr: int4}
    - {log_key: place, sql_attr: text}
    - {log_key: km, sql_attr: float8}
    - {log_key: count, sql_attr: int2}
    - {log_key: trip.nr, name: nr, sql_attr: int8, is_foreign: true}
    sortkey_attr: []
  crew:
    src: trip.crew
    src_type: sparse_list
    columns:
    - {log_key: index, sql_attr: text}
    - {log_key: km, sql_attr: float8}
    - {log_key: trip.fare, name: fare, sql_attr: float8, is_foreign: true}
    sortkey_attr: []
"""
ODD_VALUES = ["7", "-0", "5.7", "1e3", "1.10", "0.1", "123456789012345678901234567890", "9223372036854775807", "3000000000", "-2.5e-7", "true", "null",
              '"12"', '" 12 "', '"5.7"', '"1d"', '"NaN"', '"x"', '""', "{}", '{"a":1}', "[]", "[1]"]


def test_fanned_values_are_those_of_each_table(spark):
    """Values read together from a document against values read one by one."""
    lines = [
        f'{{"trip":{{"nr":{v},"seats":{v},"Seats":{v},"fare":{v},"at":{v},'
        f'"stops":[{{"place":{v},"km":{v},"count":{v}}},{v}],"crew":{{"lead":{{"km":{v}}},"1":{v}}}}}}}' for v in ODD_VALUES
    ]
    lines += ['{"trip":{"nr":1,"nr":2,"stops":null}}', '{"trip":{"nr":3,"stops":{"place":"a"},"crew":[1]}}', '{"trip":null}', '{"trip":5}', "{}", "5", "null",
              '{"trip":{"seats":1}}', '{"trip":{"nr":4,"stops":[]}}', '{"trip":{"nr":5}}{"trip":{"nr":6}}', "{"]
    docs = parse_lines(spark.createDataFrame([(text,) for text in lines], "value string"))
    spec = parse_spec(ODD_TABLES)
    fanned = sinks.typed_fan_out(docs, spec)
    for name, rows in extract_tables(docs, spec).items():
        together = sorted(map(repr, fanned.where(F.col("table") == name).select(f"{name}.*").collect()))
        assert together == sorted(map(repr, rows.collect())) and together
    rejected = fanned.where("table = 'pipeline_errors'").select("pipeline_errors.raw_line")
    assert sorted(rejected.collect()) == sorted(error_rows(docs, spec).select("raw_line").collect())


def test_fanned_whole_numbers_are_those_of_each_table(spark):
    """What one table takes as a foreign key and another as its own, in equal and in different types."""
    values = ["12", "1.0", "2.00", "100.0", "1e2", "-0", "-0.0", "300", "40000", "3000000000", "9223372036854775808",
              '"12"', '" 12 "', '"1.0"', '"0x1"', "true", "null", "[12]", '{"a":12}']
    columns = ["{log_key: nr, name: nr8, sql_attr: int8}", "{log_key: nr, name: nr4, sql_attr: int4}",
               "{log_key: nr, name: seconds, sql_attr: TIMESTAMP}", "{log_key: nr, name: millis, sql_attr: timestamp}"]
    foreign = [c.replace("log_key: nr", "log_key: trip.nr").replace("}", ", is_foreign: true}") for c in columns]
    spec = parse_spec("\n".join([
        "version: 1", "tables:", "  trips:", "    src: trip", "    src_type: dict", "    columns:", *(f"    - {c}" for c in columns),
        "    sortkey_attr: []", "  stops:", "    src: trip.stops", "    src_type: list", "    columns:",
        "    - {log_key: index, sql_attr: int4}", *(f"    - {c}" for c in foreign), "    sortkey_attr: []",
    ]))
    docs = parse_lines(spark.createDataFrame([(f'{{"trip":{{"nr":{v},"stops":[{{}},{{}}]}}}}',) for v in values], "value string"))
    fanned = sinks.typed_fan_out(docs, spec)
    for name, rows in extract_tables(docs, spec).items():
        together = sorted(map(repr, fanned.where(F.col("table") == name).select(f"{name}.*").collect()))
        assert together == sorted(map(repr, rows.collect())) and len(together) >= len(values)
