"""Delimited text: escapes, round trips, typed loading."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from logweir.plans.spec import TableSpec
from logweir.sources import psv


def table(*columns):
    return TableSpec.from_dict({"src": "", "src_type": "dict", "columns": [{"log_key": n, "sql_attr": a} for n, a in columns], "sortkey_attr": []})


@pytest.mark.parametrize("plain, escaped", [
    ("\n", "\\n"), ("\r", "\\r"), ("|", "\\|"), ("\\", "\\\\"), ("\\\n", "\\\\\\n"), ("\x1e", "\x1e"), ("a|b\\|", "a\\|b\\\\\\|"),
])
def test_escape(spark, plain, escaped):
    frame = spark.createDataFrame([(plain,)], "t string")
    line = psv.escape_text(F.col("t"))
    assert tuple(frame.select(line, psv.unescape_text(line)).first()) == (escaped, plain)


def test_rows(spark):
    frame = spark.createDataFrame([(None, "dune", 42, True)], "remark string, place string, depth int, wet boolean")
    assert psv.to_psv(frame).first()[0] == "42|dune||true"
    assert psv.to_psv(frame, ["wet", "remark", "place"]).first()[0] == "true||dune"
    assert psv.to_psv(frame, ["place", "depth"], "\x1e").first()[0] == "dune\x1e42"
    with pytest.raises(KeyError):
        psv.to_psv(frame, ["zz"])
    with pytest.raises(ValueError, match="record separator"):
        psv.to_psv(frame, delimiter=",")


text = st.text(st.sampled_from(list("ab\\|\n\r\x1en é")) | st.characters(codec="utf-8", exclude_characters="\x00"), max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(text, text, text), min_size=1, max_size=30), st.sampled_from(["|", "\x1e"]))
def test_round_trip(spark, values, delimiter):
    frame = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, a string, b string, c string")
    attrs = (("i", "int4"), ("a", "text"), ("b", "text"), ("c", "text"))
    back = psv.from_psv(psv.to_psv(frame, [n for n, _ in attrs], delimiter), table(*attrs), delimiter)
    assert sorted(map(tuple, back.collect())) == [(i, *v) for i, v in enumerate(values)]


@pytest.mark.parametrize("body", ["\\|" * 200_000, "x" * 2_000_000 + "\\", "|\n" * 300_000])
def test_long_fields(spark, body):
    frame = spark.createDataFrame([(body, "end")], "a string, b string")
    back = psv.from_psv(psv.to_psv(frame, ["a", "b"]), table(("a", "text"), ("b", "text")))
    assert tuple(back.first()) == (body, "end")


def test_typed_load(spark):
    lines = spark.createDataFrame([("5|é\\|éé|1500|true|2.5|x",), ("x||||\x00|",)], "value string")
    t = table(("i", "int2"), ("s", "varchar(3)"), ("t", "TIMESTAMP"), ("b", "bool"), ("f", "float8"), ("z", "varchar(9)"))
    whole = psv.from_psv(lines, t).first()
    assert whole.s == "é|éé"
    got = [tuple(r) for r in psv.from_psv(lines, t, truncate="characters").withColumn("t", F.unix_millis("t")).collect()]
    assert got == [(5, "é|é", 1500, True, 2.5, "x"), (None, "", None, None, None, "")]


def test_noop_columns_are_not_in_the_file(spark):
    t = TableSpec.from_dict({"src": "", "src_type": "dict", "sortkey_attr": [], "columns": [
        {"log_key": "a", "sql_attr": "int8"}, {"name": "hole", "sql_attr": "int8", "is_noop": True}, {"log_key": "b", "sql_attr": "int8"}]})
    assert tuple(psv.from_psv(spark.createDataFrame([("1|2",)], "value string"), t).first()) == (1, None, 2)


def test_wrong_field_count(spark):
    lines = spark.createDataFrame([("1|2|3",), ("1",)], "value string")
    t = table(("a", "int8"), ("b", "int8"))
    with pytest.raises(PySparkException, match="expected 2 fields"):
        psv.from_psv(lines, t).collect()
    assert [tuple(r) for r in psv.from_psv(lines, t, strict=False).collect()] == [(1, 2), (1, None)]


@pytest.mark.parametrize("width", [1, 2, 3, 4, 5, 6, 7])
def test_byte_truncation_against_brute_force(spark, width):
    words = ["aé€😀b", "😀😀", "ééé", "abc", "", "€", "a😀"]
    frame = spark.createDataFrame([(w,) for w in words], "t string")
    got = [r[0] for r in frame.select(psv.truncate_text(F.col("t"), width, "bytes")).collect()]
    assert got == [w.encode()[:width].decode("utf-8", "ignore") for w in words]
