import pytest
from log_help import plan, rows

from visitmill.operators.keyvalue import bad_objects, key_value_record, key_values
from visitmill.schema import REPORT_FIELDS
from visitmill.sources.logs import read_json_objects

TEXT = ('{"report":[{"key":"data_type","value":"t1"},{"key":"source_name","value":"s1"},'
        '{"key":"source_name","value":"s2"},{"key":"version","value":1.5}],'
        '"user_basic":[{"key":"name","value":"n1"}],"other":7}')


def test_pairs_in_order(spark):
    frame = spark.createDataFrame([(1, TEXT), (2, '{"report":[]}'), (3, "{}")], "id int, json string")
    assert rows(key_values(frame, "json", "report")) == [
        (1, 0, "data_type", "t1"), (1, 1, "source_name", "s1"), (1, 2, "source_name", "s2"),
        (1, 3, "version", "1.5")]
    assert rows(key_values(frame, "json", "user_basic")) == [(1, 0, "name", "n1")]


def test_record(spark):
    frame = spark.createDataFrame([(1, TEXT), (2, "{}")], "id int, json string")
    got = key_value_record(frame, "json", "report")
    assert tuple(got.columns) == ("id", *REPORT_FIELDS)
    by_id = {r.id: r for r in got.collect()}
    assert (by_id[1].data_type, by_id[1].source_name, by_id[1].version) == ("t1", "s2", "1.5")
    assert by_id[1].task_id is None and by_id[2].data_type is None


def test_file_of_objects(spark, tmp_path):
    (tmp_path / "a.json").write_text(TEXT + "\n" + TEXT + "\n")
    frame = read_json_objects(spark, str(tmp_path / "a.json"))
    assert key_values(frame, "json", "report").count() == 8


def test_bad_objects_fail_or_are_found(spark):
    texts = ['{"report":[{"key":"a","value":"1"}]}', '{"report":5}', '{"rep', "{}", None, '{"report":null}']
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, json string")
    assert [r["i"] for r in bad_objects(frame, "json", "report").orderBy("i").collect()] == [1, 2]
    for function in (key_values, key_value_record):
        with pytest.raises(Exception, match="no pairs in section"):
            function(frame, "json", "report").collect()
    assert key_values(frame, "json", "report", on_bad_json="drop").count() == 1
    assert key_value_record(frame, "json", "report", on_bad_json="drop").count() == 6


def test_values_of_other_types_and_odd_sections(spark):
    texts = ['{"a b\'c":[{"key":"k","value":"v"}]}', '{"a b\'c":[{"value":1,"key":"n"},{"key":"m"},{"key":"t","value":true},null]}',
             '{"a b\'c":[{"key":"o","value":{"x":[1,2]}}]}', '[1,2]', '"text"', '{"a b\'c":[5]}', '{"a b\'c":{"key":"k"}}', ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, json string")
    got = rows(key_values(frame, "json", "a b'c", on_bad_json="drop"))
    assert got[:5] == [(0, 0, "k", "v"), (1, 0, "n", "1"), (1, 1, "m", None), (1, 2, "t", "true"), (1, 3, None, None)]
    assert got[5][:3] == (2, 0, "o") and got[5][3].replace(" ", "") == '{"x":[1,2]}'
    bad = bad_objects(frame, "json", "a b'c")
    assert bad.columns == ["i", "json"]
    assert [r.i for r in bad.orderBy("i").collect()] == [5, 6, 7]


def test_one_parse_a_row(spark):
    frame = spark.createDataFrame([(1, TEXT)], "id int, json string")
    for found in (key_values(frame, "json", "report"), key_value_record(frame, "json", "report"),
                  bad_objects(frame, "json", "report")):
        text = plan(found)
        parses = [line for line in text.split("\n") if "parseJson" in line or "parse_json" in line]
        assert len(parses) == 1, text
        assert "from_json" not in text and "get_json_object" not in text
