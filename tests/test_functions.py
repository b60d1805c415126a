import math

import pytest
from pyspark.sql import functions as F

from lakeloom.functions import cast, nested, score, text


def apply(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression.alias("out")).collect()]


def test_numbers(spark):
    good = {"95.5": 95.5, " 12 ": 12.0, "1e3": 1000.0, "+5": 5.0, ".5": 0.5, "5.": 5.0, "inf": math.inf, "-7": -7.0}
    assert apply(spark, list(good), cast.lenient_double("c")) == list(good.values())
    bad = ["abc", "", "nan", "12d", "12f", "0x1A", "1_000", "1,000", "True", None]
    assert apply(spark, bad, cast.lenient_double("c")) == [None] * len(bad)
    assert apply(spark, bad, cast.lenient_double("c", 7.0)) == [7.0] * len(bad)


def test_whole_numbers_are_cut(spark):
    assert apply(spark, ["95.5", "-95.5", "1e3", "x", None], cast.lenient_int("c")) == [95, -95, 1000, 0, 0]


def test_ids(spark):
    values = ["1", "01", "1e3", "5.0", "x", None, "9007199254740993"]
    assert apply(spark, values, cast.lenient_id("c")) == [1, 1, 1000, 5, None, None, 9007199254740993]
    assert apply(spark, ["95.5", "inf"], cast.lenient_id("c", "null")) == [None, None]
    with pytest.raises(Exception, match="whole-number id"):
        apply(spark, ["95.5"], cast.lenient_id("c"))


def test_dates(spark):
    values = {"2020-01-31": "2020-01-31", "2020-1-5": "2020-01-05", "1999": None, "2020-02-30": None, "": None,
              "2020-01-31T00:00:00": None, "2020/01/31": None, " 2020-01-31": None}
    assert apply(spark, list(values), cast.iso_date("c")) == list(values.values())
    assert apply(spark, ["2020-1-5", "bad", None], cast.release_year("c")) == [2020, 0, 0]


@pytest.mark.parametrize("value, expected", [
    ('[{"name":"A"},{"name":"B"}]', "A, B"),
    ('[{"name":"A"},5]', "A"),
    ('[["a"],{"name":"Q"}]', "Q"),
    ('[{"name":null},{"name":""},{"name":"C"}]', "C"),
    ('[{"name":false},{"name":0},{"name":[]},{"name":"B"}]', "B"),
    ('[{"name":0.0},{"name":{}},{"name":"B"}]', "B"),
    ('[{"id":1},{"name":"R"}]', "R"),
    ('[{"name":5},{"name":"B"}]', ""),
    ('[{"name":true},{"name":"B"}]', ""),
    ('[{"name":{"x":1}}]', ""),
    ('[null,{"name":"Z"}]', "Z"),
    ('{"name":"A"}', ""),
    ("[]", ""),
    ("null", ""),
    ("bad", ""),
    ('[{"name":"A"}] xyz', ""),
    (' \n[{"name":"A","name":"B"}] ', "B"),
    ('[{"name":NaN},{"name":"A"}]', ""),
    ('[{"name":"A"},]', ""),
    ('[{"NAME":"A"},{"name":"z","x":{"name":"Z"}}]', "z"),
    ('[{"name":"A"}', ""),
    ("[{'name':'A'}]", ""),
    (None, ""),
])
def test_json_names(spark, value, expected):
    assert apply(spark, [value], nested.json_names("c")) == [expected]


def test_names_by_role_are_distinct_in_order(spark):
    crew = ('[{"name":"X","job":"Director"},{"name":"Z","job":"Editor"},{"name":"Y","job":"Director"},'
            '{"name":"X","job":"Director"}]')
    values = [crew, '[{"name":"X","job":["Director"]},{"name":"Y","job":"Director"}]',
              '[{"name":"X","job":5},{"name":"Y","job":"Director"}]', '[{"name":7,"job":"Director"}]', None]
    assert apply(spark, values, nested.json_names_by_role("c", ["Director"])) == ["X, Y", "", "Y", "", ""]
    assert apply(spark, [crew], nested.json_names("c")) == ["X, Z, Y, X"]


def test_lists(spark):
    values = [[1, 2, 3], [], None]
    assert apply(spark, values, nested.first_n("c", 2), "array<int>") == [[1, 2], [], []]


def test_space_of_any_kind(spark):
    assert apply(spark, ["  hi \t\x1c", "\n a  b \n"], text.strip("c")) == ["hi", "a  b"]
    assert apply(spark, [" A \n\t  b ", "", None], text.clean("c")) == ["a b", "", ""]
    assert apply(spark, ["a b\x1cc\td", "", None, "  "], text.word_count("c")) == [4, 0, 0, 0]


def test_lengths(spark):
    assert apply(spark, [" " + "x" * 20, "x" * 21, None], text.longer_than("c", 20)) == [False, True, False]


def test_language(spark):
    assert apply(spark, [" EN ", "cn", None, "ja"], text.language_code("c")) == ["en", "zh", "en", "ja"]


def test_terms(spark):
    words = text.terms("c", ["the", "of"])
    assert apply(spark, ["The Lord of the Rings, a X"], words) == [["lord", "rings", "lord rings"]]
    assert apply(spark, ["one", "", None], words) == [["one"], [], []]


def test_weighted_text(spark):
    rows = spark.createDataFrame([("a  b", "g", ""), (None, "", "d")], "x string, y string, z string")
    soup = text.weighted_text([("x", 1), ("y", 2), ("z", 3)])
    assert [r[0] for r in rows.select(soup).collect()] == ["a b g g", "d d d"]


def test_labels_and_scores(spark):
    assert apply(spark, [6.0, 5.99, 7.0], score.sentiment_label("c"), "double") == ["positive", "negative", "positive"]
    assert apply(spark, ["positive", "other", None], score.label_value("c")) == [1, 0, 0]
    assert apply(spark, [-5.0, 5.0, 50.0, None], score.unit_clip("c", 10.0), "double") == [0.0, 0.5, 1.0, 0.0]
    assert apply(spark, [0.125, 0.375], score.rounded("c", 2), "double") == [0.12, 0.38]
    rows = spark.range(1).select(score.blend(F.lit(0.5), F.lit(8.0), F.lit(250.0)).alias("b"))
    assert rows.first()[0] == pytest.approx(0.5 * 0.8 + 0.8 * 0.15 + 0.05)


def test_query_form(spark):
    assert apply(spark, ["1917", " 1917", "Up"], text.is_id_query("c")) == [True, False, False]
    assert apply(spark, [" The  UP "], text.title_key("c")) == ["the  up"]
