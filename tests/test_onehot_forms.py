import pytest
from pyspark.sql import functions as F

from formwork.operators.forms import (
    explode_choices,
    first_available,
    join_questions_choices,
    latest_version,
    questions_from_map,
    replace_labels,
)
from formwork.operators.onehot import distinct_values, flatten_submissions, one_hot_lists
from formwork.sources.readers import METADATA_SCHEMA

SUBS_SCHEMA = "instanceid string, age int, tags array<string>"


def subs(spark):
    rows = [
        ("i1", 30, ["a", "école"]),
        ("i2", 20, None),
        ("i3", 25, []),
        ("i4", 40, [None, "b"]),
    ]
    return spark.createDataFrame(rows, SUBS_SCHEMA)


def test_distinct_values_drops_nulls(spark):
    assert distinct_values(subs(spark), ["tags"]) == {"tags": ["a", "b", "école"]}


def test_one_hot_flags(spark):
    out = flatten_submissions(subs(spark))
    assert out.columns == ["age", "instanceid", "tags_a", "tags_b", "tags_ecole"]
    got = {r.instanceid: (r.tags_a, r.tags_b, r.tags_ecole) for r in out.collect()}
    assert got == {"i1": (1, 0, 1), "i2": (0, 0, 0), "i3": (0, 0, 0), "i4": (0, 1, 0)}
    assert dict(out.dtypes)["tags_a"] == "tinyint"
    # O1: sorted by the pre-sort column order (age first)
    assert [r.instanceid for r in out.collect()] == ["i2", "i3", "i1", "i4"]


def test_one_hot_collision_raises(spark):  # D-2
    df = spark.createDataFrame([("i", ["É", "e"])], "instanceid string, t array<string>")
    with pytest.raises(ValueError, match="collides"):
        one_hot_lists(df)


def test_one_hot_has_no_category_cap(spark):
    df = spark.createDataFrame([("i", [str(x) for x in range(1200)])], "instanceid string, t array<string>")
    assert len(one_hot_lists(df).columns) == 1202


def test_one_hot_given_categories_cover_every_value(spark):
    df = spark.createDataFrame([("i", ["a", "z", None]), ("j", ["b"])], "instanceid string, t array<string>")
    assert one_hot_lists(df, categories={"t": ["a", "b", "z"]}).columns == ["instanceid", "t", "t_a", "t_b", "t_z"]
    with pytest.raises(Exception, match="outside its categories"):
        one_hot_lists(df, categories={"t": ["a", "b"]}).collect()
    with pytest.raises(ValueError, match="no categories given"):
        one_hot_lists(df, categories={"u": ["a"]})


def test_instanceid_required(spark):
    df = spark.createDataFrame([(1, ["a"])], "x int, t array<string>")
    with pytest.raises(ValueError):
        flatten_submissions(df)


def test_latest_version_integer_and_fallback(spark):
    rows = [("f1", "1", "a"), ("f1", "3", "b"), ("f1", "2", "c"), ("f1", "draft", "d"),
            ("f2", "beta", "e"), ("f2", "alpha", "f")]
    df = spark.createDataFrame(rows, "form_id string, version string, v string")
    got = {(r.form_id, r.v) for r in latest_version(df).collect()}
    # f1: highest integer version; f2: no integer version -> first entry by text order
    assert got == {("f1", "b"), ("f2", "f")}


def test_first_available(spark):
    df = spark.createDataFrame([("f", 1, ""), ("f", 2, "u2"), ("f", 3, "u3"), ("g", 1, None)], "k string, pos int, url string")
    got = {r.k: r.u for r in df.groupBy("k").agg(first_available(F.col("url"), F.col("pos")).alias("u")).collect()}
    assert got == {"f": "u2", "g": None}


def test_metadata_documents_to_sheet(spark, tmp_dir):
    doc = (
        '{"form_id": "7", "version": "2", "questions": {"q1": {"name": "q1", "type": "select_one q1", "label": "B", "calculate": null},'
        ' "q2": {"name": "q2", "type": "text", "label": "A", "calculate": null}},'
        ' "choices": {"q1": [{"name": "1", "label": "Oui"}, {"name": "0", "label": "Non"}]}}'
    )
    path = f"{tmp_dir}/meta.json"
    with open(path, "w") as fh:
        fh.write(doc + "\n")
    meta = spark.read.schema(METADATA_SCHEMA).json(path)
    qs, cs = questions_from_map(meta), explode_choices(meta)
    out = join_questions_choices(qs, cs, ("form_id", "version", "name")).collect()
    assert sorted((r.name, r.choice_value) for r in out) == [("q1", "0"), ("q1", "1"), ("q2", None)]


def test_replace_labels_single_and_multi(spark):
    df = spark.createDataFrame([("1", ["1", "9"]), ("9", None), (None, ["0"])], "s string, m array<string>")
    choices = spark.createDataFrame(
        [("s", "1", "Oui", "French"), ("s", "1", "Yes", "English"), ("m", "1", "Oui", "French"), ("m", "0", "Non", "French")],
        "name string, choice_value string, choice_label string, language string",
    )
    got = [tuple(r) for r in replace_labels(df, choices, ["s", "m"]).collect()]
    assert got == [("Oui", ["Oui", "9"]), ("9", None), (None, ["Non"])]
    en = replace_labels(df, choices, ["s"], language="English").collect()
    assert en[0].s == "Yes"


def test_replace_labels_join_path(spark):
    df = spark.createDataFrame([("1",), ("2",), ("3",)], "s string")
    choices = spark.createDataFrame([("s", "1", "one", "French"), ("s", "2", "two", "French")],
                                    "name string, choice_value string, choice_label string, language string")
    got = sorted(r.s for r in replace_labels(df, choices, ["s"], max_literal=1).collect())
    assert got == ["3", "one", "two"]


def test_replace_labels_is_the_same_by_either_plan(spark):
    df = spark.createDataFrame([("1", 7, ["1", None, "9", "2"]), ("4", None, []), (None, 8, None), ("2", 7, ["2", "2"])], "s string, n int, m array<string>")
    choices = spark.createDataFrame([("s", "1", "z"), ("s", "1", "a"), ("s", "2", "two"), ("m", "2", "deux"), ("m", "1", "un"), ("x", "1", "no")], "name string, choice_value string, choice_label string")
    one, other = (replace_labels(df, choices, max_literal=n) for n in (100, 0))
    assert one.dtypes == other.dtypes == [("s", "string"), ("n", "int"), ("m", "array<string>")]
    want = sorted([("a", 7, ["un", None, "9", "deux"]), ("4", None, []), (None, 8, None), ("two", 7, ["deux", "deux"])], key=str)
    assert sorted(map(tuple, one.collect()), key=str) == want == sorted(map(tuple, other.collect()), key=str)


def test_join_questions_choices_with_a_hot_list(spark):
    qs = spark.range(200).selectExpr("concat('q', id) AS name", "'select_one' AS type")
    hot = spark.range(5000).selectExpr("'q0' AS name", "CAST(id AS STRING) AS choice_value", "'L' AS choice_label")
    cold = spark.range(1, 100).selectExpr("concat('q', id) AS name", "'1' AS choice_value", "'one' AS choice_label")
    out = join_questions_choices(qs, hot.unionByName(cold))
    assert out.count() == 5000 + 99 + 100  # hot list, one choice each for q1..q99, q100..q199 without choices
    assert out.where("choice_value IS NULL").count() == 100
    assert out.columns == ["name", "type", "choice_value", "choice_label"]


def test_latest_version_with_a_hot_form(spark):
    # One form holds a third of all rows; the per-form choice still picks its own max.
    hot = spark.range(30000).selectExpr("'big' AS form_id", "CAST(id % 7 AS STRING) AS version", "id AS v")
    rest = spark.range(60000).selectExpr("CAST(id % 500 AS STRING) AS form_id", "CAST(id % 3 AS STRING) AS version", "id AS v")
    out = latest_version(hot.unionByName(rest))
    assert out.where("form_id = 'big'").count() == len([i for i in range(30000) if i % 7 == 6])
    assert out.where("form_id <> 'big'").selectExpr("min(version)").first()[0] == "2"
