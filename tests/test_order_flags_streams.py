"""Numbers of ordered rows, flags of many categories, metadata looked up in the row."""

import random

from pyspark.sql import functions as F

from formwork.operators.columns import canonical_sort
from formwork.operators.forms import explode_choices, join_questions_choices, latest_document, latest_version, questions_from_map, questions_with_choices
from formwork.operators.onehot import category_dictionary, distinct_values, sparse_flags
from formwork.sources.readers import METADATA_SCHEMA


def test_positions_of_hot_and_null_values(spark):
    rng = random.Random(2)
    rows = [(None if i % 5 == 0 else rng.choice(["a", "b", "é", ""]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, i int").repartition(7)
    got = {r.i: r.position for r in canonical_sort(df, ["k", "i"], position="position").collect()}
    want = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1]))
    assert got == {i: n + 1 for n, (_, i) in enumerate(want)}
    assert canonical_sort(df.limit(0), ["k"], position="position").collect() == []
    plan = canonical_sort(df, ["k", "i"], position="position")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_sparse_flags_agree_with_flag_columns(spark):
    rows = [(1, ["x", "y", None], ["q"]), (2, [], None), (3, None, ["q", "q"]), (4, ["y"], ["r"]), (5, ["x"], ["q"]), (5, ["x"], ["q"])]
    df = spark.createDataFrame(rows, "i int, a array<string>, b array<string>")
    dictionary = category_dictionary(df)
    known = {r.flag: (r.column, r.value) for r in dictionary.collect()}
    values = distinct_values(df, ["a", "b"])
    assert [known[n] for n in range(len(known))] == [(c, v) for c in ("a", "b") for v in values[c]]
    got = [(r.i, [known[n] for n in r.flags]) for r in sparse_flags(df, dictionary).orderBy("i").collect()]
    assert got == [(1, [("a", "x"), ("a", "y"), ("b", "q")]), (2, []), (3, [("b", "q")]), (4, [("a", "y"), ("b", "r")]), (5, [("a", "x"), ("b", "q")]), (5, [("a", "x"), ("b", "q")])]
    assert sparse_flags(df.limit(0)).collect() == []
    assert sparse_flags(df, dictionary.where("value = 'q'")).where("i = 1").first().flags == [2]


def test_metadata_in_the_row_equals_the_joins(spark):
    def doc(form, version, n):
        return (form, version, {f"q{i}": (f"q{i}", "select_one", f"Q{i}", None) for i in range(n)}, {f"q{i}": [(f"c{j}", f"C{j}") for j in range(i)] for i in range(1, n)})

    docs = spark.createDataFrame([doc("a", "2", 3), doc("a", "10", 4), doc("b", "x", 2), doc("b", "y", 1), doc(None, "1", 1), ("c", "1", {}, None), ("d", "1", {"q": ("q", "text", "Q", None)}, None)], METADATA_SCHEMA)
    one, many = latest_document(docs), latest_version(docs)
    pick = lambda d: sorted((str(r.form_id), r.version, str(sorted((r.questions or {}).items()))) for r in d.collect())
    assert pick(one) == pick(many)
    joined = join_questions_choices(questions_from_map(many), explode_choices(many.where("form_id is not null")), ("form_id", "version", "name"))
    looked = questions_with_choices(one)
    assert looked.columns == joined.columns
    rows = lambda d: sorted((str(tuple(r)) for r in d.where(F.col("form_id").isNotNull()).collect()))
    assert rows(looked) == rows(joined)
    assert looked._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
