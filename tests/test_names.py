from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from formwork.functions.text import clean_name, clean_string, output_name, strip_string
from formwork.operators.columns import canonical_columns, clean_column_names, dedupe_names, sheet_sort

SAMPLES = [
    "Âge du chef",
    "age-du chef!",
    "  Nom de l'école  ",
    "Ça va? Œuvre ﬁnale",
    "São Paulo — état",
    "Ünïcödé_ñame 42",
    "tab\there\nnew line",
    " non-breaking　ideographic ",
    "Ελληνικά άλφα",
    "Кириллица й",
    "漢字 かな",
    "x̧́y",
    "",
    "!!!",
    "\x1c\x1dcontrol\x85",
    "한국어 이름 Été",
    "각 값-닭 😀 ÿ",
]


_UNDEFINED: set[str] = set()


def _jvm_undefined(spark) -> set[str]:
    """Characters below U+3001 that Python knows and the JVM does not (asked once)."""
    if not _UNDEFINED:
        jchar = spark.sparkContext._jvm.java.lang.Character
        _UNDEFINED.update(chr(cp) for cp in range(0x3001) if not jchar.isDefined(cp))
        _UNDEFINED.add("\uffff")  # sentinel so the set is never empty
    return _UNDEFINED


def test_clean_name_examples():
    assert clean_name("Âge du chef") == "age_du_chef"
    assert clean_name("age-du chef!") == "age-du_chef"
    assert clean_name("  Nom de l'école  ") == "nom_de_lecole"


def test_native_clean_string_matches_python(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "s string")
    got = [r.c for r in df.select(clean_string("s").alias("c")).collect()]
    assert got == [clean_name(s) for s in SAMPLES]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x3000, exclude_categories=("Cs",)), max_size=20), min_size=1, max_size=10))
def test_native_clean_string_property(spark, texts):
    # Code points the JVM's Unicode tables do not define yet are the documented gap.
    undefined = _jvm_undefined(spark)
    texts = ["".join(c for c in t if c not in undefined) for t in texts]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.c for r in df.select(clean_string("s").alias("c")).collect()]
    assert got == [clean_name(t) for t in texts]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(min_codepoint=0xAC00, max_codepoint=0xD7A3) | st.sampled_from(" -éa_"), max_size=12), min_size=1, max_size=8))
def test_native_clean_string_hangul(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.c for r in df.select(clean_string("s").alias("c")).collect()]
    assert got == [clean_name(t) for t in texts]


def test_clean_is_idempotent():
    for s in SAMPLES:
        assert clean_name(clean_name(s)) == clean_name(s)


def test_dedupe_names_suffixes_and_collisions():
    assert dedupe_names(["x", "x"]) == ["x_1", "x_2"]
    # D-1: the reference would give a_1, a_2, a_1; taken suffixes are skipped.
    out = dedupe_names(["a", "a", "a_1"])
    assert len(set(out)) == 3 and out[2] == "a_1"
    assert dedupe_names(["Âge du chef", "age du chef!", "b"]) == ["age_du_chef_1", "age_du_chef_2", "b"]


def test_clean_column_names_on_duplicate_frame(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("Nom", "NOM", "Clé")
    out = clean_column_names(df)
    assert out.columns == ["nom_1", "nom_2", "cle"]
    assert out.collect()[0].asDict() == {"nom_1": 1, "nom_2": 2, "cle": 3}


def test_canonical_and_sheet_sort(spark):
    df = spark.createDataFrame([(2, "b"), (1, "z"), (1, "a")], "z int, a string")
    assert canonical_columns(df).columns == ["a", "z"]
    rows = sheet_sort(df).collect()
    assert [tuple(r) for r in rows] == [("a", 1), ("z", 1), ("b", 2)]


def test_strip_string_unicode_whitespace(spark):
    df = spark.createDataFrame([(" \t x y 　\n",)], "s string")
    assert df.select(strip_string("s").alias("s")).first().s == "x y"


def test_output_name_rules():
    import datetime

    now = datetime.datetime(2024, 5, 6, 7, 8)
    assert output_name("Mon Formulaire!", ".csv", "out", now=now) == "out/mon_formulaire_2024-05-06_07-08.csv"
    assert output_name("x", ".parquet", "out", custom="sub/file.parquet") == "out/sub/file.parquet"
    assert output_name("x", ".parquet", "out", custom="/abs/file.parquet") == "/abs/file.parquet"
    assert output_name("x", ".csv", "out", custom="sub/file") == "out/sub/file.csv"
    assert output_name("Écoles", ".csv", "out", now=now, prefix="ou_") == "out/ou_ecoles_2024-05-06_07-08.csv"
    assert output_name("", ".csv", "out", now=now, prefix="orgunits") == "out/orgunits_2024-05-06_07-08.csv"
    import pytest

    with pytest.raises(ValueError):  # D-14
        output_name("x", ".parquet", "out", custom="file.csv")
    with pytest.raises(ValueError):
        output_name("x", ".xlsx", "out")


def test_no_python_udf_in_cleaning_plan(spark):
    df = spark.createDataFrame([("Été",)], "s string").select(clean_string(F.col("s")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan
