import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from formwork.functions.coerce import cast_expected, coerce_int, flatten_for_text, parse_dates
from formwork.functions.rules import calculate, check_constraint, formula_column, FormulaError
from formwork.operators.validate import (
    Rules,
    all_valid,
    check_table_schema,
    choice_membership,
    row_validity,
    select_rules,
    valid_rows,
    validate_rows,
    validate_rows_by_version,
    validate_structure,
)

Q_SCHEMA = "name string, type string, required string, calculation string, constraint string"


def test_check_constraint_cases(spark):
    df = spark.createDataFrame([("AB12", 5), ("xAB1", 130), (None, None), ("12", 120)], "code string, age int")
    t = {f.name: f.dataType for f in df.schema.fields}
    out = df.select(
        check_constraint("code", r"regex(., '[A-Z]{2}\d+')", t["code"]).alias("rx"),
        check_constraint("age", ".<=120", t["age"]).alias("le"),
        check_constraint("code", ".>=10", t["code"]).alias("ge_text"),
        check_constraint("age", ".<=abc", t["age"]).alias("bad"),
        check_constraint("age", "other(.)", t["age"]).alias("other"),
    ).collect()
    assert [tuple(r) for r in out] == [
        (True, True, False, False, True),  # regex matches at the start
        (False, False, False, False, True),  # 'xAB1' does not start with the pattern
        (False, False, False, False, False),  # null is false everywhere (D-6)
        (False, True, True, False, True),
    ]


def test_calculate_grammar(spark):
    df = spark.createDataFrame([(7.0, 2.0, None), (1.0, 0.0, 3.0)], "a double, b double, c double")
    cols = set(df.columns)
    out = df.select(
        calculate("round(${a} div ${b}, 0)", cols)[0].alias("r"),
        calculate("round(${a} div ${b})", cols)[0].alias("r2"),
        calculate("abs(${b} - ${a})", cols)[0].alias("ab"),
        calculate("coalesce(${c}, 0) + 1", cols)[0].alias("co"),  # nested parentheses (D-17)
        calculate("0", cols)[0].alias("zero"),
    ).collect()
    assert [tuple(r) for r in out] == [(4, 4, 5, 1, 0), (None, None, 1, 4, 0)]  # 7/2 = 3.5 rounds half up


def test_calculate_rejects_outside_grammar(spark):
    col, problem = calculate("__import__('os').system('x')", {"a"})
    assert problem is not None
    with pytest.raises(FormulaError):
        formula_column("${missing} + 1", {"a"})
    with pytest.raises(FormulaError):
        formula_column("${a} ^ 2", {"a"})


def test_choice_membership(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "v string")
    out = df.select(choice_membership(F.col("v"), ["a", "b"]).alias("m"), choice_membership(F.col("v"), []).alias("e")).collect()
    assert [tuple(r) for r in out] == [(True, False), (False, False), (False, False)]


def test_all_valid_balanced(spark):
    df = spark.createDataFrame([(True, True, False), (True, True, True)], "a boolean, b boolean, c boolean")
    assert [r.x for r in df.select(all_valid([F.col(c) for c in df.columns]).alias("x")).collect()] == [False, True]
    assert df.select(all_valid([]).alias("x")).first().x is True


def rules(spark, choices_cols=("list name", "label")):
    qs = spark.createDataFrame(
        [
            ("age", "integer", "yes", None, ".<=120"),
            ("code", "text", None, None, "regex(., '[A-Z]{2}')"),
            ("sex", "select_one sex", "yes", None, None),
            ("ratio", "calculate", None, "round(${age} div 10, 0)", ".>=2"),
            ("grp", "begin group", None, None, None),
        ],
        Q_SCHEMA,
    )
    cs = spark.createDataFrame([("sex", "M"), ("sex", "F")], f"`{choices_cols[0]}` string, `{choices_cols[1]}` string")
    return select_rules(qs, cs)


def test_select_rules_normalises_list_column(spark):
    r1, r2 = rules(spark), rules(spark, ("list_name", "label"))
    assert r1.choices == r2.choices == {"sex": ["M", "F"]}
    assert r1.group() == "grp" and r1.required() == {"age", "sex"}


def test_validate_rows_global(spark):
    df = spark.createDataFrame([(30, "AB", "M"), (130, "ab", "X"), (None, "CD", None)], "age bigint, code string, sex string")
    out = validate_rows(df, rules(spark))
    assert {"ratio", "constraints_validation_summary", "sex_choices_valid", "choices_validation_summary"} <= set(out.columns)
    assert "age_valid" not in out.columns
    rows = out.collect()
    assert [(r.ratio, r.constraints_validation_summary, r.choices_validation_summary) for r in rows] == [
        (3, True, True), (13, False, False), (None, False, False)]
    assert valid_rows(out, strict=True).count() == 1
    assert valid_rows(out, strict=False).count() == 3  # lenient keeps every row (D-23)


def test_validate_rows_without_list_column_skips_choices(spark):
    qs = spark.createDataFrame([("sex", "select_one sex", None, None, None)], Q_SCHEMA)
    r = select_rules(qs, spark.createDataFrame([("sex", "M")], "other string, label string"))
    out = validate_rows(spark.createDataFrame([("M",)], "sex string"), r)
    assert "choices_validation_summary" not in out.columns


def test_row_validity_combinations(spark):
    df = spark.createDataFrame([(True, None), (True, True)], "constraints_validation_summary boolean, choices_validation_summary boolean")
    assert [r.v for r in df.select(row_validity(df).alias("v")).collect()] == [False, True]
    only = df.select("constraints_validation_summary")
    assert [r.v for r in only.select(row_validity(only).alias("v")).collect()] == [True, True]
    none = df.select(F.lit(1).alias("x"))
    assert none.select(row_validity(none).alias("v")).first().v is True


def test_validate_by_version_ands_all_rules(spark):
    # D-4: an earlier failing constraint must not be erased by a later passing one.
    r1 = Rules([{"name": "a", "type": "integer", "constraint": ".<=5"}, {"name": "b", "type": "integer", "constraint": ".>=0"}])
    df = spark.createDataFrame([("1", 9, 1), ("1", 3, 1), ("2", 3, 1)], "form_version string, a bigint, b bigint")
    out = validate_rows_by_version(df, {"1": r1}).collect()
    assert [(r.row_valid, r.has_template) for r in out] == [(False, True), (True, True), (False, False)]


def test_validate_structure_findings(spark):
    df = spark.createDataFrame([("1", 3.5, "x")], "org_unit_id string, age double, extra string")
    ok, findings, invalid = validate_structure(spark, df, rules(spark), "CREATE")
    kinds = {(r.kind, r.column) for r in findings.collect()}
    assert not ok
    assert ("missing_column", "sex") in kinds and ("invalid_type", "org_unit_id") in kinds
    assert ("invalid_type", "age") in kinds and ("unexpected_column", "extra") in kinds
    assert invalid["age"] == ("Int64", "double")
    ok2, findings2, _ = validate_structure(spark, spark.createDataFrame([("1", 1, "M")], "id string, age bigint, sex string"), rules(spark), "DELETE")
    assert ok2 and {r.kind for r in findings2.collect()} <= {"unexpected_column"}
    with pytest.raises(ValueError):
        validate_structure(spark, df, rules(spark), "MERGE")


def test_cast_expected_and_parse_dates(spark):
    df = spark.createDataFrame([(3.7, "2024-01-02", "2024-01-02 03:04")], "age double, d string, t string")
    out = cast_expected(df, {"age": ("Int64", "double"), "created_at": ("Date or Datetime or String", "int")})
    assert isinstance(out.schema["age"].dataType, LongType)
    r = df.select(parse_dates("d", "date").alias("d"), parse_dates("t", "datetime").alias("t")).first()
    assert str(r.d) == "2024-01-02" and str(r.t) == "2024-01-02 03:04:00"
    bad = spark.createDataFrame([("02/01/2024",)], "d string")
    assert bad.select(parse_dates("d", "date", strict=False).alias("d")).first().d is None
    with pytest.raises(Exception):
        bad.select(parse_dates("d", "date")).collect()


def test_coerce_int_like_python_int(spark):
    df = spark.createDataFrame([(" 12 ",), ("12.7",), ("abc",), (None,), ("-3",)], "v string")
    assert [r.i for r in df.select(coerce_int("v", StringType()).alias("i")).collect()] == [12, None, None, None, -3]


def test_flatten_for_text(spark):
    df = spark.createDataFrame([(True, ["a"], {"k": 1})], "b boolean, l array<string>, m map<string,int>")
    r = flatten_for_text(df.withColumn("d", F.to_date(F.lit("2024-01-02")))).first()
    assert (r.b, r.l, r.m, r.d) == (1, '["a"]', '{"k":1}', "2024-01-02")


def test_check_table_schema(spark):
    spark.createDataFrame([(1, "a")], "x int, y string").createOrReplaceTempView("t_guard")
    check_table_schema(spark, spark.createDataFrame([("a", 1)], "y string, x int"), "t_guard")
    check_table_schema(spark, spark.createDataFrame([(1,)], "z int"), "does_not_exist")
    with pytest.raises(ValueError, match="new columns"):
        check_table_schema(spark, spark.createDataFrame([(1, "a", 2)], "x int, y string, z int"), "t_guard")


def test_choices_by_code_and_list_from_type(spark):  # D-7 options
    qs = spark.createDataFrame([("sex", "select_one genders", None, None, None)], Q_SCHEMA)
    cs = spark.createDataFrame([("genders", "m", "Male"), ("genders", "f", "Female")], "list_name string, name string, label string")
    df = spark.createDataFrame([("m",), ("Male",)], "sex string")
    by_code = validate_rows(df, select_rules(qs, cs, by="name", list_from_type=True)).collect()
    assert [r.sex_choices_valid for r in by_code] == [True, False]
    default = validate_rows(df, select_rules(qs, cs)).collect()  # list named like the question: none -> false
    assert [r.sex_choices_valid for r in default] == [False, False]


def test_numeric_ids_accepted(spark):  # D-24
    r = Rules([])
    ok, _, invalid = validate_structure(spark, spark.createDataFrame([(5,)], "id bigint"), r, "DELETE")
    assert ok and not invalid


def test_round_half_up_matches_spark_round(spark):
    from formwork.functions.rules import round_half_up

    vals = [0.5, 1.5, 2.5, -0.5, -2.5, 0.49999999999999994, 2.4999999999999996, 1e15 + 0.5, 1e300, -0.0, 3.7, -3.7]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    rows = df.select(F.round("x", 0).alias("a"), round_half_up(F.col("x")).alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_chained_calculates_and_rejected_formulas(spark):
    from formwork.operators.validate import rejected_formulas, rules_from_rows, validate_rows, validate_rows_by_version, validate_structure

    questions = [{"name": "x", "type": "integer"}, {"name": "a", "type": "calculate", "calculation": "${x} + 1"},
                 {"name": "b", "type": "calculate", "calculation": "${a} * 2"}, {"name": "c", "type": "calculate", "calculation": "if(${x})"}]
    rules = rules_from_rows(questions)
    df = spark.createDataFrame([("5", "1"), ("nan", "1"), ("inf", "1"), ("3", "2")], "x string, form_version string")
    got = [(r.x, r.a, r.b, r.c) for r in validate_rows(df, rules).collect()]
    assert got == [("5", 6, 12, 0), ("nan", None, None, 0), ("inf", None, None, 0), ("3", 4, 8, 0)]
    assert [c for c, _ in rejected_formulas(df, rules)] == ["c"]
    assert [r.column for r in validate_structure(spark, df, rules, "CREATE")[1].collect() if r.kind == "rejected_formula"] == ["c"]
    other = rules_from_rows([questions[0], {"name": "b", "type": "calculate", "calculation": "${x} * 10"}])
    by = {r.x: (r.a, r.b) for r in validate_rows_by_version(df, {"1": rules, "2": other}).collect()}
    assert by["5"] == (6, 12) and by["3"] == (None, 30)


def test_numbers_and_patterns_follow_the_rule_language(spark):
    from formwork.functions.rules import check_constraint

    df = spark.createDataFrame([("12d",), ("12",), ("5",)], "v string")
    rules = [".<=40", "regex(., '[a-')", "regex(., '(?P<n_1>5)')"]
    got = [tuple(r) for r in df.select(*[check_constraint("v", rule).alias(f"c{i}") for i, rule in enumerate(rules)]).collect()]
    assert got == [(False, False, False), (True, False, False), (True, False, True)]


def test_patterns_agree_with_the_rule_language(spark):
    """Every value and pattern gives what ``re.match`` gives."""
    import re

    from formwork.functions.rules import check_constraint

    values = ["", "a", "Hélène", "a b", "٣", "²", "x\n", "x\n\n", "x\r", "x\u2028", "_", "a-b", "[", "]", "a&b", "{2}", "aa", "\x1f", "\xa0", "\x85", "ß", "STRASSE", "a{b", "café9"]
    patterns = [r"^\w+$", r"\d$", r"[\w-]+$", r"[^\w]", r"\W", r"[\W_]$", r"\s$", r"[\s]", r"\S+$", r".$", r"x$", r"x\Z", r"[[]", r"[]]", r"[a&&b]+$", r"a{,2}$", r"a{b", r"\{2\}", r"{2}", r"(?P<q_1>a)(?P=q_1)$", r"(?i)h", r"[^\d\s]+$", r"(unclosed", r"\bcaf", r"(?m)^b", r"[\]x]"]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    got = frame.select("v", *[check_constraint("v", f"regex(., '{p}')").alias(f"p{i}") for i, p in enumerate(patterns)]).collect()
    for r in got:
        for i, p in enumerate(patterns):
            try:
                want = re.match(p, r.v) is not None
            except re.error:
                want = False
            assert r[f"p{i}"] == want, (p, r.v)


def test_nan_passes_no_bound(spark):
    from formwork.functions.rules import check_constraint

    rows = spark.createDataFrame([(float("nan"), "nan"), (7.0, "7"), (None, None), (float("inf"), "inf")], "d double, t string")
    types = {f.name: f.dataType for f in rows.schema.fields}
    for c in ("d", "t"):
        got = rows.select(check_constraint(c, ".>=5", types[c]), check_constraint(c, ".<=5", types[c])).collect()
        assert [tuple(r) for r in got][:3] == [(False, False), (True, False), (False, False)]
        assert tuple(got[3]) == (True, False)


def test_plan_does_not_grow_with_versions(spark):
    """500 versions of a form: same rows as one check per version, same plan size as two."""
    from formwork.operators.validate import rules_from_rows

    def book(n):
        return {str(v): rules_from_rows(
            [{"name": "x", "type": "integer", "constraint": f".<={v}"}, {"name": "t", "type": "text", "constraint": f"regex(., 'a{v}$')"},
             {"name": "c", "type": "select_one c"}, {"name": "k", "type": "calculate", "calculation": "${x} + 1" if v % 2 else "${x} * 2"}], [("c", f"c{v}"), ("c", None)]) for v in range(n)}

    rows = [(str(v), x, f"a{v if x % 3 else v + 1}", f"c{v}" if x % 5 else "c") for v in (0, 7, 250, 499, 500) for x in range(0, 600, 37)] + [(None, 1, "a1", "c1")]
    df = spark.createDataFrame(rows, "form_version string, x bigint, t string, c string")
    out = validate_rows_by_version(df, book(500))
    for r in out.collect():
        known = r.form_version is not None and int(r.form_version) < 500
        v = int(r.form_version) if known else None
        assert r.has_template == known
        assert r.row_valid == (known and r.x <= v and r.t == f"a{v}" and r.c == f"c{v}")
        assert r.k == (None if not known else r.x + 1 if v % 2 else r.x * 2)
    size = lambda d: len(d._jdf.queryExecution().analyzed().toString())
    assert size(out) < 1.2 * size(validate_rows_by_version(df, book(2)))


def test_check_table_schema_compares_types(spark):
    spark.createDataFrame([(1, "a", 2.0)], "x bigint, y string, z double").createOrReplaceTempView("t_types")
    check_table_schema(spark, spark.createDataFrame([(1, 2.5)], "x int, z float"), "t_types")
    for schema, row in (("x string", ("1",)), ("x double", (1.0,)), ("y int", (1,)), ("z bigint", (1,))):
        with pytest.raises(ValueError, match="there"):
            check_table_schema(spark, spark.createDataFrame([row], schema), "t_types")
