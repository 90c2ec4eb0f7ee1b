import json
import xml.etree.ElementTree as ET

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from formwork.functions.documents import instance_uuid
from formwork.operators.importer import (
    combine_outcomes,
    create_outbox,
    delete_outbox,
    outcome_summary,
    route_import,
    split_create_update,
    update_outbox,
)
from formwork.operators.validate import Rules

RULES = Rules(
    [
        {"name": "grp", "type": "begin group"},
        {"name": "field_a", "type": "text", "constraint": "regex(., 'value')"},
        {"name": "field_b", "type": "text"},
    ],
    {},
    True,
)


def creates(spark):
    return spark.createDataFrame(
        [(123, 4.4, 4.5, "valueA1", "valueB1"), (456, 6.0, 6.2, "valueA2", None), (None, 1.0, 1.0, "valueA3", "x"), (789, 0.0, 0.0, "bad", "y")],
        "org_unit_id bigint, latitude double, longitude double, field_a string, field_b string",
    )


def test_create_outbox_document_and_payload(spark):
    out = create_outbox(creates(spark), RULES, 9, latest_version_id="5", created_at=1000, directory="d", key_cols=["field_a"], keep=["field_a"])
    rows = {r.field_a: r for r in out.collect()}
    assert (rows["valueA3"].outcome, rows["valueA3"].reason) == ("ignored", "bad_org_unit")
    assert (rows["bad"].outcome, rows["bad"].reason) == ("ignored", "invalid")
    r = rows["valueA2"]
    assert r.outcome == "imported"
    expected = "\n".join([
        '<data xmlns:jr="http://openrosa.org/javarosa" xmlns:orx="http://openrosa.org/xforms"',
        '      id="9" version="5">',
        "    <grp>",
        "        <field_a>valueA2</field_a>",
        "        <field_b></field_b>",
        "    </grp>",
        "    <meta>",
        f"        <instanceID>uuid:{r.instance_uuid}</instanceID>",
        "    </meta>",
        "</data>",
    ])
    assert r.document == expected
    body = json.loads(r.payload)
    assert list(body) == ["id", "orgUnitId", "created_at", "formId", "accuracy", "altitude", "latitude", "longitude", "file", "name"]
    assert body["orgUnitId"] == 456 and body["accuracy"] == 0 and body["latitude"] == 6.0 and body["name"] == f"{r.instance_uuid}.xml"


def test_instance_uuid_is_deterministic(spark):
    df = spark.createDataFrame([("k",)], "k string")
    a = df.select(instance_uuid(F.col("k"))).first()[0]
    b = df.repartition(3).select(instance_uuid(F.col("k"))).first()[0]
    assert a == b and len(a) == 36 and a.count("-") == 4


def test_values_are_escaped(spark):  # D-11
    df = spark.createDataFrame([(1, "a<b & c>d", "x")], "org_unit_id bigint, field_a string, field_b string")
    rules = Rules([{"name": "field_a", "type": "text"}, {"name": "field_b", "type": "text"}])
    doc = create_outbox(df, rules, 1).first().document
    assert "<field_a>a&lt;b &amp; c&gt;d</field_a>" in doc
    ET.fromstring(doc)  # well-formed


def updates(spark):
    return spark.createDataFrame(
        [("987", "uuid:473957", 123, "valueA", ""), ("988", None, 1, "valueB", "x"), ("989", "uuid:1", 0, "valueC", "y"),
         ("abc", "uuid:2", 5, "valueD", "z")],
        "id string, instanceID string, org_unit_id bigint, field_a string, field_b string",
    )


def test_update_outbox(spark):
    locks = spark.createDataFrame([(989, True), (987, False)], "id bigint, is_locked boolean")
    out = update_outbox(updates(spark), RULES, 9, instances=locks, editor=7, latest_version_id="5", keep=["id"], instance_attribute="instance")
    rows = {r.id: r for r in out.collect()}
    assert rows["988"].reason == "missing_instance_id"
    assert rows["989"].reason == "locked" and rows["989"].patch_org_unit is False  # D-9: no patch for locked rows
    assert rows["abc"].reason == "bad_id"
    r = rows["987"]
    assert r.outcome == "updated" and r.patch_org_unit is True
    assert json.loads(r.payload) == {"org_unit": "123", "formID": 9, "accuracy": 0, "altitude": 0, "latitude": None, "longitude": None}
    assert r.document == """<?xml version="1.0" encoding="utf-8"?>
<data xmlns:jr="http://openrosa.org/javarosa" xmlns:orx="http://openrosa.org/xforms" id="9" version="5" instance="987">
    <grp>
        <field_a>valueA</field_a>
        <field_b />
    </grp>
    <meta>
        <instanceID>uuid:473957</instanceID>
    <editUserID>7</editUserID></meta>
</data>"""


def test_update_requires_columns(spark):
    with pytest.raises(RuntimeError):
        update_outbox(spark.createDataFrame([("1",)], "id string"), RULES, 1)


def test_delete_outbox(spark):
    df = spark.createDataFrame([(None,), (" 12 ",), ("12.7",), ("abc",), ("5",)], "id string")
    got = [(r.outcome, r.reason, r.instance_id) for r in delete_outbox(df).collect()]
    assert got == [("ignored", "missing_id", None), ("deleted", None, 12), ("ignored", "bad_id", None),
                   ("ignored", "bad_id", None), ("deleted", None, 5)]


def test_route_and_counts_cover_every_row(spark):
    df = spark.createDataFrame(
        [(None, None, 1, "value1", "b"), ("10", "uuid:x", 2, "value2", "b"), (None, None, None, "value3", "b"), ("11", "uuid:y", None, "bad", "b")],
        "id string, instanceID string, org_unit_id bigint, field_a string, field_b string",
    )
    c, u, n = split_create_update(df)
    assert (c.count(), u.count(), n.count()) == (1, 2, 1)  # D-10: unrouted is reported
    out = route_import(df, "CREATE_AND_UPDATE", RULES, 3, created_at=1)
    s = outcome_summary(out).first().asDict()
    assert s == {"imported": 1, "updated": 1, "ignored": 1, "deleted": 0, "unrouted": 1}
    assert sum(s.values()) == df.count()
    both = combine_outcomes(create_outbox(c, RULES, 3, created_at=1), update_outbox(u, RULES, 3))
    assert outcome_summary(both).first().asDict() == {"imported": 1, "updated": 1, "ignored": 1, "deleted": 0, "unrouted": 0}


def test_route_per_version_templates(spark):
    rules = {"1": Rules([{"name": "field_a", "type": "text"}]), "2": Rules([{"name": "field_b", "type": "text"}])}
    df = spark.createDataFrame([(1, "1", "a", "b"), (2, "2", "a", "b"), (3, "9", "a", "b")], "org_unit_id bigint, form_version string, field_a string, field_b string")
    rows = create_outbox(df, None, 4, rules_by_version=rules, keep=["org_unit_id"]).orderBy("org_unit_id").collect()
    assert "<field_a>a</field_a>" in rows[0].document and "field_b" not in rows[0].document
    assert 'version="2"' in rows[1].document and "<field_b>b</field_b>" in rows[1].document
    assert (rows[2].outcome, rows[2].reason) == ("ignored", "no_template")


def test_rows_without_id_spread_and_never_match_locks(spark):
    from formwork.operators.lookup import NULL_KEY_BUCKETS

    # A lock row whose id equals a possible bucket number must not lock id-less rows.
    locks = spark.createDataFrame([(b, True) for b in range(NULL_KEY_BUCKETS)], "id bigint, is_locked boolean")
    df = spark.createDataFrame([(None, None, i, "value", "b") for i in range(50)] + [("7", "uuid:z", 1, "value", "b")],
                               "id string, instanceID string, org_unit_id bigint, field_a string, field_b string")
    out = route_import(df, "CREATE_AND_UPDATE", RULES, 3, instances=locks, created_at=1)
    s = outcome_summary(out).first().asDict()
    assert s["imported"] == 50 and s["ignored"] == 1  # id 7 is locked; no create row is
    assert out.count() == 51


DECIMAL_LIKE = st.builds(lambda m, e: m * 10.0 ** e, st.integers(-(10**12), 10**12), st.integers(-20, 20))
EDGES = st.sampled_from([1e7, 12345678.5, 1e15, 1e16, 1.5e-5, 5.5e-4, 1e-4, 0.001, 123.0, -2.5e-7, 1e300, 1e100,
                         float("nan"), float("inf"), float("-inf"), -0.0])


@settings(max_examples=20, deadline=None)
@given(st.lists(DECIMAL_LIKE | EDGES | st.floats() | st.floats(min_value=1e-3, max_value=1e7), min_size=5, max_size=60))
def test_document_numbers_print_like_python(spark, values):
    from formwork.functions.documents import python_float_text

    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r.t for r in df.select(python_float_text(F.col("x")).alias("t")).collect()]
    assert got == [repr(v) for v in values]


def test_document_values_print_like_python(spark):
    import datetime

    from formwork.functions.documents import value_text

    rows = [(datetime.datetime(2024, 1, 2, 3, 4, 5, 120), datetime.date(2024, 1, 2), ["a", None, "b"], True, 7),
            (datetime.datetime(2024, 1, 2, 3, 4, 5), None, [], False, None)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, d date, l array<string>, b boolean, i bigint")
    types = {f.name: f.dataType for f in df.schema.fields}
    got = [tuple(r) for r in df.select(*[value_text(types[c], c).alias(c) for c in df.columns]).collect()]
    expected = [tuple("" if v is None else str(v) for v in r) for r in rows]
    assert got == expected


def test_versioned_import_checks_calculated_fields_and_bad_numbers(spark):
    from formwork.operators.validate import rules_from_rows

    rules = rules_from_rows([{"name": "x", "type": "integer"}, {"name": "a", "type": "calculate", "calculation": "${x} + 1", "constraint": ".<=3"}])
    rows = [("5", "1", "7", "1.5"), ("2", "1", "7", "1.5"), ("2", "1", "7", "abc"), ("2", "1", "7", " ")]
    df = spark.createDataFrame(rows, "x string, form_version string, org_unit_id string, latitude string")
    out = create_outbox(df, None, 1, rules_by_version={"1": rules}, created_at=0, keep=["x", "latitude"]).collect()
    by = {(r.x, r.latitude): r for r in out}
    assert {k: (r.outcome, r.reason) for k, r in by.items()} == {
        ("5", "1.5"): ("ignored", "invalid"), ("2", "1.5"): ("imported", None), ("2", "abc"): ("ignored", "bad_number"), ("2", " "): ("imported", None)}
    assert "<a>3</a>" in by["2", "1.5"].document


def test_equal_rows_get_their_own_ids(spark):
    df = spark.createDataFrame([("1", "7"), ("1", "7"), ("2", "7")], "field_a string, org_unit_id string")
    ids = [sorted(r.instance_uuid for r in create_outbox(df, RULES, 9, created_at=t, strict=False).collect()) for t in (1, 1, 2)]
    assert len(set(ids[0])) == 3 and ids[0] == ids[1] and not set(ids[0]) & set(ids[2])


def test_hot_ids_are_spread(spark):
    """A third of the rows on one id, a third without: the same locks as a plain join,
    and no partition of the join holds the hot id's rows."""
    from formwork.operators.importer import update_outbox
    from formwork.operators.lookup import hot_keys, left_lookup

    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else 100 + i, i) for i in range(6000)]
    df = spark.createDataFrame(rows, "id bigint, n int")
    assert hot_keys(df, F.col("id")) == [7]
    assert hot_keys(df.where("id is null"), F.col("id")) == []
    locks = spark.createDataFrame([(i, i % 2 == 0, f"v{i}") for i in range(0, 6200)] , "_id bigint, locked boolean, id2 string").where("_id % 5 != 0")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = left_lookup(df, F.col("id"), locks, "_id", hot=hot_keys(df, F.col("id")))
        assert out.columns == ["id", "n", "locked", "id2"]
        want = {(i, n, None, None) if i is None or i % 5 == 0 or i >= 6200 else (i, n, i % 2 == 0, f"v{i}") for i, n in rows}
        assert {tuple(r) for r in out.collect()} == want and out.count() == len(rows)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) < 2 * len(rows) / 8
        instances = spark.createDataFrame([(7, True), (102, True), (105, None)], "id bigint, is_locked boolean")
        subs = df.select("id", F.concat(F.lit("uuid:"), F.col("n").cast("string")).alias("instanceID"), F.lit("1").alias("org_unit_id"))
        got = update_outbox(subs, Rules([{"name": "x", "type": "text"}]), 1, instances=instances)
        assert {(r.reason, r["count"]) for r in got.groupBy("reason").count().collect()} == {("bad_id", 2000), ("locked", 2001), (None, 1999)}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
