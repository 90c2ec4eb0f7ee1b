import json

import pytest
from pyspark.sql import functions as F

from formwork.functions.geometry import decode_geometry
from formwork.operators.fingerprint import content_fingerprint
from formwork.operators.geo import geojson_feature, polygon_rings, shared_arcs
from formwork.operators.orgunits import attach_geometry, filter_org_unit_type, project_org_units
from formwork.sinks.writers import snapshot_if_changed, write_file
from formwork.sources.readers import parse_cutoff, read_submissions, updated_since

SQUARE_HOLE = [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]]
GEOMS = [
    (1, '{"type": "Point", "coordinates": [2.5, 3.5]}'),
    (2, '{"type": "Point", "coordinates": [2.5, 3.5, 100]}'),
    (3, json.dumps({"type": "MultiPolygon", "coordinates": [SQUARE_HOLE]})),
    (4, json.dumps({"type": "MultiPolygon", "coordinates": [SQUARE_HOLE, [[[5, 5], [6, 5], [6, 6], [5, 5]]]]})),
    (5, '{"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}'),
    (6, "{not json"),
    (7, '{"type": "Point"}'),
    (8, None),
]


def geoms(spark):
    return spark.createDataFrame(GEOMS, "id long, geometry string")


def test_decode_geometry(spark):
    out = {r.id: r.g for r in geoms(spark).select("id", decode_geometry("geometry").alias("g")).collect()}
    assert (out[1].kind, out[1].lon, out[1].lat) == ("Point", 2.5, 3.5)
    assert (out[2].lon, out[2].lat) == (2.5, 3.5)
    assert out[3].kind == "MultiPolygon" and len(out[3].polygons) == 1 and len(out[3].polygons[0]) == 2
    assert len(out[4].polygons) == 2
    assert all(out[i] is None for i in (5, 6, 7, 8))  # D-13


def test_decode_geometry_compat(spark):  # D-12: rings of the first polygon become polygons
    out = {r.id: r.g for r in geoms(spark).select("id", decode_geometry("geometry", compat=True).alias("g")).collect()}
    assert len(out[4].polygons) == 2 and all(len(p) == 1 for p in out[4].polygons)


def test_polygon_rings(spark):
    g = geoms(spark).select("id", decode_geometry("geometry").alias("geometry"))
    rings = {(r.id, r.polygon, r.ring): r.n_vertices for r in polygon_rings(g, level="ring").collect()}
    assert rings == {(3, 0, 0): 5, (3, 0, 1): 5, (4, 0, 0): 5, (4, 0, 1): 5, (4, 1, 0): 4}
    assert polygon_rings(g).where("id = 3").count() == 10


def test_shared_arcs_grid(spark):
    cells = [(x * 4 + y, json.dumps({"type": "MultiPolygon", "coordinates": [[[[x, y], [x + 1, y], [x + 1, y + 1], [x, y + 1], [x, y]]]]}))
             for x in range(4) for y in range(4)]
    g = spark.createDataFrame(cells, "id long, geometry string").select("id", decode_geometry("geometry").alias("geometry"))
    arcs = shared_arcs(g).collect()
    assert len(arcs) == 40 and sum(1 for a in arcs if a.n_units == 2) == 24


def test_geojson_feature(spark):
    g = geoms(spark).select("id", F.to_date(F.lit("2024-01-02")).alias("d"), decode_geometry("geometry").alias("geometry"))
    feats = [json.loads(r.feature) for r in geojson_feature(g).collect()]
    f1 = feats[0]
    assert f1["type"] == "Feature" and f1["geometry"] == {"type": "Point", "coordinates": [2.5, 3.5]}
    assert f1["properties"] == {"id": 1, "d": "2024-01-02"}
    assert feats[-1]["geometry"] is None


def test_attach_geometry_one_value_per_id(spark):
    units = spark.createDataFrame([(1, "a"), (2, "b"), (9, "c")], "id long, name string")
    lookup = spark.createDataFrame([(1, "g1"), (1, "g0"), (2, "g2")], "id long, geometry string")
    got = {r.id: r.geometry for r in attach_geometry(units, lookup).collect()}
    assert got == {1: "g1", 2: "g2", 9: None}


def test_project_org_units_and_type_filter(spark):
    raw = spark.createDataFrame(
        [("1", "A", "District", 1.0, 2.0, "2020-01-02", None, "2020-01-02 03:04", "2020-01-03 03:04", "s", "VALID", "r1", "9", "Pays")],
        "ID string, Nom string, Type string, Latitude double, Longitude double, `Date d'ouverture` string, "
        "`Date de fermeture` string, `Date de création` string, `Date de modification` string, Source string, "
        "`Validé` string, `Référence externe` string, `Ref Ext parent 1` string, `parent 1` string",
    )
    out = project_org_units(raw)
    assert out.columns[-2:] == ["level_1_ref", "level_1_name"] and "level_2_ref" not in out.columns
    assert str(out.first().created_at) == "2020-01-02 03:04:00"
    types = spark.createDataFrame([(7, "District")], "id int, name string")
    assert filter_org_unit_type(out, types, 7).count() == 1
    with pytest.raises(ValueError):
        filter_org_unit_type(out, types, 8)


def test_fingerprint_ignores_order_and_partitioning(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), F.col("id").cast("string").alias("b"))
    assert content_fingerprint(df) == content_fingerprint(df.orderBy(F.desc("b")).repartition(5).select("b", "a"))
    assert content_fingerprint(df) != content_fingerprint(df.where("id > 0"))


def test_snapshot_written_once(spark, tmp_dir):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    root = f"{tmp_dir}/snap"
    assert snapshot_if_changed(spark, df, root) == ("v1", True)
    assert snapshot_if_changed(spark, df.repartition(3), root) == ("v1", False)
    assert snapshot_if_changed(spark, df.where("id < 5"), root) == ("v2", True)
    assert spark.read.parquet(f"{root}/v2").count() == 5


def test_snapshot_runs_its_content_once(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(100).mapInArrow(count, "id long")
    assert snapshot_if_changed(spark, df, f"{tmp_dir}/once") == ("v1", True)
    assert seen.value == 100
    assert snapshot_if_changed(spark, df, f"{tmp_dir}/once") == ("v1", False)
    assert seen.value == 200
    assert snapshot_if_changed(spark, df.limit(0), f"{tmp_dir}/once") == ("v2", True)
    import os

    assert os.listdir(f"{tmp_dir}/once/_staged") == []


def test_concurrent_snapshots_get_versions_of_their_own(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor

    frames = [spark.range(n, n + 50) for n in range(4)]
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda f: snapshot_if_changed(spark, f, f"{tmp_dir}/many"), frames))
    assert sorted(got) == [(f"v{n}", True) for n in range(1, 5)]
    for f, (name, _) in zip(frames, got):
        assert sorted(r.id for r in spark.read.parquet(f"{tmp_dir}/many/{name}").collect()) == sorted(r.id for r in f.collect())
    assert spark.read.parquet(f"{tmp_dir}/many/_versions").count() == 4


def test_nested_times_change_the_fingerprint(spark):
    base = spark.sql("SELECT array(timestamp_micros(1000001)) a, named_struct('t', CAST(timestamp_micros(5) AS timestamp_ntz)) b")
    for other in (
        "SELECT array(timestamp_micros(1000002)) a, named_struct('t', CAST(timestamp_micros(5) AS timestamp_ntz)) b",
        "SELECT array(timestamp_micros(1000001)) a, named_struct('t', CAST(timestamp_micros(6) AS timestamp_ntz)) b",
    ):
        assert content_fingerprint(base) != content_fingerprint(spark.sql(other))


def test_a_repeated_append_gives_its_rows_once(spark):
    from formwork.sinks.writers import append_once

    spark.sql("DROP TABLE IF EXISTS fw_runs")
    one, two = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string"), spark.createDataFrame([(3,)], "x int")
    assert append_once(spark, one, "fw_runs", "r1") == 2
    assert append_once(spark, one, "fw_runs", "r1") == 0
    assert append_once(spark, two, "fw_runs", "r'2") == 1
    assert append_once(spark, two, "fw_runs", "r'2") == 0
    want = [(1, "a", "r1"), (2, "b", "r1"), (3, None, "r'2")]
    assert sorted(tuple(r) for r in spark.table("fw_runs").collect()) == want
    with pytest.raises(ValueError):
        append_once(spark, one.withColumn("z", F.lit(1)), "fw_runs", "r3")
    assert sorted(tuple(r) for r in spark.table("fw_runs").collect()) == want


def test_read_submissions_rules(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a", ["x"])], "org_unit_id long, f string, l array<string>")
    assert write_file(df, f"{tmp_dir}/subs.csv", "csv") == 1  # arrays flattened to JSON text (F17); rows observed
    back = read_submissions(spark, f"{tmp_dir}/subs.csv")
    assert back.first().l == '["x"]' and dict(back.dtypes)["org_unit_id"] == "int"
    with pytest.raises(ValueError):
        read_submissions(spark, f"{tmp_dir}/subs.xlsx")
    with pytest.raises(FileNotFoundError):
        read_submissions(spark, f"{tmp_dir}/missing.parquet")
    df.limit(0).write.parquet(f"{tmp_dir}/empty.parquet")
    with pytest.raises(ValueError, match="no rows"):
        read_submissions(spark, f"{tmp_dir}/empty.parquet")


def test_updated_since_boundary(spark):
    df = spark.createDataFrame([("2024-01-15 00:00:00",), ("2024-01-15 00:00:01",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("updated_at"))
    assert updated_since(df, "2024-01-15").count() == 1  # strictly after (D-20)
    assert updated_since(df, "2024-01-15", inclusive=True).count() == 2
    assert updated_since(df, None).count() == 2
    with pytest.raises(ValueError):
        parse_cutoff("15/01/2024")


def test_read_form_definition_latest_and_named(spark, tmp_dir):
    from formwork.sources.readers import read_form_definition

    qs = spark.createDataFrame(
        [("1", " age ", "integer"), ("2", "age", "integer "), ("2", "sex", "select_one sex"), ("2", None, None), ("10", "x", "text")],
        "form_version string, name string, type string",
    )
    qs.write.parquet(f"{tmp_dir}/def/questions")
    latest = read_form_definition(spark, f"{tmp_dir}/def", "questions")
    assert [r.name for r in latest.collect()] == ["x"]  # 10 > 2 as integers
    named = read_form_definition(spark, f"{tmp_dir}/def", "questions", version="2").collect()
    assert sorted((r.name, r.type) for r in named) == [("age", "integer"), ("sex", "select_one sex")]  # trimmed, all-null row dropped
    with pytest.raises(ValueError):
        read_form_definition(spark, f"{tmp_dir}/def", "answers")


def test_read_geometries(spark, tmp_dir):
    from formwork.sources.readers import read_geometries

    spark.createDataFrame([(1, "g")], "ou long, shape string").write.parquet(f"{tmp_dir}/g")
    assert read_geometries(spark, f"{tmp_dir}/g", id_col="ou", geometry_col="shape").collect()[0].asDict() == {"id": 1, "geometry": "g"}


def test_write_table_replace_and_append(spark):
    from formwork.operators.fingerprint import is_empty, row_count
    from formwork.sinks.writers import write_table

    spark.sql("DROP TABLE IF EXISTS fw_subs")
    assert write_table(spark, spark.createDataFrame([(1, "a")], "x int, y string"), "fw_subs") == 1
    assert write_table(spark, spark.createDataFrame([("b", 2)], "y string, x int"), "fw_subs", "append") == 1  # by name
    got = sorted(tuple(r) for r in spark.table("fw_subs").collect())
    assert got == [(1, "a"), (2, "b")] and row_count(spark.table("fw_subs")) == 2 and not is_empty(spark.table("fw_subs"))
    with pytest.raises(ValueError):  # V5 before an append
        write_table(spark, spark.createDataFrame([(3, "c", 1)], "x int, y string, z int"), "fw_subs", "append")
    write_table(spark, spark.createDataFrame([(9, "z")], "x int, y string"), "fw_subs")
    assert spark.table("fw_subs").count() == 1


def test_csv_types_from_the_whole_input(spark, tmp_dir):
    lines = ["a,b"] + [f"{i},x" for i in range(30)] + ["oops,y"]
    with open(f"{tmp_dir}/s.csv", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    assert dict(read_submissions(spark, f"{tmp_dir}/s.csv").dtypes)["a"] == "string"
    with pytest.raises(Exception, match="unparsable value"):  # no silent nulls
        read_submissions(spark, f"{tmp_dir}/s.csv", "a int, b string").collect()


def test_csv_dialect_and_header_order(spark, tmp_dir):
    with open(f"{tmp_dir}/q.csv", "w") as fh:
        fh.write('b,id,a\n" pad ",1,"say ""hi"", ok"\n"two\nlines",2,""\nx,3,\n')
    got = [tuple(r) for r in read_submissions(spark, f"{tmp_dir}/q.csv", "id int, a string, b string").collect()]
    assert sorted(got) == [(1, 'say "hi", ok', " pad "), (2, "", "two\nlines"), (3, None, "x")]
    with pytest.raises(ValueError, match="has no column"):
        read_submissions(spark, f"{tmp_dir}/q.csv", "id int, c string")


def test_csv_round_trip(spark, tmp_dir):
    rows = [(1, "  pad  "), (2, ""), (3, None), (4, 'a "q", b\nc'), (5, "back\\slash")]
    df = spark.createDataFrame(rows, "id int, t string")
    write_file(df, f"{tmp_dir}/r.csv", "csv")
    assert sorted(tuple(r) for r in read_submissions(spark, f"{tmp_dir}/r.csv", "id int, t string").collect()) == rows
    assert sorted(tuple(r) for r in read_submissions(spark, f"{tmp_dir}/r.csv").collect()) == rows


def test_fingerprint_sees_every_change(spark, tmp_dir):
    from formwork.operators.fingerprint import content_fingerprint

    frames = [
        spark.createDataFrame([(None, "x"), ("y", None)], "a string, b string"),
        spark.createDataFrame([("x", None), (None, "y")], "a string, b string"),
        spark.createDataFrame([(None, "x"), ("y", None)], "k string, z string"),
        spark.createDataFrame([(1, 2)], "a int, b int"),
        spark.createDataFrame([(1, 2)], "a long, b int"),
        spark.createDataFrame([([["1"], ["2"]],)], "l array<array<string>>"),
        spark.createDataFrame([([["1", "2"]],)], "l array<array<string>>"),
        spark.createDataFrame([([["1", None, "2"]],)], "l array<array<string>>"),
    ]
    assert len({content_fingerprint(f) for f in frames}) == len(frames)
    again = spark.createDataFrame([("y", None), (None, "x")], "a string, b string").repartition(3)
    assert content_fingerprint(again) == content_fingerprint(frames[0])
    versions = [snapshot_if_changed(spark, f, f"{tmp_dir}/snap") for f in (frames[0], again, frames[1], frames[2])]
    assert versions == [("v1", True), ("v1", False), ("v2", True), ("v3", True)]


def test_append_with_fewer_columns(spark):
    from formwork.sinks.writers import write_table

    spark.sql("DROP TABLE IF EXISTS fw_fewer")
    write_table(spark, spark.createDataFrame([(1, "a")], "x int, y string"), "fw_fewer")
    write_table(spark, spark.createDataFrame([(2,)], "x int"), "fw_fewer", "append")
    assert sorted(tuple(r) for r in spark.table("fw_fewer").collect()) == [(1, "a"), (2, None)]


def test_staged_decoding_equals_the_column_form(spark):
    from formwork.operators.geo import decode_geometries

    staged = {r.id: (r.geometry, r.compat) for r in decode_geometries(geoms(spark), compat_target="compat").collect()}
    inline = {r.id: (r.g, r.c) for r in geoms(spark).select("id", decode_geometry("geometry").alias("g"),
                                                             decode_geometry("geometry", compat=True).alias("c")).collect()}
    assert staged == inline


def test_merged_arcs_cover_every_segment_once(spark):
    """Arcs of random unions of cells: every segment in one arc, junctions only at ends,
    rings start at their smallest vertex."""
    import collections
    import random

    from formwork.operators.geo import merged_arcs

    rng = random.Random(4)
    cells = {(x, y): rng.randrange(5) for x in range(7) for y in range(6) if rng.random() < 0.85}
    rows = []
    for (x, y), unit in cells.items():
        rows.append((unit, [[[float(a), float(b)] for a, b in ((x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y))]]))
    long = [[float(i), 100.0] for i in range(40)] + [[float(i), 101.0] for i in reversed(range(40))] + [[0.0, 100.0]]
    rows += [(9, [long]), (10, [[[50.0, 50.0], [51.0, 50.0], [50.5, 51.0], [50.0, 50.0]]]), (11, [[[50.0, 50.0], [51.0, 50.0], [50.5, 51.0], [50.0, 50.0]]])]
    df = spark.createDataFrame([(u, {"polygons": [p]}) for u, p in rows], "id int, geometry struct<polygons:array<array<array<array<double>>>>>")
    users = collections.defaultdict(set)
    for u, (ring,) in rows:
        for a, b in zip(ring, ring[1:]):
            users[tuple(sorted((tuple(a), tuple(b))))].add(u)
    around = collections.defaultdict(list)
    for (a, b), units in users.items():
        around[a].append(units)
        around[b].append(units)
    junction = {v for v, sets in around.items() if len(sets) != 2 or sets[0] != sets[1]}
    seen = collections.Counter()
    arcs = merged_arcs(df).collect()
    for arc in arcs:
        path = [tuple(v) for v in arc.vertices]
        assert path <= path[::-1] and arc.n_units == len(arc.units)
        for a, b in zip(path, path[1:]):
            seen[tuple(sorted((a, b)))] += 1
            assert users[tuple(sorted((a, b)))] == set(arc.units)
        assert not junction & set(path[1:-1])
        assert {path[0], path[-1]} <= junction or (path[0] == path[-1] == min(path))
    assert seen == collections.Counter(dict.fromkeys(users, 1))
    assert max(len(a.vertices) for a in arcs) == 81 and any(a.units == [10, 11] and len(a.vertices) == 4 for a in arcs)
    assert merged_arcs(df.limit(0)).collect() == []
