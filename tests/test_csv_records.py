"""CSV files read in many tasks give the rows that one parser of the whole file gives."""

import random

import pytest

from formwork.sources.csv_records import csv_records
from formwork.sources.readers import CSV_DIALECT, CSV_READING, EMPTY_MARK, infer_csv_schema, read_csv_text, read_submissions


@pytest.fixture
def small_blocks(spark):
    """Blocks of 64 bytes, so that records and quotes cross them."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "64")
    spark.conf.set(names[1], "0")
    yield
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def by_whole_files(spark, path):
    rows = spark.read.options(**CSV_DIALECT, **CSV_READING, inferSchema="false").csv(path).collect()
    return sorted((tuple("" if v == EMPTY_MARK else v for v in r) for r in rows), key=str)


def field(rng, end):
    kind = rng.randrange(9)
    words = ["a", "bb", "5\" pipe", "x\"y", " z ", "é", "", "1"]
    if kind < 4:
        return rng.choice([w for w in words if not w.startswith('"')])
    text = "".join(rng.choice(["a", "b", ",", end, end, '""', " ", "long words " * rng.randrange(4)]) for _ in range(rng.randrange(12)))
    return f'"{text}"'


@pytest.mark.parametrize("seed", range(4))
def test_any_blocks_give_the_same_rows(spark, small_blocks, tmp_path, seed):
    rng = random.Random(seed)
    for n in range(3):
        end = rng.choice(["\n", "\n", "\r\n"])
        rows = [",".join(field(rng, end) for _ in range(3)) for _ in range(60)]
        body = ["id,\"two lines\",c", *rows, "", *rows[:5]]
        (tmp_path / f"part{n}.csv").write_bytes((end.join(body) + (end if n else "")).encode())
    path = str(tmp_path)
    got = read_csv_text(spark, path)
    assert got.columns == ["id", "two lines", "c"]
    # line breaks inside quotes stay as they are; the parser of whole files makes them \n
    got = [tuple(v and v.replace("\r\n", "\n") for v in r) for r in got.collect()]
    assert sorted(got, key=str) == by_whole_files(spark, path)


def test_one_file_is_many_tasks(spark, small_blocks, tmp_path):
    (tmp_path / "s.csv").write_text("id,text\n" + "".join(f'{i},"line one\nline {i}"\n' if i % 50 == 0 else f"{i},plain text {i}\n" for i in range(400)))
    path = str(tmp_path / "s.csv")
    assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 100
    assert csv_records(spark, path).count() == 400
    back = read_submissions(spark, path)
    assert dict(back.dtypes) == {"id": "int", "text": "string"}
    assert {(r.id, r.text) for r in back.collect()} == {(i, f"line one\nline {i}" if i % 50 == 0 else f"plain text {i}") for i in range(400)}


def test_a_record_longer_than_many_blocks(spark, small_blocks, tmp_path):
    text = "\n".join(f"word {i}, \"\"quoted\"\"" for i in range(200))
    (tmp_path / "s.csv").write_text(f'a,b\n1,"{text}"\n2,x\n3,"{text}"\n')
    got = {r.a: r.b for r in read_csv_text(spark, str(tmp_path / "s.csv")).collect()}
    assert got == {"1": text.replace('""', '"'), "2": "x", "3": text.replace('""', '"')}


def test_headers_alone_and_types(spark, tmp_path):
    (tmp_path / "h.csv").write_text("a,b\n")
    assert read_csv_text(spark, str(tmp_path / "h.csv")).collect() == []
    with pytest.raises(ValueError):
        read_submissions(spark, str(tmp_path / "h.csv"))
    with pytest.raises(FileNotFoundError):
        read_csv_text(spark, str(tmp_path / "none.csv"))
    (tmp_path / "t.csv").write_text('i,l,d,s,t,n\n1,9000000000,1.5,x,2024-01-02,\n2,1,2,"",2024-01-03,\n')
    path = str(tmp_path / "t.csv")
    whole = spark.read.options(**CSV_DIALECT, **CSV_READING, inferSchema="true").csv(path).schema
    assert infer_csv_schema(spark, path) == whole
