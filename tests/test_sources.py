import csv
import random

import pytest
from pyspark.sql.functions import spark_partition_id

from tablescope import errors
from tablescope.sources import files
from tablescope.sources.files import load_dataset


def write(path, content, encoding="utf-8"):
    path.write_bytes(content.encode(encoding))
    return str(path)


def test_types_and_missing_tokens(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'a,b,c,d,e\n1,x,True,1.5,NA\n 2,"y, ""q""\nz",false,n/a,\n3,NULL,TRUE,-2e3,null\n')
    df = load_dataset(spark, path)
    assert dict(df.dtypes) == {"a": "bigint", "b": "string", "c": "boolean", "d": "double", "e": "double"}
    assert [tuple(r) for r in df.collect()] == [(1, "x", True, 1.5, None), (2, 'y, "q"\nz', False, None, None), (3, None, True, -2000.0, None)]


def test_suffixes_and_options(spark, tmp_path):
    assert load_dataset(spark, write(tmp_path / "a.tsv", "a\tb\n1\t2\n")).collect()[0] == (1, 2)
    assert load_dataset(spark, write(tmp_path / "a.TXT", "a,b\n1,2\n")).collect()[0] == (1, 2)
    assert load_dataset(spark, write(tmp_path / "s.csv", "a;b\n1;2\n"), sep=";").collect()[0] == (1, 2)
    latin = write(tmp_path / "l.csv", "a\nañ\n", "latin-1")
    assert load_dataset(spark, latin, encoding="latin-1").collect()[0]["a"] == "añ"
    with pytest.raises(errors.FileValidationError, match="latin-1"):
        load_dataset(spark, latin)
    assert load_dataset(spark, write(tmp_path / "t.csv", "a\n1\n"), schema="a string").dtypes == [("a", "string")]


def test_words_that_only_look_like_numbers_stay_text(spark, tmp_path):
    df = load_dataset(spark, write(tmp_path / "w.csv", "a,b,c\n1d,12345678901234567890,1\n2f,1,\n"))
    assert dict(df.dtypes) == {"a": "string", "b": "double", "c": "double"}


def test_bad_inputs(spark, tmp_path):
    with pytest.raises(errors.FileValidationError):
        load_dataset(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(errors.UnsupportedFileFormatError):
        load_dataset(spark, write(tmp_path / "a.json", "{}"))
    for name, content in [("empty.csv", ""), ("header.csv", "a,b\n")]:
        with pytest.raises(errors.EmptyDatasetError):
            load_dataset(spark, write(tmp_path / name, content))


def test_rows_with_too_many_fields_are_refused(spark, tmp_path):
    with pytest.raises(errors.FileValidationError, match="1 rows"):
        load_dataset(spark, write(tmp_path / "r.csv", "a,b\n1,2\n3,4,5\n6,7\n"))
    short = load_dataset(spark, write(tmp_path / "s.csv", "a,b\n1,2\n3\n"))
    assert [tuple(r) for r in short.collect()] == [(1, 2.0), (3, None)]


def test_declared_types_are_checked(spark, tmp_path):
    path = write(tmp_path / "d.csv", "a,b\n1,2\nx,4\n5\n")
    with pytest.raises(errors.FileValidationError, match="1 rows"):
        load_dataset(spark, path, schema="a bigint, b bigint")
    good = load_dataset(spark, write(tmp_path / "g.csv", "a,b\n1,2\n5\n"), schema="a bigint, b bigint")
    assert [tuple(r) for r in good.collect()] == [(1, 2), (5, None)]


def test_header_names_are_kept(spark, tmp_path):
    df = load_dataset(spark, write(tmp_path / "h.csv", "a,a,A,x.y,\n1,2,3,4,5\n"))
    assert df.columns == ["a", "a.1", "A.2", "x.y", "Unnamed: 4"] and tuple(df.collect()[0]) == (1, 2, 3, 4, 5)


def test_columns_are_matched_by_the_header_of_each_file(spark, tmp_path):
    write(tmp_path / "x1.csv", "a,b\n1,10\n2,20\n")
    write(tmp_path / "x2.csv", 'b,a\n30,3\n"4\n0",4\n')
    write(tmp_path / "x3.csv", "a,b\r\n5,50\r\n\r\n6,60")
    got = load_dataset(spark, str(tmp_path / "x*.csv")).orderBy("a").collect()
    assert [tuple(r) for r in got] == [(1, "10"), (2, "20"), (3, "30"), (4, "4\n0"), (5, "50"), (6, "60")]
    write(tmp_path / "x4.csv", "a,c\n7,70\n")
    with pytest.raises(errors.FileValidationError, match="other columns"):
        load_dataset(spark, str(tmp_path / "x*.csv"))
    latin = tmp_path / "latin"
    latin.mkdir()
    for i, head in enumerate(["a,b", "b,a"]):
        write(latin / f"{i}.csv", f"{head}\n1,2\n", "latin-1")
    with pytest.raises(errors.FileValidationError, match="different headers"):
        load_dataset(spark, str(latin / "*.csv"), encoding="latin-1")


def test_records_over_many_splits(spark, tmp_path):
    """Quoted line breaks, quotes and separators, cut at every possible place."""
    rng = random.Random(4)
    pieces = ["a", '"', "\n", ",", "é", "\r\n", " ", "long word", '""']
    rows = [[str(i), "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))] for i in range(400)]
    rows[77][1] = "x\n" * 2000  # longer than several splits
    rows[399][1] = 'the last "one"\nof all'
    path = tmp_path / "big.csv"
    with path.open("w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator="\n")
        out.writerow(["id", "text"])
        out.writerows(rows)
    blank = set(files.MISSING_TOKENS)
    want = {int(i): None if t in blank else t for i, t in rows}
    try:
        for size in ("134217728", "1500", "400", "61"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = load_dataset(spark, str(path))
            assert {r["id"]: r["text"] for r in df.collect()} == want
            if size == "1500":
                assert len({r[0] for r in df.select(spark_partition_id()).collect()}) > 4
                typed = load_dataset(spark, str(path), schema="id bigint, text string")
                assert typed.count() == 400 and typed.dtypes == [("id", "bigint"), ("text", "string")]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_quote_that_is_never_closed_ends_with_the_file(spark, tmp_path):
    df = load_dataset(spark, write(tmp_path / "q.csv", 'a,b\n1,x\n2,"open\nand on\n'))
    assert [r["a"] for r in df.collect()] == [1, 2]


def test_all_faults_are_counted_in_one_pass(spark, tmp_path):
    path = write(tmp_path / "f.csv", "a,b\n1,2,3\nx,4\n5,6,7\n")
    with pytest.raises(errors.FileValidationError, match="2 rows with more fields"):
        load_dataset(spark, path)
    with pytest.raises(errors.FileValidationError, match="2 columns, 3 are declared"):
        load_dataset(spark, path, schema="a int, b int, c int")
