"""Records with line breaks in quotes, from files split at every few bytes."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from millrace.sources import files, records, registry
from tests.conftest import rows


@pytest.fixture
def small_splits(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def write(path, table, header=("a", "b", "c"), line_end="\r\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=line_end).writerows([header, *table])
    path.write_text(out.getvalue(), newline="")


def drawn(seed, n=60):
    rng = random.Random(seed)
    cell = lambda: "".join(rng.choice(['"', "\n", ",", "x", "y", " ", '""', "é", "\n\n"]) for _ in range(rng.choice([0, 1, 3, 8, 90])))
    return [(str(k), cell(), "z" + cell()) for k in range(n)]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_split_records_equal_a_csv_reader(spark, tmp_path, small_splits, seed, line_end):
    want = []
    for part in range(2):
        table = drawn(10 * seed + part)
        write(tmp_path / f"{part}.csv", table, line_end=line_end)
        want += table
    found = records.csv_records(spark, files.storage.glob_files(spark, str(tmp_path)))
    assert found.filter("head").count() == 2
    got = [next(csv.reader([r["text"]])) if "\n" not in r["text"] else next(csv.reader(io.StringIO(r["text"], newline=""))) for r in found.filter("not head").collect()]
    assert sorted(map(tuple, got)) == sorted(want)
    df = files.read_csv_files(spark, str(tmp_path / "*.csv"), multi_line=True, infer=False)
    assert df.columns == ["a", "b", "c"]
    clean = lambda v: None if v == "" or v in files.MISSING_TEXTS else v
    assert rows(df) == sorted([tuple(map(clean, r)) for r in want], key=lambda r: [(v is None, str(v)) for v in r])


def test_quotes_within_plain_values_open_nothing(spark, tmp_path, small_splits):
    (tmp_path / "x.csv").write_text('a,b\n5" pipe,1\nx"y"z,2\n"q""",3\n,4\n"two\nlines, 6"" wide",5\n7",6\n')
    df = files.read_csv_files(spark, str(tmp_path / "x.csv"), multi_line=True)
    assert rows(df) == sorted([('5" pipe', 1), ('x"y"z', 2), ('q"', 3), (None, 4), ('two\nlines, 6" wide', 5), ('7"', 6)], key=lambda r: [(v is None, str(v)) for v in r])
    (tmp_path / "y.csv").write_text('a,b\n5" pipe,1\n"q""",3\n')
    assert files.read_csv_files(spark, str(tmp_path / "y.csv")).count() == 2  # nothing is open at a line's end


def test_no_silent_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,"x\ny"\n2,z\n')
    path = str(tmp_path / "x.csv")
    for read in (files.read_csv, files.read_csv_files, files.read_csv_normalized):
        with pytest.raises(ValueError, match="multi_line"):
            read(spark, path)
        assert rows(read(spark, path, multi_line=True)) == [(1, "x\ny"), (2, "z")]
    (tmp_path / "x.csv").write_text('a,b\n1,"x\ny\n2,z\n')
    with pytest.raises(ValueError, match="not closed"):
        files.read_csv(spark, path, multi_line=True)


def test_records_of_a_spec(spark, tmp_path, small_splits):
    (tmp_path / "1.csv").write_text('note 1\nnote "2"\na;b\n1;"x\ny"\nNA;z\n')
    (tmp_path / "2.csv").write_text('n\nn\nb;a\n"p;\n\nq";3\n')
    params = {"path": str(tmp_path / "*.csv"), "sep": ";", "skiprows": 2, "multi_line": True}
    df = registry.get_adapter("csv_local_simple")(spark, params, None)
    assert dict(df.dtypes)["a"] == "bigint" and rows(df.select("a", "b")) == [(1, "x\ny"), (3, "p;\n\nq"), (None, "z")]


def test_missing_texts_and_names_of_a_plain_source(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,x\nNA,null\n")
    (tmp_path / "2.csv").write_text("b,a\ny,3\n")
    for kind in ("csv", "csv_local"):
        df = registry.get_adapter(kind)(spark, {"path": str(tmp_path / "*.csv")}, None)
        assert dict(df.dtypes) == {"a": "bigint", "b": "string"} and rows(df.select("a", "b")) == [(1, "x"), (3, "y"), (None, None)]
        df = registry.get_adapter(kind)(spark, {"path": str(tmp_path / "1.csv"), "schema": "a int, b string", "na_values": ["x"]}, None)
        assert rows(df) == [(1, None), (None, None)]
        with pytest.raises(ValueError):
            registry.get_adapter(kind)(spark, {}, None)


def test_long_quoted_values_do_not_exhaust_the_matcher(spark, tmp_path):
    value = 'say ""hi"", ' * 40_000
    (tmp_path / "x.csv").write_text(f'a,b\n1,"{value}\n{value}"\n2,"{value}"\n')
    df = files.read_csv(spark, str(tmp_path / "x.csv"), multi_line=True)
    plain = value.replace('""', '"')
    assert sorted(r.b == (f"{plain}\n{plain}" if r.a == 1 else plain) for r in df.collect()) == [True, True]
    assert df.select(F.count("*")).first()[0] == 2
