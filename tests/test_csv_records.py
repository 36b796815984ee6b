"""Records with quoted line breaks across splits, against Spark's own reader of unsplit files."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from reviewlake import schemas
from reviewlake.sources import csv_records as R

COLUMNS = [f.name for f in schemas.REVIEWS_CSV.fields]


def whole_file_rows(spark, path):
    df = spark.read.schema(schemas.REVIEWS_CSV).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return sorted(map(tuple, df.collect()), key=str)


def write(path, rows, newline, quoting):
    text = io.StringIO()
    out = csv.writer(text, lineterminator=newline, quoting=quoting)
    out.writerow(COLUMNS)
    out.writerows(rows)
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text.getvalue())


def rows_of(n, seed):
    rng = random.Random(seed)
    parts = ["plain", "a, b", 'say ""', '"', "\n", "\n\n", ",", "é日本", " tail ", "x" * 300, "line\nline\nline", '","', "\n" * 40]
    return [[f"r{k}", rng.choice(["u", "", "v\nw"]), "5", "".join(rng.choice(parts) for _ in range(rng.randint(1, 6))), "0", "1.0", "2024-01-01 00:00:00", "", "end"] for k in range(n)]


@pytest.fixture()
def split_size(spark):
    names = [f"spark.sql.files.{n}" for n in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum")]
    before = [spark.conf.get(n, None) for n in names]

    def put(size):
        for n, v in zip(names, (size, 0, 1)):
            spark.conf.set(n, str(v))
    yield put
    for n, v in zip(names, before):
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
def test_every_split_size_gives_the_rows_of_the_whole_file(spark, tmp_path, split_size, newline, quoting):
    path = str(tmp_path / "one.csv")
    write(path, rows_of(120, 3), newline, quoting)
    size = os.path.getsize(path)
    want = whole_file_rows(spark, path)
    assert len(want) == 120
    for split in (size * 2, size // 3, 1024, 97):
        split_size(split)
        df = R.read_csv(spark, path, schemas.REVIEWS_CSV)
        assert sorted(map(tuple, df.collect()), key=str) == want, split
        # As many tasks as the split size gives read the one file.
        assert R.lines_of(spark, path).rdd.getNumPartitions() == -(-size // split)


def test_several_files_and_records_longer_than_splits(spark, tmp_path, split_size):
    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(3):
        rows = rows_of(20, 10 + k)
        rows[7][3] = "long\n" * 2000
        rows[-1][8] = "the last value\nhas a break"
        write(str(folder / f"f{k}.csv"), rows, "\n", csv.QUOTE_ALL)
    want = whole_file_rows(spark, str(folder))
    split_size(500)
    got = R.read_csv(spark, str(folder), schemas.REVIEWS_CSV)
    assert sorted(map(tuple, got.collect()), key=str) == want and len(want) == 60


def test_only_lines_of_broken_records_are_shuffled(spark, tmp_path, split_size):
    path = str(tmp_path / "one.csv")
    rows = [[f"r{k}", "u", "5", "one line" if k % 50 else "two\nlines", "0", "1", "t", "", ""] for k in range(1000)]
    write(path, rows, "\n", csv.QUOTE_MINIMAL)
    split_size(2048)
    pieces = R._pieces(R.lines_of(spark, path).join(F.broadcast(R.split_states(R.lines_of(spark, path))), ["file", "split"]))
    assert pieces.filter("NOT whole").count() == 40 and pieces.count() == 1021


def test_empty_files_and_an_open_quote(spark, tmp_path):
    path = str(tmp_path / "e.csv")
    open(path, "w").close()
    assert R.read_csv(spark, path, schemas.REVIEWS_CSV).count() == 0
    with open(path, "w") as f:
        f.write(",".join(COLUMNS) + '\n\na,b,1,"never\nclosed\n')
    assert [r["value"] for r in R.records(spark, path).orderBy("record").collect()] == [",".join(COLUMNS), 'a,b,1,"never\nclosed']
