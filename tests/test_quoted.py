"""CSV with quoted line breaks: any split of a file gives the rows one task would read."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from snapgate.sources import quoted
from snapgate.sources.raw import CORRUPT, ORDER_COLUMNS, read_raw


@pytest.fixture
def ranges(spark):
    """Sets how many bytes Spark reads as one range."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda n: spark.conf.set(key, n)
    spark.conf.set(key, before)


def write(path, rows, end="\n", quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO()
    csv.writer(out, lineterminator=end, quoting=quoting).writerows(rows)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(out.getvalue().encode())


def in_order(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy(*ORDER_COLUMNS).collect()]


def odd_rows(n, seed):
    rng = random.Random(seed)
    parts = ["a", 'say ""', "\n", "\n\n", ",", '"', "é", " ", "x" * 30, "\n1,2\n", '",\n"', "end"]
    return [[str(i), "v" + "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 3, 12]))) + ".", f"k{i % 7}"] for i in range(n)]


@pytest.mark.parametrize("size", [37, 64, 333, 5000, 1 << 27])
def test_rows_and_their_order_do_not_hang_on_the_split(spark, tmp_path, ranges, size):
    days = {"2024-01-01": odd_rows(120, 1), "2024-01-02": odd_rows(40, 2)}
    for day, rows in days.items():
        write(tmp_path / f"snapshot_date={day}" / "a b.csv", [["id", "note", "k"], *rows], "\r\n" if day.endswith("2") else "\n")
    ranges(size)
    df = read_raw(spark, str(tmp_path), multi_line=True)
    assert in_order(df, "snapshot_date", "id", "note", "k") == [(day, *r) for day, rows in days.items() for r in rows]
    assert (df.rdd.getNumPartitions() > 2) == (size < 5000)


def test_records_longer_than_ranges_and_left_open(spark, tmp_path, ranges):
    body = 'id,note\n1,"' + "line\n" * 200 + '"\n2,b\n\n  \n3,"open\nto the, end\n'
    (tmp_path / "a.csv").write_text(body)
    ranges(100)
    rows = in_order(read_raw(spark, str(tmp_path), multi_line=True), "id", "note")
    assert rows == [("1", "line\n" * 200), ("2", "b"), ("  ", None), ("3", "open\nto the, end\n".rstrip("\n"))] or \
        rows == [("1", "line\n" * 200), ("2", "b"), ("  ", None), ("3", "open\nto the, end")]


def test_equals_the_parser_on_stray_quotes(spark, tmp_path, ranges):
    rng = random.Random(7)
    for k in range(12):
        lines = ["a,b,c"]
        for i in range(60):
            cells = [rng.choice(['5" pipe', "x", "", '"q"', '"two\nlines"', '"d""q"', 'st"ray"', '" "', '"a" b', "'", '"\n"']) for _ in range(3)]
            lines.append(",".join([f"r{i}" + cells[0].replace('"', "").replace("\n", ""), *cells[1:]]))
        path = tmp_path / f"f{k}"
        path.mkdir()
        (path / "a.csv").write_text("\n".join(lines) + "\n")
        ranges(1 << 27)
        whole = spark.read.options(header=True, escape='"', multiLine=True).csv(str(path))
        expected = [tuple(None if v == "" else v for v in r) for r in whole.collect()]
        ranges(rng.choice([40, 90, 200]))
        assert in_order(read_raw(spark, str(path), multi_line=True), "a", "b", "c") == expected


def test_every_line_moves_the_reader_as_a_scan_by_bytes_does():
    """Both patterns against a machine that takes one character at a time."""
    def machine(line, state):
        for c in line:
            if state == "start":
                state = {'"': "in", ",": "start"}.get(c, "plain")
            elif state == "plain":
                state = "start" if c == "," else "plain"
            elif state == "in":
                state = "shut" if c == '"' else "in"
            else:
                state = {'"': "in", ",": "start"}.get(c, "plain")
        return state == "in"
    rng = random.Random(3)
    for _ in range(20_000):
        line = "".join(rng.choice('"",a ') for _ in range(rng.randrange(14)))
        assert quoted.moves(line) == (machine(line, "start"), machine(line, "in")), line
    long = '"' * 200_001 + "," + "a," * 100_000
    assert quoted.moves(long) == (machine(long, "start"), machine(long, "in"))


def test_corrupt_lines_are_found_whichever_columns_are_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,x\n2,y,EXTRA\n3\n")
    for multi in (False, True):
        df = read_raw(spark, str(tmp_path), multi_line=multi)
        for columns in (["a"], ["b"], ["a", "b"]):
            with pytest.raises(Exception, match="too many cells: 2,y,EXTRA"):
                df.select(*columns).collect()
        with pytest.raises(Exception, match="too many cells"):
            df.count()
        kept = read_raw(spark, str(tmp_path), multi_line=multi, on_corrupt="keep")
        assert kept.where(F.col(CORRUPT).isNotNull()).select("a").collect() == [("2",)]
        assert kept.select(CORRUPT).where(f"{CORRUPT} is not null").collect() == [("2,y,EXTRA",)]
        assert sorted(map(tuple, kept.select("a", "b").collect())) == [("1", "x"), ("2", "y"), ("3", None)]


def test_headers_with_breaks_repeats_and_differences(spark, tmp_path, ranges):
    head = ["id", "two\nlines", "", "id"]
    for name in ("a", "b"):
        write(tmp_path / f"{name}.csv", [head, ["1", "x\ny", "e", name]])
    (tmp_path / "empty.csv").write_text("")
    ranges(9)
    df = read_raw(spark, str(tmp_path), multi_line=True)
    assert sorted(tuple(r)[:4] for r in df.collect()) == [("1", "x\ny", "e", "a"), ("1", "x\ny", "e", "b")]
    write(tmp_path / "c.csv", [["id", "other", "", "id"], ["1", "2", "3", "4"]])
    with pytest.raises(Exception, match="header differs"):
        read_raw(spark, str(tmp_path), multi_line=True).collect()


def test_a_quote_that_is_never_closed_is_told(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quoted, "MAX_RECORD", 1000)
    (tmp_path / "a.csv").write_text('id,note\n1,"' + "line\n" * 400)
    with pytest.raises(Exception, match="not closed"):
        read_raw(spark, str(tmp_path), multi_line=True).collect()
