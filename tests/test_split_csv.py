"""Multi-line CSV read in ranges against the one-task reader, at every cut."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from questa.functions.codebooks import SHORT_NAMES
from questa.plans import worth
from questa.sources import split_csv
from questa.sources.survey_csv import csv_options, read_survey_csv, to_questionnaire

FIELDS = ["", "plain", 'say "hi"', "two\nlines", 'a,b\n"\n', "\n\n", "x\r\ny", "é漢🙂", " pad ", '""', "long " * 40]


def make(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()



@pytest.fixture
def sizes(spark):
    yield lambda n: [spark.conf.set(f"spark.sql.files.{k}", str(n)) for k in ("maxPartitionBytes", "openCostInBytes")]
    for k in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{k}")


def one_task(spark, path):
    return [tuple(r) for r in spark.read.options(**csv_options()).csv(str(path)).collect()]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_as_the_one_task_reader_at_every_cut(spark, tmp_path, sizes, end):
    rng = random.Random(7)
    rows = [["id", "two\nline header", "c"]] + [[str(i), rng.choice(FIELDS), rng.choice(FIELDS)] for i in range(60)]
    path = tmp_path / "f.csv"
    path.write_text(make(rows, end) + end + "61,short" + end, newline="")
    with open(path, newline="") as fh:
        want = [(*(f or None for f in r), *[None] * (3 - len(r))) for r in csv.reader(fh) if r][1:]
    assert len(want) == 61
    if end == "\n":  # Spark takes the header's line feed for the end of all lines
        assert one_task(spark, path) == want
    for size in (7, 33, 100, 1 << 20):
        sizes(size)
        df = split_csv.read_csv_split(spark, str(path), "n")
        got = df.orderBy("n").collect()
        assert [tuple(r)[:-1] for r in got] == want, size
        if size < 1000:
            assert split_csv._lines(spark, str(path)).rdd.getNumPartitions() > 1


def test_file_order_runs_over_pieces_of_a_file(spark, tmp_path, sizes):
    rng = random.Random(9)
    header = list(SHORT_NAMES.values())
    rows = [[f"r{i:03d}", rng.choice(["2", "Less than 1"]), rng.choice(["$20-$40", ">$100"]), "$50-$100",
             rng.choice(["Pour over", "French press,\nEspresso", "Other"])] for i in rng.sample(range(400), 300)]
    (tmp_path / "one").mkdir()
    (tmp_path / "many").mkdir()
    (tmp_path / "one" / "a.csv").write_text(make([header, *rows]))
    at = [0, 5, 5, 90, 91, 260, 300]  # an empty piece, small and large ones
    for i, (lo, hi) in enumerate(zip(at, at[1:])):
        (tmp_path / "many" / f"p{i}.csv").write_text(make([header, *rows[lo:hi]]))
    (tmp_path / "many" / "p9.csv").write_text("")
    sizes(400)

    def positions(folder):
        survey = read_survey_csv(spark, str(tmp_path / folder), multiline="split", row_order_col=worth.FILE_ORDER)
        d = worth.decision_table(survey, key_unique=None, order_col=worth.FILE_ORDER)
        return {r.id: r.pos for r in worth.with_positions(d, order=worth.FILE_ORDER).collect()}
    one = positions("one")
    assert one == positions("many") == {r[0]: i + 1 for i, r in enumerate(rows)}


def test_no_rows(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text("a,b\n")
    df = split_csv.read_csv_split(spark, str(path), "n")
    assert df.columns == ["a", "b", "n"] and df.count() == 0


def test_a_range_that_changed_is_an_error(spark, tmp_path, sizes):
    path = tmp_path / "f.csv"
    path.write_text(make([["a"]] + [[f"row {i}\n"] for i in range(50)]))
    sizes(60)
    records = split_csv.read_records(spark, str(path))
    sizes(90)
    with pytest.raises(Exception, match="split differently"):
        records.count()


def test_spans_over_whole_ranges(spark, tmp_path, sizes):
    path = tmp_path / "f.csv"
    path.write_text(make([["a", "b"], ["1", "line\n" * 200], ["2", "x"], ["3", 'q"' * 100 + "\n"]]))
    want = one_task(spark, path)
    sizes(50)
    assert [tuple(r)[:2] for r in split_csv.read_csv_split(spark, str(path), "n").orderBy("n").collect()] == want
