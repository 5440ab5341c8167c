"""Split CSV, versioned tables and event-time day counts, against plain versions."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from ratelens.session import scratch_path
from ratelens.sources import reviews, split_csv, versions
from ratelens.streaming import day_windows


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    old = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


def one_file(folder, content):
    (folder / "part.csv").write_bytes(content.encode())
    return folder.as_uri()


AWKWARD = ["plain", 'said "so"', "two\nlines", "\n\nstarts with lines\n", 'quote at end"', '"', '""', "a,b,c", "", None, "back\\slash", "é中\U0001f600\nx", "1,2\n3,4", "x" * 1500, "l\n" * 900,
           '"\n"', "carriage\r\nreturn", "tail\r", ",\n,", "id,text,n"]


def test_split_csv_equals_the_reader_of_one_task(spark, small_splits):
    rng = random.Random(3)
    rows = [(i, rng.choice(AWKWARD) if i % 2 else "".join(rng.choice('a",\n b') for _ in range(rng.randint(0, 60))), i * 7) for i in range(600)]
    folder = scratch_path(spark, "awkward")
    reviews.write_csv(spark.createDataFrame(rows, "id long, text string, n long").coalesce(2), folder)
    schema = spark.createDataFrame([], "id long, text string, n long").schema
    parts = spark.read.option("lineSep", "\n").text(folder).rdd.getNumPartitions()
    assert parts > 20
    whole = sorted(reviews.read_csv(spark, folder, schema).collect(), key=str)
    assert sorted(split_csv.read_split_csv(spark, folder, schema).collect(), key=str) == whole
    assert {r["id"]: r["text"] for r in whole if r["id"] % 2 == 0} == {i: t or None for i, t, _ in rows if i % 2 == 0}  # an empty field reads as null


@pytest.mark.parametrize("content", ["", "id,text,n\n", "id,text,n", "id,text,n\r\n1,a,2\r\n\r\n2,c,3\r\n", "id,text,n\n\n\n5,x,6"])
def test_split_csv_edges(spark, small_splits, tmp_path, content):
    folder = one_file(tmp_path, content)
    schema = spark.createDataFrame([], "id long, text string, n long").schema
    assert sorted(split_csv.read_split_csv(spark, folder, schema).collect(), key=str) == sorted(reviews.read_csv(spark, folder, schema).collect(), key=str)


def test_quoted_line_ends_stay_and_an_open_quote_takes_the_rest(spark, small_splits, tmp_path):
    schema = spark.createDataFrame([], "id long, text string, n long").schema
    folder = one_file(tmp_path, 'id,text,n\r\n1,"a\r\nb",2\r\n\r\n2,"never closed\r\n3,b,4\n')
    assert sorted(map(tuple, split_csv.read_split_csv(spark, folder, schema).collect())) == [(1, "a\r\nb", 2), (2, "never closed\r\n3,b,4", None)]


def test_records_keep_their_order(spark, small_splits, tmp_path):
    rows = [f'{i},"{"x" * (i % 90)}\n{i}"' for i in range(400)]
    folder = one_file(tmp_path, "h,t\n" + "\n".join(rows) + "\n")
    got = [r["record"] for r in split_csv.read_records(spark, folder).orderBy("number").collect()]
    assert got == ["h,t", *rows]


def test_a_split_is_ordered_in_pieces(spark, tmp_path, monkeypatch):
    """No group of lines that one task sorts is larger than a piece, however large the split; records cross pieces."""
    monkeypatch.setattr(split_csv, "PIECE_LINES", 7)
    rows = [f'{i},"{"y" * (i % 50)}' + "\n" * (i % 19) + f'{i}"' for i in range(300)]
    folder = one_file(tmp_path, "h,t\n" + "\n".join(rows) + "\n")
    lines = split_csv._lines(spark, folder)
    assert lines.rdd.getNumPartitions() < 10 and lines.groupBy("file", "split").count().agg({"count": "max"}).first()[0] == 7
    got = [r["record"] for r in split_csv.read_records(spark, folder).orderBy("number").collect()]
    assert got == ["h,t", *rows]


def test_versions_replace_add_and_refuse(spark):
    root = scratch_path(spark, "table")

    def frame(rows):
        return spark.createDataFrame(rows, "k long, v string")

    def held(**how):
        return sorted((tuple(r) for r in versions.read(spark, root, key="k", **how).collect()), key=str)

    with pytest.raises(ValueError):
        versions.read(spark, root)
    assert versions.commit(frame([(1, "a"), (2, "b"), (None, "n")]), root, replace=True) == 1
    assert versions.upsert(frame([(2, "B"), (3, "c"), (3, "d"), (None, "m")]), root, "k") == 2
    assert held() == sorted([(1, "a"), (2, "B"), (3, "d"), (None, "m")], key=str)
    assert held(version=1) == sorted([(1, "a"), (2, "b"), (None, "n")], key=str)
    # Two writers that saw version 2: the second is told so, and the table is the first one's.
    assert versions.commit(frame([(9, "z")]), root, replace=True, seen=2) == 3
    with pytest.raises(versions.Conflict):
        versions.commit(frame([(8, "y")]), root, replace=True, seen=2)
    assert held() == [(9, "z")]


def test_a_writer_that_fails_leaves_the_table(spark):
    root = scratch_path(spark, "table")
    versions.commit(spark.range(10).withColumnRenamed("id", "k"), root, replace=True)
    bad = spark.range(10).select(F.raise_error(F.lit("stop")).cast("long").alias("k"))
    with pytest.raises(Exception, match="stop"):
        versions.commit(bad, root, replace=True)
    assert versions.latest(spark, root) == 1 and versions.read(spark, root).count() == 10


def test_upserts_are_compacted_and_old_versions_go(spark):
    root, expected = scratch_path(spark, "table"), {}
    rng = random.Random(5)
    for batch in range(7):
        rows = {rng.randint(0, 30): f"{batch}-{i}" for i in range(12)}
        expected.update(rows)
        for _ in range(2):  # a replayed batch is in the log already
            versions.upsert(spark.createDataFrame(list(rows.items()), "k long, v string").coalesce(1), root, "k", mark=("job", batch), compact_after=4)
    assert {r["k"]: r["v"] for r in versions.read(spark, root, key="k").collect()} == expected
    assert len(versions.manifest(spark, root)["folders"]) <= 4
    assert versions.vacuum(spark, root, keep=1) > 0
    assert {r["k"]: r["v"] for r in versions.read(spark, root, key="k").collect()} == expected


T0 = datetime.datetime(2024, 3, 1, 12)


def test_late_rows_are_counted_apart_and_state_stays_small(spark):
    """Batches of a day each, with rows up to three days late; a row is late when its day ended before the watermark."""
    rng, root = random.Random(7), scratch_path(spark, "days")
    kind = "user_id long, ts timestamp"
    total, late, seen, states = {}, {}, None, []
    for batch in range(6):
        rows = [(rng.choice([1, 2, None]), T0 + datetime.timedelta(days=batch - rng.choice([0, 0, 1, 3]), minutes=rng.randint(0, 600))) for _ in range(60)]
        rows.append((5, None))
        for user, ts in rows[:-1]:
            key = (user, ts.date())
            total[key] = total.get(key, 0) + 1
            ends = datetime.datetime.combine(ts.date() + datetime.timedelta(days=1), datetime.time())
            if seen and ends <= seen - datetime.timedelta(days=1):
                late[key] = late.get(key, 0) + 1
        seen = max([t for _, t in rows[:-1]] + ([seen] if seen else []))
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{root}/in")
        q = day_windows.run(lambda: spark.readStream.schema(kind).parquet(f"{root}/in"), root, "1 day")
        states += [s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]]
    got = {(r["user_id"], r["day"]): r for r in day_windows.read(spark, root).collect()}
    assert {k: r["n"] for k, r in got.items()} == total
    assert late and {k: r["n_late"] for k, r in got.items() if r["n_late"]} == late
    assert max(states) <= 3 * 6  # users by open days, however many days have passed
    # The same input again: nothing new has arrived, and nothing changes.
    day_windows.run(lambda: spark.readStream.schema(kind).parquet(f"{root}/in"), root, "1 day")
    assert {(r["user_id"], r["day"]): r for r in day_windows.read(spark, root).collect()} == got
