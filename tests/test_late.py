import datetime as dt

from riskspark.streaming import file_stream
from riskspark.streaming.late import quarantine_late, read_late, split_batch

KIND = "ts timestamp, application_id string, p_default double"


def _at(day, hour=0):
    return dt.datetime(2026, 3, day, hour)


FILES = [
    [(_at(1), "a", 0.1), (_at(5), "b", 0.2), (_at(5), "b", 0.2), (None, "c", 0.3), (_at(5), None, 0.1), (_at(5), None, 0.1)],
    [(_at(2), "d", 0.4), (_at(4, 1), "e", 0.5), (_at(5), "b", 0.2), (_at(1), "a", 0.1), (_at(9), "f", 0.6), (_at(8), "f", 0.7)],
    [(_at(8, 12), "g", 0.8), (_at(7), "h", 0.9)],
]


def _state(out):
    rows = {k: sorted(map(tuple, v.collect()), key=repr) for k, v in out.items()}
    total = len(rows["rows"]) + len(rows["late"]) + sum(r[1] for r in rows["repeats"])
    return rows, total


def _want():
    return sum(len(f) for f in FILES)


def test_every_row_is_counted_late_or_a_repeat(spark, tmp_path):
    path, schema = str(tmp_path / "feed"), spark.createDataFrame([], KIND).schema
    for f in FILES:
        spark.createDataFrame(f, KIND).coalesce(1).write.mode("append").parquet(path)
    stream = file_stream(spark, path, schema, max_files_per_trigger=1)
    rows, total = _state(quarantine_late(stream, str(tmp_path / "out"), str(tmp_path / "check")))
    assert total == _want()
    assert sorted((r[1], r[3]) for r in rows["late"]) == [("a", "late"), ("c", "no_time"), ("d", "late"), ("h", "late")]
    assert sorted((r[1] or "", r[0].day) for r in rows["rows"]) == [("", 5), ("", 5), ("a", 1), ("b", 5), ("e", 4), ("f", 8), ("g", 8)]
    assert sorted(rows["repeats"]) == [("b", 1), ("b", 1), ("f", 1)]


def test_a_batch_delivered_again_changes_nothing(spark, tmp_path):
    path, schema = str(tmp_path / "out"), spark.createDataFrame([], KIND).schema
    assert _state(read_late(spark, path, schema))[1] == 0
    for i, f in enumerate(FILES):
        split_batch(spark.createDataFrame(f, KIND), i, path)
    before = _state(read_late(spark, path, schema))
    assert before[1] == _want()
    for i in (1, 2):
        split_batch(spark.createDataFrame(FILES[i], KIND), i, path)
    split_batch(spark.createDataFrame([], KIND), 3, path)
    assert _state(read_late(spark, path, schema)) == before
