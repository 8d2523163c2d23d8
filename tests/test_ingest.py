import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.plans.ingest import enrich, ingest
from ebbtide.schema import LAKE_SCHEMA, LOG_SCHEMA, RAW_SCHEMA
from ebbtide.sources.jdbc import column_types, fitting, serving_columns
from ebbtide.sources.json_log import read_log_json, split_bad_records
from ebbtide.sources.lake import read_lake, register_views, write_lake
from ebbtide.streaming.ingest import ingest_stream
from tests.helpers import CHROME, DAY_MS, START_MS, log

GOOD = {"ts": START_MS + 117_000, "userId": "31", "page": "Home", "userAgent": CHROME, "length": 1.5}


def lines(folder, *rows, name="part.json"):
    folder.mkdir(parents=True, exist_ok=True)
    text = "\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows)
    (folder / name).write_text(text + "\n")
    return str(folder)


def day(n, **fields):
    return GOOD | {"ts": START_MS + n * DAY_MS} | fields


def test_bad_lines_are_split_off(spark, tmp_path):
    path = lines(
        tmp_path / "in",
        GOOD,
        "not json",
        {"userId": "31", "page": "Home"},
        {"other": 1},
        GOOD | {"extra": 1},
        {"ts": 1538352118000, "userId": "", "sessionId": "x"},
        GOOD | {"ts": 1e18},
        GOOD | {"registration": 1e18},
    )
    good, bad = split_bad_records(read_log_json(spark, path))
    assert good.count() == 2
    assert good.select("page").count() == good.select("ts", "userId").distinct().count() * 2
    assert good.columns == RAW_SCHEMA.names
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["empty", "malformed", "malformed", "missing ts", "unusable registration", "unusable ts"]
    # Every bad line is kept as it was, extra keys included.
    assert {"not json", json.dumps({"other": 1}), json.dumps(GOOD | {"ts": 1e18})} <= {r.line for r in bad.collect()}


def test_absent_fields_are_null(spark, tmp_path):
    row = read_log_json(spark, lines(tmp_path / "in", {"ts": 1})).first()
    assert row.artist is None and row.ts == 1.0


def test_missing_source_is_fatal(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_log_json(spark, str(tmp_path / "nowhere"))


def test_ingest_quarantines_and_counts(spark, tmp_path):
    source = lines(tmp_path / "in", day(0), day(1), "not json", {"page": "Home"})
    lake, bad = str(tmp_path / "lake"), str(tmp_path / "bad")
    assert ingest(spark, source, lake, quarantine=bad, stripe_size=64 * 1024) == 2
    assert ingest(spark, source, lake, quarantine=bad) == 2
    assert spark.read.json(bad).count() == 4
    assert ingest(spark, lines(tmp_path / "good", day(1)), lake, quarantine=bad) == 0
    assert ingest(spark, source, lake) is None
    df = read_lake(spark, lake)
    assert df.schema.names == LAKE_SCHEMA.names
    assert {r.date for r in df.collect()} == {dt.date(2018, 10, 1), dt.date(2018, 10, 2)}
    assert df.first().userAgent_browser_family == "Chrome"


def test_repeated_ingest_replaces_only_its_days(spark, tmp_path):
    lake = str(tmp_path / "lake")
    ingest(spark, lines(tmp_path / "a", day(0), day(1)), lake)
    ingest(spark, lines(tmp_path / "b", day(1, page="Help"), day(1, page="Help")), lake)
    ingest(spark, lines(tmp_path / "b", day(1, page="Help"), day(1, page="Help")), lake)
    pages = sorted(r.page for r in read_lake(spark, lake).collect())
    assert pages == ["Help", "Help", "Home"]


def test_date_ranges(spark, tmp_path):
    lake = str(tmp_path / "lake")
    write_lake(log(spark, [{"ts": float(START_MS + n * DAY_MS)} for n in (0, 1, 3)]), lake)
    assert read_lake(spark, lake, "2018-10-01", "2018-10-03").count() == 2
    assert read_lake(spark, lake, "2018-10-01", "2018-10-01").count() == 0
    # 3 October is absent.
    assert read_lake(spark, lake, "2018-10-02", "2018-10-05").count() == 2
    assert read_lake(spark, lake, start="2018-10-04").count() == 1
    assert read_lake(spark, lake, end="2018-10-04").count() == 2


def test_large_day_is_split_over_files(spark, tmp_path):
    """A day with almost all rows must not be written by one task."""
    lake = tmp_path / "lake"
    rows = spark.range(0, 60_000, 1, 8).select(
        (F.lit(float(START_MS)) + F.when(F.col("id") % 50 == 0, DAY_MS).otherwise(0)).alias("ts"),
        F.md5(F.col("id").cast("string")).alias("song"),
    )
    missing = [f for f in LOG_SCHEMA.fields if f.name not in ("ts", "song")]
    df = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "256k")
    try:
        write_lake(enrich(df), str(lake))
    finally:
        spark.conf.set(size, before)
    assert len(list((lake / "date=2018-10-01").glob("*.orc"))) > 3
    assert len(list((lake / "date=2018-10-02").glob("*.orc"))) == 1
    assert read_lake(spark, str(lake)).count() == 60_000


def test_view(spark):
    register_views(spark, log(spark, [{}, {}]), "test_logs")
    assert spark.sql("SELECT count(*) AS n FROM test_logs WHERE page = 'Home'").first().n == 2


def test_serving_table_columns(spark):
    df = serving_columns(log(spark, [{}]))
    assert df.columns == LOG_SCHEMA.names
    types = dict(df.dtypes)
    assert types["ts"] == "decimal(20,3)" and types["status"] == "decimal(20,0)"
    assert types["userAgent_is_pc"] == "string" and df.first().userAgent_is_pc == "true"
    declared = T.StructType.fromDDL(column_types())
    assert set(declared.names) <= set(df.columns)
    assert all(types[name] == "string" for name in declared.names)


def test_rows_that_are_too_wide_are_set_aside(spark):
    df = log(spark, [{}, {"userAgent": "x" * 151}, {"gender": "MF"}, {"userAgent": "x" * 150}])
    good, wide = fitting(df)
    assert good.count() == 2 and sorted(r.column for r in wide.collect()) == ["gender", "userAgent"]


def test_stream_files_do_not_grow_with_tasks(spark, tmp_path):
    for n in range(12):
        lines(tmp_path / "in", *[day(0, userId=str(k)) for k in range(20)], name=f"{n}.json")
    ingest_stream(spark, str(tmp_path / "in"), str(tmp_path / "lake"), str(tmp_path / "c")).awaitTermination()
    assert len(list((tmp_path / "lake" / "date=2018-10-01").glob("*.orc"))) <= 2
    assert read_lake(spark, str(tmp_path / "lake")).count() == 240


def test_stream_takes_each_file_once(spark, tmp_path):
    source, lake, bad = (str(tmp_path / n) for n in ("in", "lake", "bad"))

    def run():
        ingest_stream(spark, source, lake, str(tmp_path / "checkpoint"), bad, 1).awaitTermination()
        return read_lake(spark, lake).count(), spark.read.json(bad).count()

    lines(tmp_path / "in", day(0), day(1), "not json", name="a.json")
    assert run() == (2, 1)
    assert run() == (2, 1)
    lines(tmp_path / "in", day(2), {"page": "Home"}, name="b.json")
    assert run() == (3, 2)


def test_repeated_batch_adds_nothing(spark, tmp_path):
    """The commit of the last batch is lost, as when the driver dies between writing and committing."""
    source, lake, bad, checkpoint = (str(tmp_path / n) for n in ("in", "lake", "bad", "checkpoint"))

    def run():
        ingest_stream(spark, source, lake, checkpoint, bad, 1).awaitTermination()
        return sorted(r.page for r in read_lake(spark, lake).collect()), spark.read.json(bad).count()

    lines(tmp_path / "in", day(0), day(1, page="Help"), "not json", name="a.json")
    run()
    lines(tmp_path / "in", day(1, page="About"), "nor this", name="b.json")
    first = run()
    assert first == (["About", "Help", "Home"], 2)
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink()
    # What a cut-off run may have left: more files of that batch than it writes this time.
    left = next((tmp_path / "lake" / "date=2018-10-02").glob("stream-000000001-*.orc"))
    (left.parent / "stream-000000001-00007.orc").write_bytes(left.read_bytes())
    assert run() == first
    assert not list((tmp_path / "lake").glob("_staged*"))


def test_batch_ingest_may_replace_days_of_a_stream(spark, tmp_path):
    lake = str(tmp_path / "lake")
    source = lines(tmp_path / "in", day(0), day(1))
    ingest_stream(spark, source, lake, str(tmp_path / "c")).awaitTermination()
    ingest(spark, lines(tmp_path / "again", day(1, page="Help")), lake)
    assert sorted(r.page for r in read_lake(spark, lake).collect()) == ["Help", "Home"]


def test_ingest_reads_and_parses_once(spark, tmp_path, monkeypatch):
    """With a quarantine: one scan of the text, and nothing left behind."""
    from ebbtide.plans import ingest as plan

    source = lines(tmp_path / "in", day(0), day(0, page="Help"), "not json")
    scans, original = [], plan.stage

    def counted(rows, path, stripe_size=None):
        scans.append(rows._jdf.queryExecution().optimizedPlan().toString().count("Relation"))
        original(rows, path, stripe_size)

    monkeypatch.setattr(plan, "stage", counted)
    monkeypatch.setattr(plan, "write_lake", None)  # not on this path
    assert ingest(spark, source, str(tmp_path / "lake"), str(tmp_path / "bad")) == 1
    assert scans == [1] and sorted(f.name for f in (tmp_path / "lake").iterdir() if f.is_dir()) == ["date=2018-10-01"]
    assert read_lake(spark, str(tmp_path / "lake")).count() == 2


def test_only_bad_lines_leave_the_lake_alone(spark, tmp_path):
    lake, bad = str(tmp_path / "lake"), str(tmp_path / "bad")
    ingest(spark, lines(tmp_path / "a", day(0)), lake, bad)
    assert ingest(spark, lines(tmp_path / "b", "x", "y"), lake, bad) == 2
    assert read_lake(spark, lake).count() == 1 and spark.read.json(bad).count() == 2
