import datetime as dt

import pytest
from pyspark.sql import functions as F

from ebbtide.functions.filters import LogFilter, with_user
from ebbtide.functions.timestamps import (
    INTERVALS,
    as_utc,
    time_bucket,
    timestamp_literal,
    with_timestamps,
)
from ebbtide.functions.user_agent import DEFAULT_RULES, Family, Rules, with_user_agent
from tests.helpers import log, raw


def agents(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "userAgent string")


def test_timestamps(spark):
    row = with_timestamps(raw(spark, [{"ts": 1538352117000.0}])).first()
    assert row.timestamp == dt.datetime(2018, 10, 1, 0, 1, 57)
    assert row.date == dt.date(2018, 10, 1)
    assert row.registration_timestamp is None


def test_unusable_times_are_null(spark):
    df = with_timestamps(
        raw(spark, [{"ts": float("nan")}, {"ts": 1e18}, {"ts": None}, {"ts": -1.0}])
    )
    stamps = [r.timestamp for r in df.collect()]
    assert stamps[:3] == [None, None, None]
    assert stamps[3] == dt.datetime(1969, 12, 31, 23, 59, 59, 999000)
    assert df.collect()[3].date == dt.date(1969, 12, 31)


def test_fraction_of_a_millisecond_is_kept(spark):
    row = with_timestamps(raw(spark, [{"ts": 1538352117000.5}])).first()
    assert row.timestamp.microsecond == 500


@pytest.mark.parametrize("interval", INTERVALS)
def test_buckets_are_epoch_aligned(spark, interval):
    seconds = {"m": 60, "h": 3600, "d": 86400}[interval[-1]] * int(interval[:-1])
    df = spark.range(0, 40_000_000, 777_777).select(
        F.col("id").alias("s"), F.timestamp_seconds(F.col("id") + 1_538_352_117).alias("t")
    )
    start = F.unix_seconds(time_bucket(F.col("t"), interval))
    floor = F.floor(F.unix_seconds("t") / seconds) * seconds
    assert df.where(start != floor).count() == 0


def test_unknown_interval(spark):
    with pytest.raises(ValueError):
        time_bucket(F.col("t"), "2d")


def test_literals_are_utc(spark):
    east = dt.timezone(dt.timedelta(hours=2))
    assert as_utc(dt.datetime(2018, 10, 1, 2, tzinfo=east)) == as_utc("2018-10-01")
    got = spark.range(1).select(timestamp_literal("2018-10-01T02:00:00+02:00").alias("t")).first().t
    assert got == dt.datetime(2018, 10, 1)


@pytest.mark.parametrize(
    "agent, browser, version, system, os_version, device",
    [
        ("Mozilla/5.0 (Windows NT 6.1; WOW64) AppleWebKit/537.36 Chrome/36.0.1985.143 Safari/537.36",
         "Chrome", "36.0.1985.143", "Windows", "6.1", "pc"),
        ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9_4) AppleWebKit/537.77.4 Version/7.0.5 Safari/537.77.4",
         "Safari", "7.0.5", "Mac OS X", "10.9.4", "pc"),
        ("Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 Chrome/120.0.0.0 Safari/537.36 Edg/120.0.2210.91",
         "Edge", "120.0.2210.91", "Windows", "10.0", "pc"),
        ("Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 Chrome/119.0.0.0 Safari/537.36 OPR/105.0.0.0",
         "Opera", "105.0.0.0", "Windows", "10.0", "pc"),
        ("Opera/9.80 (Windows NT 6.1; U; en) Presto/2.8.131 Version/11.11", "Opera", "11.11", "Windows", "6.1", "pc"),
        ("Mozilla/5.0 (X11; CrOS x86_64 14541.0.0) AppleWebKit/537.36 Chrome/120.0.0.0 Safari/537.36",
         "Chrome", "120.0.0.0", "Chrome OS", "", "pc"),
        ("4.5 Trident/7.0", "IE", "", "Other", "", None),
        ("Mozilla/5.0 (Windows NT 6.1; rv:31.0) Gecko/20100101 Firefox/31.0",
         "Firefox", "31.0", "Windows", "6.1", "pc"),
        ("Mozilla/5.0 (Windows NT 6.1; WOW64; Trident/7.0; rv:11.0) like Gecko",
         "IE", "11.0", "Windows", "6.1", "pc"),
        ("Mozilla/5.0 (compatible; MSIE 9.0; Windows NT 6.1; Trident/5.0)",
         "IE", "9.0", "Windows", "6.1", "pc"),
        ("Mozilla/5.0 (iPhone; CPU iPhone OS 7_1_2 like Mac OS X) Version/7.0 Mobile/11D257 Safari/9537.53",
         "Mobile Safari", "7.0", "iOS", "7.1.2", "mobile"),
        ("Mozilla/5.0 (iPad; CPU OS 7_1_2 like Mac OS X) CriOS/36.0 Mobile/11D257 Safari/9537.53",
         "Chrome Mobile iOS", "36.0", "iOS", "7.1.2", "tablet"),
        ("Mozilla/5.0 (Linux; Android 4.4.2; Nexus 5) Chrome/36.0.1985.131 Mobile Safari/537.36",
         "Chrome Mobile", "36.0.1985.131", "Android", "4.4.2", "mobile"),
        ("Mozilla/5.0 (Linux; Android 4.4.2; Nexus 7) Chrome/36.0.1985.131 Safari/537.36",
         "Chrome", "36.0.1985.131", "Android", "4.4.2", "tablet"),
        ("Mozilla/5.0 (X11; Linux x86_64) Chrome/36.0 Safari/537.36", "Chrome", "36.0", "Linux", "", "pc"),
        ("curl/7.88", "Other", "", "Other", "", None),
    ],
)
def test_user_agents(spark, agent, browser, version, system, os_version, device):
    row = with_user_agent(agents(spark, agent)).first()
    assert (row.userAgent_browser_family, row.userAgent_browser_version) == (browser, version)
    assert (row.userAgent_os_family, row.userAgent_os_version) == (system, os_version)
    flags = (row.userAgent_is_mobile, row.userAgent_is_pc, row.userAgent_is_tablet)
    assert flags == (device == "mobile", device == "pc", device == "tablet")


def test_unknown_user_agent_is_null(spark):
    for row in with_user_agent(agents(spark, None, "")).collect():
        assert list(row)[1:] == [None] * 7


def test_long_versions_are_whole(spark):
    version, system = ".".join(["1234"] * 12), "_".join(["7"] * 40)
    agent = f"Mozilla/5.0 (Macintosh; Intel Mac OS X {system}) Chrome/{version} Safari/537.36"
    row = with_user_agent(agents(spark, agent)).first()
    assert (row.userAgent_browser_version, row.userAgent_os_version) == (version, system.replace("_", "."))


def test_own_rules(spark):
    rules = Rules((Family("Curl", ("curl/",), marker="curl/"),), DEFAULT_RULES.systems)
    row = with_user_agent(agents(spark, "curl/7.88"), rules).first()
    assert (row.userAgent_browser_family, row.userAgent_browser_version) == ("Curl", "7.88")


def test_generated_code_stays_within_the_jit_limit(spark):
    """Methods over 8000 bytes are never compiled by the JVM."""
    df = with_user_agent(with_timestamps(raw(spark, [{}])))
    module = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    stages = getattr(module, "MODULE$").codegenStringSeq(df._jdf.queryExecution().executedPlan())
    for i in range(stages.size()):
        assert stages.apply(i)._3().maxMethodCodeSize() < 8000


def test_all_leaves_null_out(spark):
    df = log(spark, [{}, {"method": None}, {"method": "PUT"}])
    assert LogFilter().apply(df).count() == 2
    assert LogFilter(method=["PUT", "POST"]).apply(df).count() == 1
    assert LogFilter(status=[404]).apply(df).count() == 0


def test_time_range_includes_both_ends(spark):
    df = log(spark, [{"ts": 1538352000000.0}, {"ts": 1538352001000.0}, {"ts": 1538352001001.0}])
    chosen = LogFilter(start="2018-10-01T00:00:00Z", end="2018-10-01T00:00:01Z").apply(df)
    assert chosen.count() == 2


def test_user_filter(spark):
    df = log(spark, [{"userId": None}, {"userId": ""}, {"userId": " "}, {"userId": "7"}])
    assert with_user(df).count() == 3
    assert [r.userId for r in with_user(df, drop_blank=True).collect()] == ["7"]


def test_rule_texts_are_quoted(spark):
    rules = Rules((Family("It's", ("o'b\\c",), marker="c/"),), DEFAULT_RULES.systems)
    row = with_user_agent(agents(spark, "o'b\\c/1.2"), rules).first()
    assert (row.userAgent_browser_family, row.userAgent_browser_version) == ("It's", "1.2")
