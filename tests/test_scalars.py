import pytest
from pyspark.sql import functions as F

from tracklane import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("v")).head()["v"]


@pytest.mark.parametrize(
    "text, seconds",
    [("10:19", 619), ("5:00", 300), ("0:07", 7), ("bad", None), ("5", None), (":", None),
     ("a:10", None), (None, None)],
)
def test_clock_seconds(spark, text, seconds):
    assert one(spark, fn.clock_seconds(F.lit(text).cast("string"))) == seconds


@pytest.mark.parametrize(
    "text, result",
    [("8:15 PM", "20:15:00"), ("12:00 AM", "00:00:00"), ("12:30 PM", "12:30:00"),
     ("25:00 PM", None), (None, None)],
)
def test_wall_clock(spark, text, result):
    assert one(spark, fn.wall_clock_24h(F.lit(text).cast("string"))) == result


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_epoch_text_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, fn.epoch_ms_text(F.lit(1446300000007))) == "2015-10-31 14:00:00Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_seasons_dates_and_teams(spark):
    assert one(spark, fn.season_long(F.lit("2015-16"))) == "2015-2016"
    assert one(spark, fn.season_short(F.lit("2015-2016/01.01.2016.A.at.B.7z"))) == "2015-16"
    assert one(spark, fn.compact_date(F.lit("2015-10-27"))) == "20151027"
    assert one(spark, fn.us_date(F.lit("2015-10-27"))) == "10/27/2015"
    assert one(spark, F.struct(*fn.matchup_teams(F.lit("DET @ ATL")))) == ("DET", "ATL")
    assert one(spark, F.struct(*fn.matchup_teams(F.lit("ATL vs. DET")))) == ("ATL", "DET")
    path = F.lit("closest_to_ball/season=2015-2016/gameid=0021500001/x.parquet")
    assert one(spark, fn.path_value(path, "season")) == "2015-2016"
    assert one(spark, fn.path_value(path, "gameid")) == "0021500001"
    assert one(spark, fn.path_value(path, "team")) is None


def test_score_minutes_and_side(spark):
    assert one(spark, F.struct(*fn.score_pair(F.lit("2-4")))) == (2, 4)
    assert one(spark, F.struct(*fn.score_pair(F.lit("12 - 4")))) == (12, 4)
    assert one(spark, F.struct(*fn.score_pair(F.lit(None).cast("string")))) == (None, None)
    assert one(spark, fn.minutes_text(F.lit("32:44"))) == "32.44"
    assert [one(spark, fn.court_side(F.lit(x))) for x in (46.9, 47.0, 47.1)] == [
        "left", None, "right",
    ]
