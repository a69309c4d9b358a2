import pytest

from tracklane.plans.player_actions import OUTPUT, player_actions
from tracklane.sources.event_codes import with_message_type

SCHEMA = (
    "eventnum double, eventmsgtype double, eventmsgactiontype double, homedescription string, "
    "visitordescription string, player1_id double, player2_id double, player3_id double, "
    "pctimestring string, gameid string"
)
CODES = [
    (1, "free throw made", 11, "free throw 1 of 2"), (2, "free throw missed", 11, "free throw 1 of 2"),
    (1, "free throw made", 18, "free throw flagrant 1 of 2"),
    (1, "free throw made", 16, "free throw technical"),
    (1, "free throw made", 17, "free throw clear path"),
    (3, "field goal made", 42, "driving layup shot"), (3, "field goal made", 1, "not used"),
    (4, "field goal missed", 42, "driving layup shot"),
    (5, "offensive rebound", 1, "placeholder"), (6, "defensive rebound", 1, "placeholder"),
    (7, "turnover", 1, "bad pass"), (7, "turnover", 3, "out of bounds"),
    (8, "foul", 2, "shooting"),
    (9, "violation", 1, "delay of game"),
    (10, "substitution", None, None), (12, "jump ball", None, None), (14, "start period", None, None),
    (24, "blocked shot", None, None),
]


@pytest.fixture(scope="module")
def codes(spark):
    return spark.createDataFrame(
        CODES, "event_code int, event_action string, event_subcode int, event_subaction string"
    )


def events(spark, *raw):
    df = spark.createDataFrame([(float(i), *r) for i, r in enumerate(raw)], SCHEMA)
    from pyspark.sql import functions as F

    extra = {"season": F.lit("2015-2016"), "period": F.lit(1.0), "wctimestring": F.lit("20:15:00")}
    for i in (1, 2, 3):
        extra |= {
            f"player{i}_name": F.lit(f"p{i}"), f"player{i}_team_id": F.lit(float(i)),
            f"player{i}_team_city": F.lit("c"), f"player{i}_team_abbreviation": F.lit("A"),
        }
    return df.withColumns(extra)


def actions(spark, codes, rows, *raw):
    padded = [(*r, *[None] * (8 - len(r))) for r in raw]
    padded = [(*r[:7], r[7] or "9:42", "0021500001") for r in padded]
    found = player_actions(events(spark, *padded), codes)
    assert found.columns == OUTPUT
    return rows(
        found, "eventmsgtype", "eventmsgactiontype", "event_action", "event_subaction",
        "event_subsubaction", "playerid", "playername",
    )


def test_shots(spark, codes, rows):
    got = actions(
        spark, codes, rows,
        (1.0, 1.0, "A 3PT Jump Shot (B 1 AST)", None, 1.0, 2.0),   # listed, assisted
        (1.0, 42.0, None, "A Layup", 1.0),                         # dictionary only
        (1.0, 77.0, None, "A 3PT Shot", 1.0),                      # in neither
        (1.0, None, "A shot", None, 1.0),                          # no action code: dropped
        (2.0, 102.0, "MISS A", None, 1.0),
        (1.0, 102.0, "A", "x 3PT y", 1.0),
        (2.0, 109.0, "MISS A", None, 1.0),
    )
    made, missed = "field goal made", "field goal missed"
    assert got == [
        (1.0, 1.0, made, "jump shot", "3pt made", 1.0, "p1"),
        (1.0, 42.0, made, "driving layup shot", "2pt made", 1.0, "p1"),
        (1.0, 77.0, None, None, "3pt made", 1.0, "p1"),
        (1.0, 102.0, made, "driving floating bank jump shot", "3pt made", 1.0, "p1"),
        (2.0, 102.0, missed, "driving bank jump shot", "2pt missed", 1.0, "p1"),
        (2.0, 109.0, missed, "driving reverse dunk shot", "2pt missed", 1.0, "p1"),
        (25.0, None, "assist", None, None, 2.0, "p2"),
    ]


def test_free_throws_and_rebounds(spark, codes, rows):
    got = actions(
        spark, codes, rows,
        (3.0, 11.0, None, "A Free Throw 1 of 2", 1.0),
        (3.0, 11.0, "MISS A Free Throw", None, 1.0),
        (3.0, 18.0, "A", None, 1.0), (3.0, 16.0, "A", None, 1.0), (3.0, 17.0, "A", None, 1.0),
        (3.0, 99.0, "A", None, 1.0),   # unknown code: dropped
        (4.0, 0.0, "A REBOUND", None, 1.0),
    )
    assert got == [
        (3.0, 11.0, "free throw made", "free throw 1 of 2", None, 1.0, "p1"),
        (3.0, 11.0, "free throw missed", "free throw 1 of 2", None, 1.0, "p1"),
        (3.0, 16.0, "free throw made", "free throw technical", "technical", 1.0, "p1"),
        (3.0, 17.0, "free throw made", "free throw clear path", "clear path", 1.0, "p1"),
        (3.0, 18.0, "free throw made", "free throw flagrant 1 of 2", "flagrant", 1.0, "p1"),
        (4.0, 0.0, "rebound", "placeholder", None, 1.0, "p1"),
    ]


def test_turnovers_and_fouls(spark, codes, rows):
    got = actions(
        spark, codes, rows,
        (5.0, 1.0, "A STEAL (1 STL)", "B Bad Pass", 1.0, 2.0),
        (5.0, 40.0, "A Turnover", None, 1.0),
        (5.0, 50.0, "A Turnover", None, 1.0),
        (5.0, None, "A Turnover", None, 1.0),
        (6.0, 2.0, "A FOUL", None, 1.0, None),
        (6.0, 2.0, "A FOUL", None, 3.0, 0.0),
    )
    assert got == [
        (5.0, 1.0, "steal", "bad pass", None, 2.0, "p2"),
        (5.0, 1.0, "turnover", "bad pass", None, 1.0, "p1"),
        (5.0, 40.0, "turnover", "out of bounds", None, 1.0, "p1"),
        (5.0, 50.0, None, None, None, 1.0, "p1"),
        (6.0, 2.0, "foul", "shooting", "committed fouled", 1.0, "p1"),
        (6.0, 2.0, "foul", "shooting", "committed fouled", 3.0, "p1"),
        (6.0, 2.0, "foul", "shooting", "got fouled", 0.0, "p2"),
    ]


def test_substitutions_jump_balls_and_the_rest(spark, codes, rows):
    got = actions(
        spark, codes, rows,
        (8.0, 0.0, "SUB", None, 1.0, 2.0), (8.0, 0.0, "SUB", None, 4.0, None),
        (10.0, 0.0, "Jump", None, 1.0, 2.0, 3.0),
        (7.0, 1.0, "delay", None, 1.0), (7.0, 5.0, "?", None, 1.0), (12.0, 0.0, None, None, 0.0),
        (None, 1.0, "no type", None, 1.0),
    )
    assert got == [
        (7.0, 1.0, "violation", "delay of game", None, 1.0, "p1"),
        (7.0, 5.0, None, None, None, 1.0, "p1"),
        (8.0, 0.0, "substitution", None, "subbed in", 2.0, "p2"),
        (8.0, 0.0, "substitution", None, "subbed out", 1.0, "p1"),
        (8.0, 0.0, "substitution", None, "subbed out", 4.0, "p1"),
        (10.0, 0.0, "jump ball", None, None, 1.0, "p1"),
        (10.0, 0.0, "jump ball", None, None, 2.0, "p2"),
        (10.0, 0.0, "jump ball", None, "jump ball tip", 3.0, "p3"),
        (12.0, 0.0, None, None, None, 0.0, "p1"),
    ]


def test_description_home_flag_and_clock(spark, codes, rows):
    df = player_actions(
        events(
            spark,
            (12.0, 0.0, "home", "visitor", 1.0, None, None, "12:00", "0021500001"),
            (12.0, 0.0, None, "visitor", 0.0, None, None, "bad", "0021500002"),
            (12.0, 0.0, None, None, None, None, None, None, "0021500003"),
        ),
        codes,
    )
    assert rows(df, "gameid", "description", "is_home", "period_time") == [
        ("0021500001", "home", 1, 720), ("0021500002", "visitor", 0, None),
        ("0021500003", None, 0, None),
    ]
    raw = events(
        spark,
        (12.0, 0.0, "home", None, 1.0, None, None, None, "0021500001"),
        (12.0, 0.0, "home", None, 0.0, None, None, None, "0021500002"),
        (12.0, 0.0, "home", None, None, None, None, None, "0021500003"),
    )
    assert rows(player_actions(raw, codes, drop_zero_ids=True), "gameid") == [
        ("0021500001",), ("0021500003",),
    ]
    assert rows(player_actions(raw, codes, "2015-2016", (21500002, 21500003)), "gameid") == [
        ("0021500002",), ("0021500003",),
    ]
    assert rows(player_actions(raw, codes, "2014-2015"), "gameid") == []


def test_message_types(spark, codes, rows):
    typed = with_message_type(codes).select("event_code", "eventmsgtype").distinct()
    assert (24, None) in rows(typed) and (14, 12) in rows(typed) and (2, 3) in rows(typed)
