"""One query per operator: Spark on the left, the comparing SQL on the right.

``QUERIES`` maps a name to a function of (spark, sf_dir); ``SQL`` maps the same
name to a statement over tables registered under their own names. The SQL is
written on its own terms (self-joins, unions, correlated counts) and shares only
the adapters with the Spark side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import documents
from checks.adapters import (
    CODES,
    FLAGS,
    GAME_LOG,
    LEGACY_POSITIONS,
    PLAY_BY_PLAY,
    PLAY_BY_PLAY_12H,
    POSITIONS,
    POSITIONS_REPEATED,
    adapt,
    plain,
    table,
)
from tracklane.functions import (
    clock_seconds,
    compact_date,
    epoch_ms_text,
    matchup_teams,
    score_pair,
    season_long,
    season_short,
    us_date,
    wall_clock_24h,
)
from tracklane.operators.firsts import nearest_in_group
from tracklane.operators.keyed import (
    append_distinct,
    append_manifest,
    dedupe_by_key,
    insert_ignore,
    pending,
    upsert_manifest,
)
from tracklane.plans import closest, loads, shooting_side
from tracklane.plans.player_actions import player_actions
from tracklane.session import scratch_path
from tracklane.sources import event_codes, legacy, readers, result_sets, schemas, tracking, writers

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def _with(**parts: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({plain(text)})" for name, text in parts.items())


# Distance to the ball ----------------------------------------------------------

_KEYS = "season, gameid, eventid, moment_num"
_FAR = f"""
, far AS (
    SELECT p.*, (p.x_coordinate - b.x) * (p.x_coordinate - b.x)
              + (p.y_coordinate - b.y) * (p.y_coordinate - b.y) AS distance_from_ball_sq
    FROM positions AS p
    LEFT JOIN (SELECT {_KEYS}, x_coordinate AS x, y_coordinate AS y
               FROM positions WHERE playerid = -1) AS b
    USING ({_KEYS})
)
"""


@_query(_with(positions=POSITIONS) + _FAR + "SELECT * FROM far")
def entity_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closest.ball_distance(adapt(spark, sf_dir, POSITIONS))


@_query(_with(positions=POSITIONS_REPEATED) + _FAR + "SELECT * FROM far")
def entity_distance_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closest.ball_distance(adapt(spark, sf_dir, POSITIONS_REPEATED), method="join")


_RANKED = f"""
SELECT {", ".join(f"far.{c}" for c in closest.CLOSEST_COLUMNS if c != "closest_to_ball_rank")},
       closest_to_ball_rank
FROM far LEFT JOIN (
    SELECT {_KEYS}, playerid,
           row_number() OVER (PARTITION BY {_KEYS}
                              ORDER BY distance_from_ball_sq NULLS LAST, playerid)
               AS closest_to_ball_rank
    FROM far WHERE playerid <> -1
) AS ranks USING ({_KEYS}, playerid)
"""


@_query(_with(positions=POSITIONS) + _FAR + _RANKED)
def closest_to_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closest.closest_to_ball(adapt(spark, sf_dir, POSITIONS))


@_query(_with(positions=POSITIONS) + _FAR + _RANKED)
def closest_to_ball_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closest.closest_to_ball(adapt(spark, sf_dir, POSITIONS), method="join")


_GAME_RANGE = "season = '2015-2016' AND CAST(gameid AS BIGINT) BETWEEN 10 AND 29"


@_query(
    _with(positions=POSITIONS) + _FAR + _RANKED
    + " WHERE far." + _GAME_RANGE.replace("gameid", "far.gameid")
)
def closest_to_ball_game_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closest.closest_to_ball(adapt(spark, sf_dir, POSITIONS), "2015-2016", (10, 29))


_FLAGGED = """
, far AS (
    SELECT game_id, event_id, time_stamp, p.player_id,
           (p.x_coordinate - b.x_coordinate) * (p.x_coordinate - b.x_coordinate)
         + (p.y_coordinate - b.y_coordinate) * (p.y_coordinate - b.y_coordinate)
           AS distance_to_ball_sq
    FROM positions AS p
    JOIN (SELECT * FROM positions WHERE player_id = -1) AS b
    USING (game_id, event_id, time_stamp)
), flags AS (
    SELECT far.*, distance_to_ball_sq = least_sq AS closest_to_ball
    FROM far JOIN (
        SELECT game_id, event_id, time_stamp, min(distance_to_ball_sq) AS least_sq
        FROM far WHERE player_id <> -1 GROUP BY ALL
    ) AS least USING (game_id, event_id, time_stamp)
)
"""


@_query(_with(positions=LEGACY_POSITIONS) + _FLAGGED + "SELECT * FROM flags")
def closest_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closest.closest_flags(adapt(spark, sf_dir, LEGACY_POSITIONS))


# Possession --------------------------------------------------------------------


def _possession(limit: int) -> str:
    # Islands by comparing with the last earlier row of another player.
    return f"""
, held AS (
    SELECT *, row_number() OVER (PARTITION BY game_id
                                 ORDER BY event_id, time_stamp, player_id) AS n
    FROM flags WHERE closest_to_ball AND distance_to_ball_sq < {limit}
), changes AS (
    SELECT a.*, CASE WHEN b.n IS NULL OR b.player_id <> a.player_id THEN a.n END AS change
    FROM held AS a LEFT JOIN held AS b ON a.game_id = b.game_id AND a.n = b.n + 1
), islands AS (
    SELECT *, max(change) OVER (PARTITION BY game_id ORDER BY n) AS island FROM changes
), possession AS (
    SELECT game_id, event_id, time_stamp, player_id,
           distance_to_ball_sq AS minimum_distance_sq, length_possession
    FROM islands JOIN (SELECT game_id, island, count(*) AS length_possession
                       FROM islands GROUP BY ALL) AS sizes
    USING (game_id, island)
)
"""


@_query(_with(flags=FLAGS) + _possession(4) + "SELECT * FROM possession")
def possession_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closest.possession_runs(adapt(spark, sf_dir, FLAGS))


@_query(
    _with(positions=LEGACY_POSITIONS) + _FLAGGED + _possession(100) + "SELECT * FROM possession"
)
def game_possession(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closest.game_possession(adapt(spark, sf_dir, LEGACY_POSITIONS), has_ball_dist_sq=100)


@_query(
    _with(flags=FLAGS) + _possession(4)
    + """SELECT 'new' || game_id AS game_id, * EXCLUDE (game_id) FROM possession
         UNION ALL (SELECT DISTINCT * FROM possession)"""
)
def merge_possession(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = closest.possession_runs(adapt(spark, sf_dir, FLAGS))
    fresh = found.withColumn("game_id", F.concat(F.lit("new"), F.col("game_id")))
    return closest.merge_possession(found.unionAll(found), fresh)


# First score and shooting side -------------------------------------------------

_SECONDS = """CASE WHEN pctimestring LIKE '%:%' THEN
    TRY_CAST(split_part(pctimestring, ':', 1) AS BIGINT) * 60
  + TRY_CAST(split_part(pctimestring, ':', 2) AS BIGINT) END"""


def _first_score(condition: str, group: str) -> str:
    return f"""
, score AS (
    SELECT gameid, period, player1_team_id AS teamid, {_SECONDS} AS periodclock
    FROM pbp WHERE score IS NOT NULL AND {condition}
    QUALIFY row_number() OVER (PARTITION BY {group}
                               ORDER BY wctimestring NULLS LAST, eventnum) = 1
)
"""


_FIRST_SCORE = _first_score("period = 1", "gameid, period")


@_query(_with(pbp=PLAY_BY_PLAY) + _FIRST_SCORE + "SELECT * FROM score")
def first_scored_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shooting_side.first_scored_event(adapt(spark, sf_dir, PLAY_BY_PLAY))


@_query(_with(pbp=PLAY_BY_PLAY) + _first_score("true", "gameid") + "SELECT * FROM score")
def first_scored_event_any_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shooting_side.first_scored_event(adapt(spark, sf_dir, PLAY_BY_PLAY), period=None)


def _nearest(spark: SparkSession, sf_dir: str, tolerance) -> DataFrame:
    pbp = adapt(spark, sf_dir, PLAY_BY_PLAY)
    first = shooting_side.first_scored_event(pbp).select(
        "gameid", "period", F.col("periodclock").alias("score_clock")
    )
    samples = pbp.select(
        "gameid", "period", "eventnum", clock_seconds("pctimestring").alias("sample_clock")
    )
    near = nearest_in_group(
        first,
        samples,
        ["gameid", "period"],
        "score_clock",
        "sample_clock",
        ["gameid"],
        ["eventnum"],
        tolerance,
    )
    return near.select("gameid", "period", "score_clock", "sample_clock", "eventnum", "time_diff")


_NEAREST = (
    _with(pbp=PLAY_BY_PLAY)
    + _FIRST_SCORE
    + f"""
, pairs AS (
    SELECT gameid, period, s.periodclock AS score_clock, sample_clock, eventnum,
           abs(sample_clock - s.periodclock) AS time_diff
    FROM score AS s
    JOIN (SELECT gameid, period, eventnum, {_SECONDS} AS sample_clock FROM pbp) AS samples
    USING (gameid, period)
)
SELECT * FROM pairs <where>
QUALIFY row_number() OVER (PARTITION BY gameid ORDER BY time_diff NULLS LAST, eventnum) = 1
"""
)


@_query(_NEAREST.replace("<where>", ""))
def nearest_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nearest(spark, sf_dir, None)


@_query(_NEAREST.replace("<where>", "WHERE time_diff <= 2"))
def nearest_in_time_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nearest(spark, sf_dir, 2)


@_query(
    _with(pbp=PLAY_BY_PLAY, gamelog=GAME_LOG)
    + "SELECT DISTINCT gameid, period, team_id AS teamid FROM pbp JOIN gamelog USING (gameid)"
)
def team_period_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shooting_side.team_period_grid(
        adapt(spark, sf_dir, PLAY_BY_PLAY), adapt(spark, sf_dir, GAME_LOG)
    )


_STAMP = "2016-07-01 00:00:00Z"


def _side_sql(first_score: str, band: str) -> str:
    return (
        _with(pbp=PLAY_BY_PLAY, gamelog=GAME_LOG, positions=POSITIONS)
        + first_score
        + f"""
, side AS (
    SELECT p.gameid, s.teamid,
           CASE sign(p.x_coordinate - 47) WHEN -1 THEN 'left' WHEN 1 THEN 'right' END AS side
    FROM positions AS p
    JOIN score AS s ON p.gameid = s.gameid AND p.period = s.period AND p.playerid = -1 {band}
    QUALIFY row_number() OVER (PARTITION BY p.season, p.gameid, s.teamid
        ORDER BY abs(p.periodclock - s.periodclock) NULLS LAST, p.eventid, p.moment_num) = 1
), grid AS (
    SELECT DISTINCT gameid, period, team_id AS teamid FROM pbp JOIN gamelog USING (gameid)
), flips AS (
    SELECT grid.*, side,
           CASE WHEN period IN (1, 2) THEN 0 WHEN period IN (3, 4) THEN 1 END
           + CASE WHEN grid.teamid = side.teamid THEN 0
                  WHEN grid.teamid <> side.teamid THEN 1 END AS flips
    FROM grid LEFT JOIN side ON grid.gameid = side.gameid
)
SELECT game_date, teamid, team_abbreviation, period,
       CASE WHEN flips % 2 = 0 THEN side
            WHEN flips = 1 THEN CASE side WHEN 'left' THEN 'right' WHEN 'right' THEN 'left' END
       END AS shooting_side,
       '{_STAMP}' AS lastupdate_dts, g.season, g.gameid
FROM flips LEFT JOIN gamelog AS g ON g.gameid = flips.gameid AND g.team_id = flips.teamid
"""
    )


def _sides(spark, sf_dir, **options) -> DataFrame:
    return shooting_side.team_shooting_side(
        adapt(spark, sf_dir, PLAY_BY_PLAY),
        adapt(spark, sf_dir, POSITIONS),
        adapt(spark, sf_dir, GAME_LOG),
        loaded_at=_STAMP,
        **options,
    )


@_query(_side_sql(_FIRST_SCORE, ""))
def team_shooting_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sides(spark, sf_dir)


@_query(
    _side_sql(
        _first_score("true", "gameid"), "AND abs(p.periodclock - s.periodclock) <= 2"
    )
)
def team_shooting_side_banded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sides(spark, sf_dir, period=None, tolerance=2)


# Player actions ----------------------------------------------------------------


def _values(rows) -> str:
    def text(v):
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)

    return ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)


# Fixed values, stated again here so that the SQL does not depend on the library.
_MADE = [
    (1, "jump shot"),
    (5, "layup shot"),
    (7, "slam dunk shot"),
    (57, "hook shot"),
    (71, "finger roll layup shot"),
    (73, "driving reverse layup shot"),
    (75, "driving finger roll layup shot"),
    (76, "running finger roll layup shot"),
    (79, "pull up jump shot"),
    (81, "pull up bank jump shot"),
    (85, "turnaround bank jump shot"),
    (87, "putback slam dunk shot"),
    (102, "driving floating bank jump shot"),
    (106, "running aley oop dunk shot"),
    (107, "tip dunk shot"),
    (108, "cutting dunk shot"),
    (109, "driving reverse dunk shot"),
]
_MISSED = [(c, "driving bank jump shot" if c == 102 else t) for c, t in _MADE]
_LISTED = [(1, c, "field goal made", t) for c, t in _MADE]
_LISTED += [(2, c, "field goal missed", t) for c, t in _MISSED]
_MESSAGE = [
    (1, 3), (2, 3), (3, 1), (4, 2), (5, 4), (6, 4), (7, 5), (8, 6), (9, 7), (10, 8), (11, 9),
    (12, 10), (13, 11), (14, 12), (15, 13),
]
_MISS, _ASSIST, _STEAL, _THREE = (
    f"(homedescription LIKE '{p}' OR visitordescription LIKE '{p}')"
    for p in ("MISS %", "% AST)", "% STEAL %", "% 3PT %")
)

# Events unpivoted to one row per player slot, then a ladder that says what the
# slot did and which dictionary rows describe it.
_ACTIONS = (
    _with(pbp=PLAY_BY_PLAY, dictionary=CODES)
    + f"""
, listed(kind, code, action, text) AS (VALUES {_values(_LISTED)})
, message(event_code, kind) AS (VALUES {_values(_MESSAGE)})
, codes AS (SELECT kind, d.* FROM dictionary AS d JOIN message USING (event_code))
, types AS (SELECT unnest(range(0, 14)) AS kind)
, slots AS (
    SELECT *, 1 AS slot, player1_id AS id, player1_name AS nm, player1_team_id AS tid,
           player1_team_city AS city, player1_team_abbreviation AS abbr FROM pbp
    UNION ALL BY NAME
    SELECT *, 2 AS slot, player2_id AS id, player2_name AS nm, player2_team_id AS tid,
           player2_team_city AS city, player2_team_abbreviation AS abbr FROM pbp
    UNION ALL BY NAME
    SELECT *, 3 AS slot, player3_id AS id, player3_name AS nm, player3_team_id AS tid,
           player3_team_city AS city, player3_team_abbreviation AS abbr FROM pbp
), acted AS (
    SELECT *, CAST(eventmsgtype AS BIGINT) AS kind, eventmsgactiontype AS code,
        CASE
            WHEN eventmsgtype IN (1, 2) AND slot = 1 THEN 'shot'
            WHEN eventmsgtype = 1 AND slot = 2 AND {_ASSIST} THEN 'assist'
            WHEN eventmsgtype = 3 AND slot = 1 THEN 'free throw'
            WHEN eventmsgtype = 4 AND slot = 1 THEN 'rebound'
            WHEN eventmsgtype = 5 AND slot = 2 AND {_STEAL} THEN 'steal'
            WHEN eventmsgtype = 5 AND slot = 1 AND eventmsgactiontype = 40 THEN 'out'
            WHEN eventmsgtype = 5 AND slot = 1 AND eventmsgactiontype <> 40 THEN 'plain'
            WHEN eventmsgtype = 6 AND slot = 2 AND id IS NOT NULL THEN 'got fouled'
            WHEN eventmsgtype = 6 AND slot = 1 THEN 'committed fouled'
            WHEN eventmsgtype = 8 AND slot = 2 AND id IS NOT NULL THEN 'subbed in'
            WHEN eventmsgtype = 8 AND slot = 1 THEN 'subbed out'
            WHEN eventmsgtype = 10 AND slot < 3 THEN 'jump'
            WHEN eventmsgtype = 10 THEN 'jump ball tip'
            WHEN eventmsgtype NOT IN (1, 2, 3, 4, 5, 6, 8, 10) AND slot = 1 THEN 'plain'
        END AS did
    FROM slots
), described AS (
    SELECT a.*, l.action AS found, l.text AS detail
    FROM acted AS a JOIN listed AS l ON a.kind = l.kind AND a.code = l.code WHERE did = 'shot'
    UNION ALL
    SELECT a.*, c.event_action, c.event_subaction
    FROM acted AS a LEFT JOIN codes AS c ON a.kind = c.kind AND a.code = c.event_subcode
    WHERE (did = 'shot' AND a.code NOT IN (SELECT code FROM listed))
       OR did IN ('steal', 'plain', 'got fouled', 'committed fouled')
    UNION ALL
    SELECT a.*, c.event_action, c.event_subaction
    FROM acted AS a LEFT JOIN codes AS c ON a.kind = c.kind
    WHERE did IN ('subbed in', 'subbed out', 'jump', 'jump ball tip')
    UNION ALL
    SELECT a.*, c.event_action, c.event_subaction
    FROM acted AS a JOIN codes AS c ON a.kind = c.kind
    WHERE (did = 'free throw' AND c.event_code = 1 AND a.code = c.event_subcode)
       OR (did = 'rebound' AND c.event_code = 5)
       OR (did = 'out' AND c.event_subcode = 3)
    UNION ALL
    SELECT a.*, NULL, NULL FROM acted AS a WHERE did = 'assist'
), actions AS (
    SELECT eventnum, period, wctimestring, pctimestring, {_SECONDS} AS period_time,
        CAST(CASE did WHEN 'assist' THEN 25 ELSE eventmsgtype END AS DOUBLE) AS eventmsgtype,
        CASE WHEN did <> 'assist' THEN eventmsgactiontype END AS eventmsgactiontype,
        CASE did WHEN 'assist' THEN did WHEN 'rebound' THEN did WHEN 'steal' THEN did
                 WHEN 'free throw' THEN did || CASE WHEN {_MISS} THEN ' missed' ELSE ' made' END
                 ELSE found END AS event_action,
        detail AS event_subaction,
        CASE WHEN did = 'shot' THEN CASE WHEN {_THREE} THEN '3pt' ELSE '2pt' END
                 || CASE kind WHEN 1 THEN ' made' ELSE ' missed' END
             WHEN did = 'free throw' THEN CASE WHEN detail LIKE '% flagrant%' THEN 'flagrant'
                 WHEN detail LIKE '% technical%' THEN 'technical'
                 WHEN detail LIKE '% clear path%' THEN 'clear path' END
             WHEN did IN ('got fouled', 'committed fouled', 'subbed in', 'subbed out',
                          'jump ball tip') THEN did END AS event_subsubaction,
        coalesce(homedescription, visitordescription) AS description,
        CAST(homedescription IS NOT NULL AS INT) AS is_home,
        id AS playerid, nm AS playername, tid AS player_teamid, city AS player_team_city,
        abbr AS player_team_abbreviation, season, gameid
    FROM described
)
"""
)


@_query(_ACTIONS + "SELECT * FROM actions")
def player_actions_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return player_actions(adapt(spark, sf_dir, PLAY_BY_PLAY), adapt(spark, sf_dir, CODES))


@_query(
    _ACTIONS
    + """SELECT eventmsgtype, event_action, event_subsubaction, is_home, count(*) AS n_actions,
                count(event_subaction) AS n_described
         FROM actions GROUP BY ALL"""
)
def player_actions_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = player_actions(adapt(spark, sf_dir, PLAY_BY_PLAY), adapt(spark, sf_dir, CODES))
    return found.groupBy("eventmsgtype", "event_action", "event_subsubaction", "is_home").agg(
        F.count("*").alias("n_actions"), F.count("event_subaction").alias("n_described")
    )


@_query(
    _ACTIONS
    + f"SELECT * FROM actions WHERE {_GAME_RANGE} AND (playerid <> 0 OR playerid IS NULL)"
)
def player_actions_game_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return player_actions(
        adapt(spark, sf_dir, PLAY_BY_PLAY),
        adapt(spark, sf_dir, CODES),
        "2015-2016",
        (10, 29),
        drop_zero_ids=True,
    )


# Scans and scalars ---------------------------------------------------------------


@_query(
    _with(pbp=PLAY_BY_PLAY)
    + f"SELECT gameid, eventnum, eventmsgtype, period FROM pbp WHERE {_GAME_RANGE}"
)
def game_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    pbp = closest.in_games(adapt(spark, sf_dir, PLAY_BY_PLAY), "2015-2016", (10, 29))
    return pbp.select("gameid", "eventnum", "eventmsgtype", "period")


@_query(_with(pbp=PLAY_BY_PLAY) + f"SELECT eventnum, {_SECONDS} AS period_time FROM pbp")
def clock_to_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapt(spark, sf_dir, PLAY_BY_PLAY).select(
        "eventnum", clock_seconds("pctimestring").alias("period_time")
    )


@_query(
    _with(pbp=PLAY_BY_PLAY)
    + """SELECT eventnum, CASE WHEN eventmsgtype IS NOT NULL THEN wctimestring END AS wall_clock
         FROM pbp"""
)
def wall_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("eventmsgtype").isNull(), F.lit("25:61 XM")).otherwise(
        F.col("wctimestring")
    )
    return adapt(spark, sf_dir, PLAY_BY_PLAY_12H).select(
        "eventnum", wall_clock_24h(text).alias("wall_clock")
    )


@_query(
    """SELECT event_id,
              strftime(make_timestamp((1446300000007 + event_id * 86399977) * 1000),
                       '%Y-%m-%d %H:%M:%SZ') AS timestamp_dts
       FROM events"""
)
def epoch_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.col("event_id") * 86399977 + 1446300000007
    return table(spark, sf_dir, "events").select(
        "event_id", epoch_ms_text(ms).alias("timestamp_dts")
    )


@_query(
    """SELECT o_orderkey,
              year(o_orderdate) || '-' || (year(o_orderdate) + 1) AS long_season,
              year(o_orderdate) || '-' || right(CAST(year(o_orderdate) + 1 AS VARCHAR), 2)
                  AS short_season
       FROM orders"""
)
def season_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.year("o_orderdate")
    short = F.concat(first.cast("string"), F.lit("-"), F.right((first + 1).cast("string"), F.lit(2)))
    path = F.concat(first.cast("string"), F.lit("-"), (first + 1).cast("string"), F.lit("/x.7z"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        season_long(short).alias("long_season"),
        season_short(path).alias("short_season"),
    )


@_query(
    _with(gamelog=GAME_LOG)
    + r"""SELECT gameid, team_id, split_part(matchup, ' ', 1) AS team1,
                 regexp_extract(matchup, '(\w+)$', 1) AS team2,
                 replace(game_date, '-', '') AS file_date
          FROM gamelog"""
)
def matchup_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    team1, team2 = matchup_teams("matchup")
    return adapt(spark, sf_dir, GAME_LOG).select(
        "gameid",
        "team_id",
        team1.alias("team1"),
        team2.alias("team2"),
        compact_date("game_date").alias("file_date"),
    )


@_query(
    _with(pbp=PLAY_BY_PLAY)
    + """SELECT eventnum, TRY_CAST(trim(split_part(score, '-', 1)) AS INT) AS score_visitor,
                TRY_CAST(nullif(trim(split_part(score, '-', 2)), '') AS INT) AS score_home
         FROM pbp"""
)
def score_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    visitor, home = score_pair("score")
    return adapt(spark, sf_dir, PLAY_BY_PLAY).select(
        "eventnum", visitor.alias("score_visitor"), home.alias("score_home")
    )


# Archive names made from page addresses: mobile pages give raw archives, addresses
# with a query give another format.
_ARCHIVES = """
SELECT '20' || lpad(CAST(10 + page_id % 9 AS STRING), 2, '0') || '-2019/'
       || CASE WHEN url LIKE '%//m.%' THEN 'Raw/' ELSE '' END || 'rawdata/'
       || lpad(CAST(1 + page_id % 12 AS STRING), 2, '0') || '.'
       || lpad(CAST(1 + page_id % 28 AS STRING), 2, '0') || '.2016.AAA.at.B'
       || CASE WHEN url LIKE '%?%' THEN '.zip' ELSE '.7z' END AS key,
       'table/season=2015-2016/' || CASE WHEN url LIKE '%#%' THEN '' ELSE 'gameid='
       || lpad(CAST(page_id AS STRING), 10, '0') || '/' END || 'part.parquet' AS path
FROM {pages}
"""


@_query(
    _with(archives=_ARCHIVES)
    + r"""SELECT key AS filename, split_part(key, '/', 1) AS season,
                 strptime(regexp_extract(key, 'rawdata/(\d+\.\d+\.\d+)\.', 1), '%m.%d.%Y')::DATE
                     AS gamedate
          FROM archives WHERE key LIKE '%.7z%' AND key NOT LIKE '%Raw%'"""
)
def file_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.file_catalogue(adapt(spark, sf_dir, _ARCHIVES), "key")


@_query(
    _with(archives=_ARCHIVES)
    + """SELECT path, '2015-2016' AS season,
                CASE WHEN path LIKE '%gameid=%' THEN split_part(split_part(path, 'gameid=', 2), '/', 1)
                END AS gameid
         FROM archives"""
)
def path_partition_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.partition_keys(adapt(spark, sf_dir, _ARCHIVES), "path")


_TWO_LINES = """
SELECT CAST(year(o_orderdate) AS STRING) AS season,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS game_date,
       lpad(CAST(o_orderkey AS STRING), 10, '0') AS game_id,
       concat('V', CAST(o_custkey % 30 AS STRING), ' @ H', CAST(o_custkey % 29 AS STRING)) AS matchup
FROM {orders}
UNION ALL
SELECT CAST(year(o_orderdate) AS STRING), CAST(CAST(o_orderdate AS DATE) AS STRING),
       lpad(CAST(o_orderkey AS STRING), 10, '0'),
       concat('H', CAST(o_custkey % 29 AS STRING), ' vs. V', CAST(o_custkey % 30 AS STRING))
FROM {orders}
"""


@_query(
    """
    SELECT year(o_orderdate)::VARCHAR AS season, o_orderdate::DATE::VARCHAR AS game_date,
           lpad(o_orderkey::VARCHAR, 10, '0') AS game_id, 'V' || o_custkey % 30 AS team1,
           'H' || o_custkey % 29 AS team2
    FROM orders, range(2)"""
)
def gamelog_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both rows of a game name visitor and home."""
    return loads.gamelog_manifest_rows(adapt(spark, sf_dir, _TWO_LINES))


_DATED = """
SELECT CAST(year(o_orderdate) AS STRING) AS season,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS game_date,
       lpad(CAST(o_custkey AS STRING), 10, '0') AS game_id,
       o_orderstatus AS team1, o_orderpriority AS team2
FROM {orders}
"""


@_query(
    _with(dated=_DATED)
    + """SELECT season, strftime(min(game_date)::DATE, '%m/%d/%Y') AS first_date,
                strftime(max(game_date)::DATE, '%m/%d/%Y') AS last_date
         FROM dated GROUP BY season"""
)
def season_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loads.season_bounds(adapt(spark, sf_dir, _DATED))


@_query(
    _with(dated=_DATED)
    + """, firsts AS (
        SELECT * FROM dated
        QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY game_date, team1, team2) = 1
    )
    SELECT *, strftime(game_date::DATE, '%m/%d/%Y') AS us_date FROM firsts
    WHERE game_date BETWEEN '1995-03-01' AND '1996-12-31'"""
)
def games_in_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = loads.games_between(adapt(spark, sf_dir, _DATED), "1995-03-01", "1996-12-31")
    return games.withColumn("us_date", us_date("game_date"))


@_query(
    _with(gamelog=GAME_LOG)
    + """, codes AS (SELECT DISTINCT gameid, team_abbreviation AS code FROM gamelog)
    SELECT a.gameid, min(a.code) AS team1, min(b.code) AS team2
    FROM codes AS a LEFT JOIN codes AS b ON a.gameid = b.gameid AND b.code > a.code
    GROUP BY a.gameid"""
)
def game_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shooting_side.game_team_pairs(
        adapt(spark, sf_dir, GAME_LOG), "gameid", "team_abbreviation"
    )


# Nested documents ----------------------------------------------------------------


@_query(
    """
    SELECT '2015-2016' AS season, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS gameid,
           e + 1 AS eventid, m AS moment_num,
           strftime(make_timestamp((1446300000007 + o_orderkey * 40 + m) * 1000),
                    '%Y-%m-%d %H:%M:%SZ') AS timestamp_dts,
           1446300000007 + o_orderkey * 40 + m AS timestamp_utc,
           o_orderkey % 4 + 1 AS period, o_orderkey % 721 + 0.5::DOUBLE AS periodclock,
           CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderkey % 25 + m AS DOUBLE) END AS shotclock,
           CASE k WHEN 0 THEN -1 ELSE o_orderkey * 2 END AS teamid,
           CASE k WHEN 0 THEN -1 ELSE o_orderkey * 20 END AS playerid,
           o_totalprice / CASE k WHEN 0 THEN 1000 ELSE 2000 END AS x_coordinate,
           CASE k WHEN 0 THEN e + 0.5::DOUBLE ELSE m END AS y_coordinate,
           CASE k WHEN 0 THEN 1.25::DOUBLE ELSE 0 END AS z_coordinate
    FROM (SELECT *, unnest(range(0, o_orderkey % 3)) AS m FROM orders)
    CROSS JOIN (SELECT unnest(range(0, 2)) AS e) CROSS JOIN (SELECT unnest(range(0, 2)) AS k)
    """
)
def flatten_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.flatten_positions(documents.tracking_documents(spark, sf_dir))


_TEAMS_OF_ORDERS = """
FROM (SELECT *, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS gameid, unnest([0, 1]) AS t
      FROM orders)
"""


@_query(
    "SELECT '2015-2016' AS season, gameid, (o_orderkey * 2 + t) * 10 AS playerid,"
    " 'F' || o_orderkey AS firstname, 'L' || t AS lastname, o_orderkey * 2 + t AS teamid,"
    " 'F-G' AS position, CAST(o_orderkey % 100 AS VARCHAR) AS jersey,"
    " '1970-01-01' AS startdate, '1970-01-01' AS enddate " + _TEAMS_OF_ORDERS
)
def flatten_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.flatten_players(documents.tracking_documents(spark, sf_dir))


@_query(
    "SELECT '2015-2016' AS season, gameid, o_orderkey * 2 + t AS teamid, o_orderpriority AS name,"
    " NULL::VARCHAR AS conference, NULL::VARCHAR AS division, NULL::VARCHAR AS city,"
    " NULL::VARCHAR AS state, '1970-01-01' AS startdate, '1970-01-01' AS enddate "
    + _TEAMS_OF_ORDERS
)
def flatten_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.flatten_teams(documents.tracking_documents(spark, sf_dir))


@_query(
    """SELECT '2015-2016' AS season, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS gameid,
              CAST(o_orderdate::DATE AS VARCHAR) AS gamedate, o_orderkey * 2 AS home_teamid,
              o_orderkey * 2 + 1 AS visitor_teamid FROM orders"""
)
def flatten_game(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.flatten_game(documents.tracking_documents(spark, sf_dir))


@_query(
    """SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS game_id, c_acctbal AS pts,
              NULL::DOUBLE AS video_available_flag, '2015-16' AS season, 'Rows' AS result_set
       FROM customer
       UNION ALL SELECT NULL, NULL, 1, '2015-16', 'AvailableVideo' FROM customer"""
)
def result_sets_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_acctbal").alias("pts"),
        F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("game_id"),
    )
    docs = documents.result_set_documents(rows, "Rows", documents.VIDEO_SET)
    return result_sets.result_sets_to_df(
        docs, "game_id string, pts double, video_available_flag double"
    )


_PBP_COLUMNS = [n for n, _ in schemas.columns(schemas.PLAY_BY_PLAY) if n != "game_id"]


@_query(
    _with(pbp=PLAY_BY_PLAY)
    + f"""SELECT gameid AS game_id, {", ".join(_PBP_COLUMNS)},
                 NULL::DOUBLE AS video_available_flag, '2015-16' AS season FROM pbp"""
)
def play_by_play_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_sets.play_by_play(documents.play_by_play_documents(spark, sf_dir))


def _box_sql(ddl: str, filled: dict[str, str], season: str) -> str:
    """A SELECT over lineitem with the given columns filled and the rest NULL."""
    duck = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT"}
    rename = {"min": "minutes", "pass": "passes"}
    picked = ", ".join(
        f'CAST({filled.get(n, "NULL")} AS {duck[t]}) AS "{rename.get(n, n)}"'
        for n, t in schemas.columns(ddl)
    )
    return (
        f"SELECT {picked}, '{season}' AS season, 'PlayerStats' AS result_set FROM lineitem"
    )


_BOX_FILLED = {
    "game_id": "lpad(CAST(l_orderkey AS VARCHAR), 10, '0')",
    "team_id": "l_suppkey",
    "team_abbreviation": "l_returnflag",
    "player_id": "l_linenumber",
    "min": "CASE WHEN l_partkey % 9 > 0 THEN CAST(l_quantity AS INT) || '.'"
    " || lpad(CAST(l_suppkey % 60 AS VARCHAR), 2, '0') END",
    "ast": "l_quantity",
    "fg_pct": "l_discount",
}
_BOX_TRADITIONAL = _box_sql(
    schemas.BOX_SCORE_TRADITIONAL, {**_BOX_FILLED, "pts": "l_extendedprice"}, "2015-16"
)


@_query(_BOX_TRADITIONAL)
def boxscore_traditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_sets.boxscore(documents.box_score_documents(spark, sf_dir, "traditional"))


@_query(
    _box_sql(schemas.BOX_SCORE_PLAYER, {**_BOX_FILLED, "pass": "l_extendedprice"}, "2015-16")
)
def boxscore_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_sets.boxscore(documents.box_score_documents(spark, sf_dir, "player"), "player")


_LOG_FILLED = {
    "game_id": "gameid",
    "team_id": "team_id",
    "team_abbreviation": "team_abbreviation",
    "game_date": "game_date",
    "matchup": "matchup",
    "pts": "team_id % 120",
}


@_query(
    _with(log=GAME_LOG)
    + _box_sql(schemas.GAME_LOG, _LOG_FILLED, "2015-16")
    .replace(", 'PlayerStats' AS result_set FROM lineitem", " FROM log")
    .replace('"minutes"', '"min"')
)
def gamelog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_sets.gamelog(documents.gamelog_documents(spark, sf_dir))


@_query(
    """SELECT CAST(p_partkey AS INT) AS event_code, lower(p_name) AS event_action,
              CAST(code AS INT) AS event_subcode, lower(text) AS event_subaction
       FROM part JOIN (
           SELECT p_partkey AS k, 1 AS code, p_type AS text FROM part WHERE p_partkey % 3 > 0
           UNION ALL SELECT p_partkey, p_size + 1, p_brand FROM part WHERE p_partkey % 3 > 0
           UNION ALL SELECT p_partkey, NULL, NULL FROM part WHERE p_partkey % 3 = 0
       ) ON k = p_partkey"""
)
def event_code_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_codes.event_codes(documents.event_code_documents(spark, sf_dir))


@_query(
    """SELECT CAST(p_partkey AS INT) AS event_id, p_name AS event_description,
              CAST(code AS INT) AS detail_id, text AS detail_description
       FROM part JOIN (
           SELECT p_partkey AS k, 1 AS code, p_type AS text FROM part WHERE p_partkey % 3 > 0
           UNION ALL SELECT p_partkey, p_size + 1, p_brand FROM part WHERE p_partkey % 3 > 0
           UNION ALL SELECT p_partkey, -1, 'None' FROM part WHERE p_partkey % 3 = 0
       ) ON k = p_partkey"""
)
def event_code_rows_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_codes.event_codes_legacy(documents.event_code_documents(spark, sf_dir))


@_query("SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS text FROM part")
def event_code_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_codes.event_code_names(documents.event_code_documents(spark, sf_dir))


# Legacy layouts --------------------------------------------------------------------

_LEGACY_PLAYERS = ", ".join(
    f"CAST(person{i}type AS INT) AS player{i}_type, CAST(player{i}_id AS INT) AS player{i}_id,"
    f" player{i}_name, CAST(player{i}_team_id AS INT) AS player{i}_team_id"
    for i in (1, 2, 3)
)


@_query(
    _with(pbp=PLAY_BY_PLAY)
    + f"""SELECT gameid AS game_id, CAST(eventnum AS INT) AS event_id,
        CAST(eventmsgtype AS INT) AS event_msg_type,
        CAST(eventmsgactiontype AS INT) AS event_msg_action_type, CAST(period AS INT) AS period,
        substr(wctimestring, 1, 5) AS wctimestring, CAST({_SECONDS} AS DOUBLE) AS pctimestring,
        homedescription AS home_description, neutraldescription AS neutral_description,
        visitordescription AS visitor_description,
        TRY_CAST(trim(split_part(score, '-', 1)) AS DOUBLE) AS score_visitor,
        TRY_CAST(nullif(trim(split_part(score, '-', 2)), '') AS DOUBLE) AS score_home,
        {_LEGACY_PLAYERS}
    FROM pbp"""
)
def legacy_play_by_play(spark: SparkSession, sf_dir: str) -> DataFrame:
    pbp = adapt(spark, sf_dir, PLAY_BY_PLAY).withColumnRenamed("gameid", "game_id")
    view = legacy.legacy_view(pbp, "play_by_play")
    # Compared as text: a bare time of day has no fixed date.
    return view.withColumn("wctimestring", F.date_format("wctimestring", "HH:mm"))


@_query(
    "SELECT "
    + ", ".join(
        "CAST(minutes AS DOUBLE) AS minutes" if old == "minutes" else f'"{old}" AS {new}'
        for old, new in legacy.BOX_SCORE_NAMES["traditional"].items()
    )
    + f" FROM ({_BOX_TRADITIONAL})"
)
def legacy_box_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = result_sets.boxscore(documents.box_score_documents(spark, sf_dir, "traditional"))
    return legacy.legacy_view(rows, "box_score_traditional")


@_query(
    _with(positions=POSITIONS)
    + """SELECT gameid AS game_id, eventid AS event_id, timestamp_utc AS time_stamp, period,
                periodclock AS period_clock, shotclock AS shot_clock, teamid AS team_id,
                playerid AS player_id, x_coordinate, y_coordinate, z_coordinate
         FROM positions"""
)
def legacy_game_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = legacy.legacy_view(adapt(spark, sf_dir, POSITIONS), "game_positions")
    return view.withColumn("time_stamp", F.unix_millis("time_stamp"))


@_query(
    "SELECT (o_orderkey * 2 + t) * 10 AS id, 'L' || t AS last_name,"
    " 'F' || o_orderkey AS first_name, o_orderkey * 2 + t AS team_id,"
    " CAST(o_orderkey % 100 AS INT) AS jersey_number, 'F-G' AS position,"
    " DATE '1970-01-01' AS start_date, DATE '1970-01-01' AS end_date " + _TEAMS_OF_ORDERS
)
def legacy_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents.tracking_documents(spark, sf_dir)
    return legacy.legacy_view(tracking.flatten_players(docs), "players")


@_query(
    "SELECT o_orderkey * 2 + t AS id, o_orderpriority AS name, NULL::VARCHAR AS conference,"
    " NULL::VARCHAR AS division, NULL::VARCHAR AS city, NULL::VARCHAR AS state,"
    " NULL::INT AS zipcode, DATE '1970-01-01' AS start_date, DATE '1970-01-01' AS end_date "
    + _TEAMS_OF_ORDERS
)
def legacy_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents.tracking_documents(spark, sf_dir)
    return legacy.legacy_view(tracking.flatten_teams(docs), "teams")


@_query(
    """SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS id, o_orderdate::DATE AS start_date,
              o_orderkey * 2 AS home_team_id, o_orderkey * 2 + 1 AS visitor_team_id FROM orders"""
)
def legacy_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents.tracking_documents(spark, sf_dir)
    view = legacy.legacy_view(tracking.flatten_game(docs), "games")
    return view.select(
        "id", F.to_date("start_time").alias("start_date"), "home_team_id", "visitor_team_id"
    )


# Table maintenance -------------------------------------------------------------------

_LINE_ORDER = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_tax", "l_discount"]


@_query(
    f"""SELECT * FROM lineitem QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY {", ".join(f"{c} NULLS LAST" for c in _LINE_ORDER)}) = 1"""
)
def dedupe_by_key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_by_key(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE_ORDER
    )


@_query(
    """SELECT * FROM orders AS o
       WHERE o_orderstatus <> 'F'
         AND NOT EXISTS (SELECT 1 FROM orders AS e
                         WHERE e.o_orderstatus = 'F' AND e.o_custkey = o.o_custkey
                           AND e.o_orderpriority = o.o_orderpriority)
       QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                                  ORDER BY o_orderdate, o_orderkey) = 1"""
)
def insert_ignore_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return insert_ignore(
        orders.where("o_orderstatus = 'F'"),
        orders.where("o_orderstatus <> 'F'"),
        ["o_custkey", "o_orderpriority"],
        ["o_orderdate", "o_orderkey"],
    )


@_query(
    """SELECT event_type, user_id FROM events WHERE value > 20
       UNION ALL (SELECT DISTINCT event_type, user_id FROM events)"""
)
def append_distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return append_distinct(
        events.select("event_type", "user_id"),
        events.where("value > 20").select("event_type", "user_id"),
    )


_MANIFEST = """
SELECT o_orderstatus AS season, lpad(CAST(o_custkey AS STRING), 10, '0') AS gameid,
       o_orderpriority AS params, CAST(o_orderkey % 2 AS INT) AS uploadedFLG,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS lastuploadDTS
FROM {orders}
"""


@_query(
    _with(rows=_MANIFEST)
    + """SELECT * FROM rows QUALIFY row_number() OVER (
            PARTITION BY gameid ORDER BY season = 'F' DESC, lastuploadDTS DESC,
            season, params, uploadedFLG) = 1"""
)
def manifest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapt(spark, sf_dir, _MANIFEST)
    return upsert_manifest(
        rows.where("season <> 'F'"), rows.where("season = 'F'"), ["gameid"], "lastuploadDTS"
    )


@_query(
    _with(dated=_DATED)
    + """SELECT *, 1 AS gamelog_uploadedFLG, 't' AS lastuploadDTS, 'u' AS base_url, 'p' AS params
         FROM dated WHERE season < '1998'
         UNION ALL SELECT *, 0, 'now', 'url', 'none' FROM dated WHERE season >= '1998'"""
)
def manifest_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = adapt(spark, sf_dir, _DATED)
    empty = spark.createDataFrame([], schemas.GAME_LOG_MANIFEST)
    constants = dict(gamelog_uploadedFLG=1, lastuploadDTS="t", base_url="u", params="p")
    first = append_manifest(empty, dated.where("season < '1998'"), **constants)
    more = dict(gamelog_uploadedFLG=0, lastuploadDTS="now", base_url="url", params="none")
    return append_manifest(first, dated.where("season >= '1998'"), **more)


@_query(
    """SELECT l_orderkey FROM lineitem
       EXCEPT SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'"""
)
def pending_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return pending(
        table(spark, sf_dir, "lineitem"),
        manifest,
        "l_orderkey",
        done=F.col("o_orderstatus") == "F",
    )


_STORED = """
SELECT CAST(year(o_orderdate) AS STRING) AS season,
       lpad(CAST(o_custkey % 5 AS STRING), 10, '0') AS gameid,
       o_orderkey, o_totalprice, o_orderpriority
FROM {orders}
"""


@_query(
    _with(stored=_STORED)
    + """SELECT season, gameid, o_orderkey, o_orderpriority,
                CASE WHEN season = '1996' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
         FROM stored"""
)
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a partitioned table, replace one season, read it back."""
    path = scratch_path(spark, "orders")
    rows = adapt(spark, sf_dir, _STORED)
    writers.write_table(rows, path, sort_by=["o_orderkey"])
    changed = rows.where("season = '1996'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    writers.write_table(changed, path)
    schema = "season string, gameid string, o_orderkey bigint, o_totalprice double, o_orderpriority string"
    return readers.read_table(spark, path, schema)


@_query(
    """SELECT c_custkey, nullif(c_name, 'Customer#000000001') AS c_name, c_acctbal,
              CASE WHEN c_nationkey > 3 THEN c_mktsegment END AS c_mktsegment FROM customer"""
)
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write CSV with empty fields and read it back; empty fields are NULL."""
    path = scratch_path(spark, "customer")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_name") == "Customer#000000001", F.lit("")).otherwise(F.col("c_name")).alias(
            "c_name"
        ),
        "c_acctbal",
        F.when(F.col("c_nationkey") > 3, F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    writers.write_csv(rows, path)
    schema = "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string"
    return readers.read_csv_table(spark, path, schema)


@_query(_with(positions=POSITIONS) + _FAR + _RANKED)
def closest_to_ball_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions → ranked table written by season and game → read back."""
    path = scratch_path(spark, "closest_to_ball")
    writers.write_table(closest.closest_to_ball(adapt(spark, sf_dir, POSITIONS)), path)
    return readers.read_table(spark, path, schemas.CLOSEST_TO_BALL)


@_query(
    _with(stored=_STORED)
    + """SELECT season, gameid, o_orderkey, o_totalprice, o_orderpriority FROM stored
         WHERE season <> '1996' OR o_totalprice > (SELECT avg(o_totalprice) FROM stored)"""
)
def replace_empty_game(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A season is asked for again; its games without rows now lose their partitions."""
    path, log = scratch_path(spark, "games"), scratch_path(spark, "games-log")
    rows = adapt(spark, sf_dir, _STORED).select(
        "o_orderkey", "o_totalprice", "o_orderpriority", "season", "gameid"
    )
    loads.refresh_derived(rows, path, log, "t1")
    mean = rows.agg(F.avg("o_totalprice").alias("mean"))
    asked = rows.where("season = '1996'")
    kept = asked.join(F.broadcast(mean), F.col("o_totalprice") > F.col("mean")).drop("mean")
    loads.refresh_derived(kept, path, log, "t2", games=asked)
    schema = "season string, gameid string, o_orderkey bigint, o_totalprice double, o_orderpriority string"
    return readers.read_table(spark, path, schema)


# Loads of written files --------------------------------------------------------------


def _load_tracking(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    target, log = scratch_path(spark, "tables"), scratch_path(spark, "tables-log")
    files = documents.tracking_files(spark, sf_dir)
    loads.load_tracking(spark, files, target, log, "t1", multiline=False)
    return target, log


@_query(
    "SELECT * REPLACE (lpad(CAST(CAST(gameid AS BIGINT) % 50 AS VARCHAR), 10, '0') AS gameid)"
    f" FROM ({SQL['flatten_positions']}) WHERE CAST(gameid AS BIGINT) % 7 > 0"
)
def load_tracking_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracking files, broken documents among them → positions by game, read back."""
    target, _ = _load_tracking(spark, sf_dir)
    return readers.read_table(spark, f"{target}/gameposition", schemas.GAME_POSITION)


@_query(
    """SELECT CASE WHEN o_orderkey % 7 > 0
                   THEN lpad(CAST(o_orderkey % 50 AS VARCHAR), 10, '0') END AS gameid,
              CASE WHEN o_orderkey % 7 > 0 THEN 1 ELSE 0 END AS gameposition_uploadedFLG,
              't1' AS lastuploadDTS, count(*) AS documents
       FROM orders GROUP BY ALL"""
)
def load_tracking_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the manifest says about these files, the broken documents without a game."""
    _, log = _load_tracking(spark, sf_dir)
    manifest = writers.load_manifest(spark, log, schemas.TRACKING_MANIFEST)
    return manifest.groupBy("gameid", "gameposition_uploadedFLG", "lastuploadDTS").agg(
        F.count("*").alias("documents")
    )


_ASKED_GAMES = """
SELECT '2015-16' AS season, lpad(CAST(c_custkey % 45 AS STRING), 10, '0') AS game_id,
       '2016-03-' || lpad(CAST(c_custkey % 45 % 28 + 1 AS STRING), 2, '0') AS game_date,
       'A' || CAST(c_custkey % 45 % 7 AS STRING) AS team1,
       'B' || CAST(c_custkey % 45 % 5 AS STRING) AS team2
FROM {customer}
"""
_GAME_OF_40 = "lpad(CAST(CAST(gameid AS BIGINT) % 40 AS VARCHAR), 10, '0')"


def _load_stats(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    target, log = scratch_path(spark, "tables"), scratch_path(spark, "tables-log")
    games = loads.games_between(adapt(spark, sf_dir, _ASKED_GAMES), end="2016-03-24")
    files = documents.play_by_play_files(spark, sf_dir)
    loads.load_stats(
        spark, files, target, "playbyplay", games, log, "t1", base_url="u", multiline=False
    )
    return target, log


@_query(
    _with(pbp=PLAY_BY_PLAY, asked=_ASKED_GAMES)
    + f"""SELECT {_GAME_OF_40} AS gameid, {", ".join(_PBP_COLUMNS)}, '2015-2016' AS season
          FROM pbp WHERE eventnum % 11 > 0
          AND {_GAME_OF_40} IN (SELECT game_id FROM asked WHERE game_date <= '2016-03-24')"""
)
def load_stats_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Play-by-play responses, broken ones among them → the table of the games asked for."""
    target, _ = _load_stats(spark, sf_dir)
    schema = schemas.PLAY_BY_PLAY.replace("game_id string, ", "") + ", season string, gameid string"
    return readers.read_table(spark, f"{target}/playbyplay", schema)


@_query(
    _with(pbp=PLAY_BY_PLAY, asked=_ASKED_GAMES)
    + f"""SELECT DISTINCT season, game_date, game_id, team1, team2,
                 CASE WHEN game_id IN (SELECT {_GAME_OF_40} FROM pbp WHERE eventnum % 11 > 0)
                      THEN 1 ELSE 0 END AS fileuploadedFLG,
                 't1' AS lastuploadDTS, 'u' AS base_url, '' AS params
          FROM asked WHERE game_date <= '2016-03-24'"""
)
def load_stats_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the games asked for have a usable response."""
    _, log = _load_stats(spark, sf_dir)
    return writers.load_manifest(spark, log, schemas.STATS_MANIFEST)


@_query(SQL["event_code_rows"])
def event_code_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XML files → event codes."""
    files = documents.event_code_files(spark, sf_dir)
    return event_codes.event_codes(readers.read_event_codes(spark, files))


_CSV_SCHEMA = "c_custkey bigint, c_name string, c_acctbal double"


def _customers(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A table of the customers with a positive balance, and all customers as CSV, those of
    every third key a second time under another name."""
    stored, csv = scratch_path(spark, "customer"), scratch_path(spark, "customer-csv")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    rows.where("c_acctbal > 0").write.parquet(stored)
    again = rows.where("c_custkey % 3 = 0").withColumn("c_name", F.concat(F.lit("A"), "c_name"))
    writers.write_csv(rows.unionByName(again), csv)
    return stored, csv


@_query(
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 AND c_acctbal <= 0 THEN 'A' ELSE '' END
              || c_name AS c_name, c_acctbal FROM customer"""
)
def insert_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV file into a table with a key: one row for each key that the table lacks."""
    stored, csv = _customers(spark, sf_dir)
    loads.insert_csv(spark, csv, stored, _CSV_SCHEMA, ["c_custkey"], ["c_name"])
    return readers.read_table(spark, stored, _CSV_SCHEMA)


@_query(
    """SELECT c_custkey, c_name, c_acctbal FROM customer
       UNION ALL SELECT c_custkey, 'A' || c_name, c_acctbal FROM customer WHERE c_custkey % 3 = 0
       UNION ALL SELECT DISTINCT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0"""
)
def append_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV file onto a table without a key."""
    stored, csv = _customers(spark, sf_dir)
    target = scratch_path(spark, "customer-new")
    loads.append_csv_distinct(spark, csv, stored, _CSV_SCHEMA, target)
    return readers.read_table(spark, target, _CSV_SCHEMA)
