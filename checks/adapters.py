"""Game-like tables derived from the given ones.

Each adapter is one SELECT that both Spark and the comparing engine understand, so
the two sides start from the same rows and what is compared is the operators. All
adapters read whole tables; modulo only shapes column values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_POSITION = """
    '2015-2016' AS season,
    lpad(CAST(l_orderkey % 50 AS STRING), 10, '0') AS gameid,
    l_orderkey AS eventid,
    CAST(0 AS BIGINT) AS moment_num,
    CAST(l_orderkey AS STRING) AS timestamp_dts,
    1446300000007 + l_orderkey * 40 AS timestamp_utc,
    l_orderkey % 5 + 1 AS period,
    CAST((l_orderkey * 7) % 721 AS DOUBLE) AS periodclock,
    CASE WHEN l_orderkey % 6 > 0 THEN CAST(l_orderkey % 25 AS DOUBLE) END AS shotclock,
    CAST(CASE WHEN l_linenumber = 1 THEN -1 ELSE l_linenumber % 2 END AS BIGINT) AS teamid,
    CAST(CASE WHEN l_linenumber = 1 THEN -1 ELSE l_linenumber END AS BIGINT) AS playerid,
"""

# One row per (order, line): about half of the orders have no line 1, which plays
# the ball.
POSITIONS = f"""
SELECT {_POSITION}
    max(l_quantity) AS x_coordinate,
    max(round(l_tax * 100)) AS y_coordinate,
    max(l_extendedprice) AS z_coordinate
FROM {{lineitem}} GROUP BY l_orderkey, l_linenumber
"""

# The same without grouping: orders with a repeated line have several balls.
POSITIONS_REPEATED = f"""
SELECT {_POSITION}
    l_quantity AS x_coordinate,
    round(l_tax * 100) AS y_coordinate,
    l_extendedprice AS z_coordinate
FROM {{lineitem}}
"""

LEGACY_POSITIONS = f"""
SELECT gameid AS game_id, eventid AS event_id, timestamp_utc AS time_stamp,
       playerid AS player_id, x_coordinate, y_coordinate
FROM ({POSITIONS}) AS positions
"""

FLAGS = """
SELECT lpad(CAST(user_id AS STRING), 10, '0') AS game_id,
       event_id,
       event_id * 40 AS time_stamp,
       CAST(floor(value / 5) AS BIGINT) % 3 AS player_id,
       value / 2 AS distance_to_ball_sq,
       event_type <> 'error' AS closest_to_ball
FROM {events}
"""

_CODES = (1, 5, 40, 102, 109, 3, 2, None, 8, 57, 0, 11)
_ACTION = " ".join(
    f"WHEN {i} THEN {'NULL' if c is None else f'{c}.0'}" for i, c in enumerate(_CODES)
)
_PLAYERS = ",\n".join(
    f"""
    CAST(4 + event_id % 2 AS DOUBLE) AS person{i}type,
    {f"CASE WHEN event_id % 6 > 0 THEN CAST(event_id % {m} AS DOUBLE) END"
     if i == 2 else f"CAST(event_id % {m} AS DOUBLE)"} AS player{i}_id,
    'P' || CAST(event_id % {m} AS STRING) AS player{i}_name,
    CAST(user_id * 2 + event_id % 2 AS DOUBLE) AS player{i}_team_id,
    'City ' || CAST(user_id AS STRING) AS player{i}_team_city,
    'N' || CAST(event_id % 2 AS STRING) AS player{i}_team_nickname,
    'T' || CAST(user_id AS STRING) AS player{i}_team_abbreviation"""
    for i, m in ((1, 13), (2, 17), (3, 19))
)

_CLOCK_24H = """lpad(CAST(hour(ts) AS STRING), 2, '0') || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0')
        || ':00'"""
_CLOCK_12H = """CAST((hour(ts) + 11) % 12 + 1 AS STRING) || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0')
        || CASE WHEN hour(ts) < 12 THEN ' AM' ELSE ' PM' END"""

_PLAY_BY_PLAY = f"""
SELECT
    lpad(CAST(user_id AS STRING), 10, '0') AS gameid,
    '2015-2016' AS season,
    CAST(event_id AS DOUBLE) AS eventnum,
    CASE WHEN event_id % 97 > 0 THEN CAST(event_id % 14 AS DOUBLE) END AS eventmsgtype,
    CAST(CASE CAST((event_id - event_id % 14) / 14 AS BIGINT) % 12 {_ACTION} END AS DOUBLE)
        AS eventmsgactiontype,
    CAST(event_id % 5 + 1 AS DOUBLE) AS period,
    <clock> AS wctimestring,
    CASE WHEN event_id % 101 = 0 THEN 'bad' WHEN event_id % 103 = 0 THEN NULL
         ELSE CAST(minute(ts) % 12 AS STRING) || ':' || lpad(CAST(second(ts) AS STRING), 2, '0')
    END AS pctimestring,
    CASE WHEN event_id % 3 = 0 THEN NULL
         WHEN event_id % 8 = 0 THEN 'Smith 3PT Jump Shot (3 PTS) (Jones 2 AST)'
         WHEN event_id % 8 = 1 THEN 'MISS Smith 3PT Free Throw'
         WHEN event_id % 8 = 3 THEN 'Smith Layup (Jones 1 AST)'
         WHEN event_id % 8 = 5 THEN 'Jones STEAL (1 STL)'
         ELSE event_type END AS homedescription,
    CASE WHEN event_id % 11 = 0 THEN event_type END AS neutraldescription,
    CASE WHEN event_id % 4 = 1 THEN NULL
         WHEN event_id % 9 = 0 THEN 'Brown 3PT Shot (Green 1 AST)'
         WHEN event_id % 9 = 4 THEN 'MISS Brown Hook'
         WHEN event_id % 9 = 7 THEN 'Green STEAL (2 STL)'
         ELSE 'visitor ' || event_type END AS visitordescription,
    CASE WHEN event_type = 'purchase'
         THEN CAST(event_id % 9 AS STRING) || ' - ' || CAST(event_id % 7 AS STRING)
         WHEN event_type = 'error' THEN 'n/a' END AS score,
    CAST(event_id % 9 - event_id % 7 AS STRING) AS scoremargin,
    {_PLAYERS}
FROM {{events}}
"""

PLAY_BY_PLAY = _PLAY_BY_PLAY.replace("<clock>", _CLOCK_24H)
PLAY_BY_PLAY_12H = _PLAY_BY_PLAY.replace("<clock>", _CLOCK_12H)

# Event codes 1 to 28 with up to twelve details; four codes have none.
CODES = """
SELECT event_code,
       'action ' || CAST(event_code AS STRING) AS event_action,
       event_subcode,
       min(CASE WHEN event_subcode IN (1, 2, 3, 8)
                THEN CASE p_size % 4 WHEN 0 THEN 'free throw flagrant'
                                     WHEN 1 THEN 'free throw technical'
                                     WHEN 2 THEN 'free throw clear path'
                                     ELSE 'free throw' END || ' 1 of 2'
                WHEN event_subcode IS NOT NULL THEN lower(p_type) END) AS event_subaction
FROM (
    SELECT p_size, p_type, CAST(p_partkey % 28 + 1 AS INT) AS event_code,
           CASE WHEN p_partkey % 28 + 1 NOT IN (10, 12, 14, 15)
                THEN CAST(p_size % 12 AS INT) END AS event_subcode
    FROM {part}
) AS parts
GROUP BY event_code, event_subcode
"""

# Customers in pairs: customer 2g and 2g+1 are the two teams of game g.
GAME_LOG = """
SELECT '2015-2016' AS season,
       lpad(CAST((c_custkey - c_custkey % 2) / 2 AS BIGINT) || '', 10, '0') AS gameid,
       c_custkey AS team_id,
       upper(substr(c_mktsegment, 1, 3)) || CAST(c_nationkey AS STRING) AS team_abbreviation,
       game_date,
       'T' || CAST(c_nationkey AS STRING) || CASE c_custkey % 2 WHEN 0 THEN ' vs. ' ELSE ' @ ' END
           || c_mktsegment AS matchup
FROM {customer}
LEFT JOIN (
    SELECT o_custkey - o_custkey % 2 AS pair,
           CAST(CAST(min(o_orderdate) AS DATE) AS STRING) AS game_date
    FROM {orders} GROUP BY o_custkey - o_custkey % 2
) AS dates ON c_custkey - c_custkey % 2 = pair
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def adapt(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run an adapter on Spark over the tables it names."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def plain(text: str) -> str:
    """The adapter as SQL over tables registered under their own names."""
    return text.format(**{t: t for t in TABLES})
