"""Schemas of the raw documents and of the stored tables, as DDL strings."""

from __future__ import annotations

_TEAM = (
    "struct<abbreviation:string,teamid:bigint,name:string,players:array<struct<"
    "firstname:string,lastname:string,jersey:string,playerid:string,position:string>>>"
)

# A moment mixes numbers, a null and a nested array. Read as text, every element
# keeps its raw JSON.
TRACKING_DOCUMENT = (
    "gamedate string, gameid string, events array<struct<eventId:string,"
    f"home:{_TEAM},visitor:{_TEAM},moments:array<array<string>>>>"
)

RESULT_SET_DOCUMENT = (
    "resource string, resultSets array<struct<name:string,headers:array<string>,"
    "rowSet:array<array<string>>>>"
)

_PLAY_BY_PLAY_HEAD = (
    "game_id string, eventnum double, eventmsgtype double, eventmsgactiontype double, "
    "period double, wctimestring string, pctimestring string, homedescription string, "
    "neutraldescription string, visitordescription string, score string, scoremargin string"
)
_PLAY_BY_PLAY_PLAYER = (
    "person{i}type double, player{i}_id double, player{i}_name string, "
    "player{i}_team_id double, player{i}_team_city string, "
    "player{i}_team_nickname string, player{i}_team_abbreviation string"
)
PLAY_BY_PLAY = ", ".join(
    [_PLAY_BY_PLAY_HEAD, *(_PLAY_BY_PLAY_PLAYER.format(i=i) for i in (1, 2, 3))]
)

_BOX_HEAD = (
    "game_id string, team_id bigint, team_abbreviation string, team_city string, "
    "player_id double, player_name string, start_position string, comment string, min string"
)


def _doubles(names: str) -> str:
    return ", ".join(f"{n} double" for n in names.split())


BOX_SCORE_TRADITIONAL = ", ".join(
    [
        _BOX_HEAD,
        _doubles(
            "fgm fga fg_pct fg3m fg3a fg3_pct ftm fta ft_pct oreb dreb reb ast stl blk to pf pts "
            "plus_minus"
        ),
        "team_name string, starters_bench string",
    ]
)
BOX_SCORE_PLAYER = ", ".join(
    [
        _BOX_HEAD,
        _doubles(
            "spd dist orbc drbc rbc tchs sast ftast pass ast cfgm cfga cfg_pct ufgm ufga ufg_pct "
            "fg_pct dfgm dfga dfg_pct"
        ),
        "team_name string",
    ]
)
GAME_LOG = (
    "season_id string, team_id bigint, team_abbreviation string, team_name string, "
    "game_id string, game_date string, matchup string, wl string, min bigint, fgm bigint, "
    "fga bigint, fg_pct double, fg3m bigint, fg3a bigint, fg3_pct double, ftm bigint, "
    "fta bigint, ft_pct double, oreb bigint, dreb bigint, reb bigint, ast bigint, stl bigint, "
    "blk bigint, tov bigint, pf bigint, pts bigint, plus_minus bigint, video_available bigint"
)

GAME_POSITION = (
    "season string, gameid string, eventid bigint, moment_num bigint, timestamp_dts string, "
    "timestamp_utc bigint, period bigint, periodclock double, shotclock double, teamid bigint, "
    "playerid bigint, x_coordinate double, y_coordinate double, z_coordinate double"
)
PLAYER_INFO = (
    "season string, gameid string, playerid bigint, firstname string, lastname string, "
    "teamid bigint, position string, jersey string, startdate string, enddate string"
)
TEAM_INFO = (
    "season string, gameid string, teamid bigint, name string, conference string, "
    "division string, city string, state string, startdate string, enddate string"
)
GAME_INFO = (
    "season string, gameid string, gamedate string, home_teamid bigint, visitor_teamid bigint"
)
EVENT_CODES = (
    "event_code int, event_action string, event_subcode int, event_subaction string"
)
CLOSEST_TO_BALL = (
    "eventid bigint, moment_num bigint, timestamp_dts string, timestamp_utc bigint, "
    "period bigint, periodclock double, shotclock double, teamid bigint, playerid bigint, "
    "x_coordinate double, y_coordinate double, z_coordinate double, "
    "distance_from_ball_sq double, closest_to_ball_rank bigint, season string, gameid string"
)
TEAM_SHOOTING_SIDE = (
    "game_date string, teamid bigint, team_abbreviation string, period double, "
    "shooting_side string, lastupdate_dts string, season string, gameid string"
)
PLAYER_ACTIONS = (
    "eventnum double, period double, wctimestring string, pctimestring string, "
    "period_time bigint, eventmsgtype double, eventmsgactiontype double, event_action string, "
    "event_subaction string, event_subsubaction string, description string, is_home int, "
    "playerid double, playername string, player_teamid double, player_team_city string, "
    "player_team_abbreviation string, season string, gameid string"
)
GAME_POSSESSION = (
    "game_id string, event_id bigint, time_stamp timestamp, player_id bigint, "
    "minimum_distance_sq double, length_possession bigint"
)

TRACKING_MANIFEST = (
    "input_filename string, gameid string, gameinfo_uploadedFLG int, "
    "gameposition_uploadedFLG int, playerinfo_uploadedFLG int, teaminfo_uploadedFLG int, "
    "lastuploadDTS string"
)
STATS_MANIFEST = (
    "season string, game_date string, game_id string, team1 string, team2 string, "
    "fileuploadedFLG int, lastuploadDTS string, base_url string, params string"
)
GAME_LOG_MANIFEST = STATS_MANIFEST.replace("fileuploadedFLG", "gamelog_uploadedFLG")
SHOOTING_SIDE_MANIFEST = (
    "season string, gameid string, gamedate string, teamid1 string, teamid2 string, "
    "uploadedFLG int, lastuploadDTS string"
)
DERIVED_MANIFEST = (
    "season string, gameid string, params string, uploadedFLG int, lastuploadDTS string"
)


def columns(ddl: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a flat DDL string."""
    return [tuple(part.strip().split(" ", 1)) for part in ddl.split(",")]
