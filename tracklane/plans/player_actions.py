"""Play-by-play turned into one row per player action.

One scan of the play-by-play table. Each event is expanded into the at most three
actions its type stands for, and one join against a small lookup gives the action
texts. The rules below are data: which player acts, under which condition, and
which part of the lookup describes the action.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklane.functions import clock_seconds
from tracklane.operators.skew import bounded_broadcast
from tracklane.plans.closest import in_games
from tracklane.sources.event_codes import with_message_type

MADE, MISSED, FREE_THROW, REBOUND, TURNOVER, FOUL, SUBSTITUTION, JUMP_BALL = 1, 2, 3, 4, 5, 6, 8, 10
HANDLED = (MADE, MISSED, FREE_THROW, REBOUND, TURNOVER, FOUL, SUBSTITUTION, JUMP_BALL)
ASSIST = 25

# Shot texts by action code, for codes the dictionary lacks or
# numbers differently. The two lists differ in code 102.
SHOT_TEXTS = {
    1: "jump shot",
    5: "layup shot",
    7: "slam dunk shot",
    57: "hook shot",
    71: "finger roll layup shot",
    73: "driving reverse layup shot",
    75: "driving finger roll layup shot",
    76: "running finger roll layup shot",
    79: "pull up jump shot",
    81: "pull up bank jump shot",
    85: "turnaround bank jump shot",
    87: "putback slam dunk shot",
    102: "driving floating bank jump shot",
    106: "running aley oop dunk shot",
    107: "tip dunk shot",
    108: "cutting dunk shot",
    109: "driving reverse dunk shot",
}
MISSED_SHOT_TEXTS = {**SHOT_TEXTS, 102: "driving bank jump shot"}

OUTPUT = [
    "eventnum",
    "period",
    "wctimestring",
    "pctimestring",
    "period_time",
    "eventmsgtype",
    "eventmsgactiontype",
    "event_action",
    "event_subaction",
    "event_subsubaction",
    "description",
    "is_home",
    "playerid",
    "playername",
    "player_teamid",
    "player_team_city",
    "player_team_abbreviation",
    "season",
    "gameid",
]

# How an action finds its texts. The first group keeps actions without a match,
# the second drops them.
BY_SUBCODE, BY_TYPE, NO_LOOKUP = "subcode", "type", "none"
FREE_THROWS, REBOUNDS, OUT_OF_BOUNDS = "free throw", "rebound", "out of bounds"
MUST_MATCH = (FREE_THROWS, REBOUNDS, OUT_OF_BOUNDS)


def _lookup(codes: DataFrame) -> DataFrame:
    """All texts an action may refer to, keyed by (lookup, type, code).

    Lookups by type alone have no code; -1 stands in for it on both sides. The
    frame has a few rows per dictionary entry.
    """
    by_code, any_code = F.col("event_subcode").cast("double"), F.lit(-1.0)

    def entry(name: str, code: Column, condition: Column) -> Column:
        row = F.struct(F.lit(name).alias("lookup"), code.alias("lookup_code"))
        return F.when(condition & code.isNotNull(), row)

    entries = F.array(
        entry(BY_SUBCODE, by_code, F.lit(True)),
        entry(BY_TYPE, any_code, F.lit(True)),
        # Both free throw codes and both rebound codes share one message type;
        # the first of each stands for it.
        entry(FREE_THROWS, by_code, F.col("event_code") == 1),
        entry(REBOUNDS, any_code, F.col("event_code") == 5),
        # Turnover code 40 is described by subcode 3.
        entry(OUT_OF_BOUNDS, any_code, F.col("event_subcode") == 3),
    )
    return (
        with_message_type(codes)
        .where(F.col("eventmsgtype").isNotNull())
        .withColumn("_e", F.explode(entries))
        .where(F.col("_e").isNotNull())
        .select(
            "_e.lookup",
            F.col("eventmsgtype").cast("double").alias("lookup_type"),
            "_e.lookup_code",
            F.col("event_action").alias("found_action"),
            F.col("event_subaction").alias("found_subaction"),
        )
    )


def _either(pattern: str) -> Column:
    return F.col("homedescription").like(pattern) | F.col("visitordescription").like(pattern)


def _action(slot: int, lookup: str, action=None, text=None, detail=None, kind=None) -> Column:
    """One candidate action of an event. ``action`` and ``text`` replace what the
    lookup would give, ``kind`` the event's message type; ``detail`` is the third
    level, which no lookup has."""

    def column(value) -> Column:
        return value if isinstance(value, Column) else F.lit(value).cast("string")

    by_code = lookup in (BY_SUBCODE, FREE_THROWS)
    return F.struct(
        F.lit(slot).alias("slot"),
        F.lit(lookup).alias("lookup"),
        (F.col("eventmsgactiontype").cast("double") if by_code else F.lit(-1.0)).alias("code"),
        column(action).alias("action"),
        column(text).alias("text"),
        column(detail).alias("detail"),
        F.lit(kind).cast("double").alias("kind"),
    )


def _actions() -> Column:
    """Array of candidate actions by message type; entries that do not apply are NULL."""
    kind, code = F.col("eventmsgtype"), F.col("eventmsgactiontype")

    def shot(outcome: str, texts: dict) -> Column:
        points = F.when(_either("% 3PT %"), f"3pt {outcome}").otherwise(f"2pt {outcome}")
        pairs = [F.lit(v) for code, text in texts.items() for v in (float(code), text)]
        listed = _action(
            1,
            NO_LOOKUP,
            action=f"field goal {outcome}",
            text=F.try_element_at(F.create_map(*pairs), code.cast("double")),
            detail=points,
        )
        return F.when(code.isin(*texts), listed).when(
            ~code.isin(*texts), _action(1, BY_SUBCODE, detail=points)
        )

    outcome = F.when(_either("MISS %"), "free throw missed").otherwise("free throw made")
    has_second = F.col("player2_id").isNotNull()
    table = {
        MADE: [
            shot("made", SHOT_TEXTS),
            F.when(_either("% AST)"), _action(2, NO_LOOKUP, action="assist", kind=ASSIST)),
        ],
        MISSED: [shot("missed", MISSED_SHOT_TEXTS)],
        FREE_THROW: [_action(1, FREE_THROWS, action=outcome)],
        REBOUND: [_action(1, REBOUNDS, action="rebound")],
        TURNOVER: [
            F.when(_either("% STEAL %"), _action(2, BY_SUBCODE, action="steal")),
            F.when(code == 40, _action(1, OUT_OF_BOUNDS)).when(code != 40, _action(1, BY_SUBCODE)),
        ],
        FOUL: [
            F.when(has_second, _action(2, BY_SUBCODE, detail="got fouled")),
            _action(1, BY_SUBCODE, detail="committed fouled"),
        ],
        SUBSTITUTION: [
            F.when(has_second, _action(2, BY_TYPE, detail="subbed in")),
            _action(1, BY_TYPE, detail="subbed out"),
        ],
        JUMP_BALL: [
            _action(1, BY_TYPE),
            _action(2, BY_TYPE),
            _action(3, BY_TYPE, detail="jump ball tip"),
        ],
    }
    result = F.when(~kind.isin(*HANDLED), F.array(_action(1, BY_SUBCODE)))
    for value, entries in table.items():
        result = result.when(kind == value, F.array(*entries))
    return result


def _player(field: str) -> Column:
    slot = F.col("_a.slot")
    return (
        F.when(slot == 1, F.col(f"player1_{field}"))
        .when(slot == 2, F.col(f"player2_{field}"))
        .when(slot == 3, F.col(f"player3_{field}"))
    )


def player_actions(
    playbyplay: DataFrame,
    codes: DataFrame,
    season=None,
    game_range=None,
    drop_zero_ids: bool = False,
) -> DataFrame:
    """One row per action: shots, assists, free throws, rebounds, steals, turnovers,
    fouls, substitutions, jump balls and everything else.

    ``codes`` is the event-code dictionary. ``is_home`` says whether the row has a
    home description, which is also the description preferred. Raw rows mark a
    missing player with id 0; ``drop_zero_ids`` leaves such actions out.
    """
    expanded = in_games(playbyplay, season, game_range).withColumn("_a", F.explode(_actions()))
    joined = expanded.where(F.col("_a").isNotNull()).join(
        bounded_broadcast(_lookup(codes)),
        (F.col("_a.lookup") == F.col("lookup"))
        & (F.col("eventmsgtype").cast("double") == F.col("lookup_type"))
        & (F.col("_a.code") == F.col("lookup_code")),
        "left",
    )
    unmatched = F.col("lookup").isNull() & F.col("_a.lookup").isin(*MUST_MATCH)
    text = F.coalesce(F.col("_a.text"), F.col("found_subaction"))
    free_throw_kind = (
        F.when(text.like("% flagrant%"), "flagrant")
        .when(text.like("% technical%"), "technical")
        .when(text.like("% clear path%"), "clear path")
    )
    is_assist = F.col("_a.kind").isNotNull()
    result = joined.where(~unmatched).select(
        "eventnum",
        "period",
        "wctimestring",
        "pctimestring",
        clock_seconds("pctimestring").alias("period_time"),
        F.coalesce(F.col("_a.kind"), F.col("eventmsgtype")).alias("eventmsgtype"),
        F.when(~is_assist, F.col("eventmsgactiontype")).alias("eventmsgactiontype"),
        F.coalesce(F.col("_a.action"), F.col("found_action")).alias("event_action"),
        text.alias("event_subaction"),
        F.when(F.col("_a.lookup") == FREE_THROWS, free_throw_kind)
        .otherwise(F.col("_a.detail"))
        .alias("event_subsubaction"),
        F.coalesce("homedescription", "visitordescription").alias("description"),
        F.when(F.col("homedescription").isNotNull(), 1).otherwise(0).alias("is_home"),
        _player("id").alias("playerid"),
        _player("name").alias("playername"),
        _player("team_id").alias("player_teamid"),
        _player("team_city").alias("player_team_city"),
        _player("team_abbreviation").alias("player_team_abbreviation"),
        "season",
        "gameid",
    )
    if drop_zero_ids:
        result = result.where(F.coalesce(F.col("playerid") != 0, F.lit(True)))
    return result
