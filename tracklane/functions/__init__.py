"""Column expressions shared by the operators and presets."""

from tracklane.functions.scalars import (  # noqa: F401
    clock_seconds,
    compact_date,
    court_side,
    epoch_ms_text,
    minutes_text,
    matchup_teams,
    path_value,
    score_pair,
    season_long,
    season_short,
    squared_distance,
    us_date,
    wall_clock_24h,
)
