import json

import pytest
from pyspark.sql import functions as F

from checks import documents
from tracklane.plans import loads
from tracklane.plans.closest import closest_to_ball
from tracklane.sources import event_codes, legacy, readers, result_sets, schemas, tracking, writers


def team(number):
    players = [
        {"firstname": f"F{number}{i}", "lastname": f"L{number}{i}", "jersey": f"0{i}",
         "playerid": str(number * 10 + i), "position": "F-G"}
        for i in (1, 2)
    ]
    return {"abbreviation": f"T{number}", "teamid": 1610612760 + number, "name": f"Team {number}",
            "players": players}


def moment(at, ball=True, shot=17.5):
    entities = [[-1, -1, 31.5125, 18.0625, 2.75]] if ball else []
    entities += [[1610612761, 11, 19.5, 13.25, 0.0], [1610612762, 21, 23.0, 45.0, 0]]
    return [1, 1451700000000 + at, 640.5, shot, None, entities]


def document(gameid):
    event = {"home": team(1), "visitor": team(2)}
    return {
        "gamedate": "2016-01-01",
        "gameid": gameid,
        "events": [
            {"eventId": "3", **event, "moments": [moment(0), moment(40, shot=None)]},
            {"eventId": "5", **event, "home": team(7), "moments": [moment(80, ball=False)]},
            {"eventId": "6", **event, "moments": []},
        ],
    }


def put(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    text = content if isinstance(content, str) else json.dumps(content, indent=1)
    (folder / name).write_text(text)


def test_tracking_tables(spark, rows, tmp_path):
    put(tmp_path / "raw", "a.json", document("0021500492"))
    put(tmp_path / "raw", "b.json", document("0021500493"))
    docs = readers.read_tracking(spark, str(tmp_path / "raw"))
    positions = tracking.flatten_positions(docs)
    assert positions.schema.simpleString() == spark.createDataFrame(
        [], schemas.GAME_POSITION
    ).schema.simpleString()
    one = positions.where("gameid = '0021500492'")
    assert rows(one.where("playerid = -1"), "eventid", "moment_num", "shotclock", "x_coordinate") == [
        (3, 0, 17.5, 31.5125), (3, 1, None, 31.5125),
    ]
    assert rows(one, "season", "timestamp_dts", "timestamp_utc", "period", "periodclock")[0] == (
        "2015-2016", "2016-01-02 02:00:00Z", 1451700000000, 1, 640.5,
    )
    assert one.count() == 8 and positions.count() == 16
    assert rows(tracking.flatten_game(docs)) == [
        ("2015-2016", g, "2016-01-01", 1610612761, 1610612762) for g in ("0021500492", "0021500493")
    ]
    players = tracking.flatten_players(docs).where("gameid = '0021500492'")
    assert rows(players, "playerid", "firstname", "teamid", "jersey", "startdate") == [
        (11, "F11", 1610612761, "01", "1970-01-01"), (12, "F12", 1610612761, "02", "1970-01-01"),
        (21, "F21", 1610612762, "01", "1970-01-01"), (22, "F22", 1610612762, "02", "1970-01-01"),
    ]
    teams = tracking.flatten_teams(docs)
    assert rows(teams, "teamid", "name", "city", "state")[0] == (1610612761, "Team 1", None, None)
    ranges = positions.agg(
        F.min("period"), F.max("period"), F.min("periodclock"), F.max("periodclock"),
        F.max("shotclock"), F.min("x_coordinate"), F.max("y_coordinate"),
    ).head()
    assert 1 <= ranges[0] <= ranges[1] <= 4 and 0 <= ranges[2] <= ranges[3] <= 720
    assert ranges[4] <= 24 and ranges[5] >= -5 and ranges[6] <= 55
    assert rows(legacy.legacy_view(positions, "game_positions").limit(1), "time_stamp")
    assert rows(legacy.legacy_view(tracking.flatten_players(docs), "players"), "jersey_number")[0] == (1,)


def test_load_tracking_quarantines_and_reloads(spark, rows, tmp_path):
    put(tmp_path / "raw", "a.json", document("0021500492"))
    put(tmp_path / "raw", "broken.json", '{"gamedate": "2016-01-01", "gameid"')
    paths = [str(tmp_path / n) for n in ("raw", "tables", "manifest")]
    bad = loads.load_tracking(spark, *paths, loaded_at="2016-07-01")
    assert [r["input_filename"].endswith("broken.json") for r in bad.collect()] == [True]
    manifest = writers.load_manifest(spark, paths[2], schemas.TRACKING_MANIFEST)
    flags = {r[0].split("/")[-1]: tuple(r[1:]) for r in manifest.collect()}
    assert flags == {
        "a.json": ("0021500492", 1, 1, 1, 1, "2016-07-01"),
        "broken.json": (None, 0, 0, 0, 0, "2016-07-01"),
    }
    assert (tmp_path / "tables/gameposition/season=2015-2016/gameid=0021500492").is_dir()

    put(tmp_path / "raw", "broken.json", document("0021500493"))
    loads.load_tracking(spark, *paths, loaded_at="2016-07-02")
    for name, schema, count in (
        ("gameposition", schemas.GAME_POSITION, 16), ("gameinfo", schemas.GAME_INFO, 2),
        ("playerinfo", schemas.PLAYER_INFO, 8), ("teaminfo", schemas.TEAM_INFO, 4),
    ):
        table = readers.read_table(spark, f"{paths[1]}/{name}", schema)
        assert table.count() == count, name
        assert rows(table.select("gameid").distinct()) == [("0021500492",), ("0021500493",)]
    manifest = writers.load_manifest(spark, paths[2], schemas.TRACKING_MANIFEST)
    assert rows(manifest, "gameid", "lastuploadDTS") == [
        ("0021500492", "2016-07-02"), ("0021500493", "2016-07-02"),
    ]

    # derived table: write, record, replace one game, prune by partition
    positions = readers.read_table(spark, f"{paths[1]}/gameposition", schemas.GAME_POSITION)
    ranked = closest_to_ball(positions, "2015-2016", (21500492, 21500493))
    target, log = str(tmp_path / "closest"), str(tmp_path / "closest_manifest")
    loads.refresh_derived(ranked, target, log, "t1", params="all")
    loads.refresh_derived(ranked.where("gameid = '0021500493'"), target, log, "t2")
    stored = readers.read_table(spark, target, schemas.CLOSEST_TO_BALL)
    assert rows(stored) == rows(ranked)
    done = writers.load_manifest(spark, log, schemas.DERIVED_MANIFEST)
    assert rows(done, "gameid", "lastuploadDTS") == [("0021500492", "t1"), ("0021500493", "t2")]
    plan = closest_to_ball(positions, "2015-2016", (21500493, 21500493))._jdf.queryExecution()
    scan = next(x for x in plan.executedPlan().toString().splitlines() if "FileScan" in x)
    assert "gameid" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_refresh_closest_to_ball(spark, rows, tmp_path, request):
    for game in ("0021500492", "0021500493"):
        put(tmp_path / "raw", f"{game}.json", document(game))
    positions = tracking.flatten_positions(readers.read_tracking(spark, str(tmp_path / "raw")))
    target, log = str(tmp_path / "closest"), str(tmp_path / "log")
    loads.refresh_closest_to_ball(positions, target, log, "t1", game_range=(21500492, 21500492))
    loads.refresh_closest_to_ball(positions, target, log, "t2", pending_only=True)
    done = writers.load_manifest(spark, log, schemas.DERIVED_MANIFEST)
    assert rows(done, "gameid", "lastuploadDTS") == [("0021500492", "t1"), ("0021500493", "t2")]
    expected = rows(closest_to_ball(positions))
    assert rows(readers.read_table(spark, target, schemas.CLOSEST_TO_BALL)) == expected
    # The same with games that count as too large for one task.
    request.getfixturevalue("small_groups")
    spark.conf.set("tracklane.skew.hotRows", "3")
    again = str(tmp_path / "again")
    loads.refresh_closest_to_ball(positions, again, str(tmp_path / "log2"), "t3")
    assert rows(readers.read_table(spark, again, schemas.CLOSEST_TO_BALL)) == expected


def test_one_exchange_from_positions_to_files(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([], schemas.GAME_POSITION).write.parquet(path)
    rows = readers.read_table(spark, path, schemas.GAME_POSITION).repartition("season", "gameid")
    plan = closest_to_ball(rows, split_large=False)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Exchange") == 1


PBP_HEADERS = [n.upper() for n, _ in schemas.columns(schemas.PLAY_BY_PLAY)]


def response(*sets):
    return {"resource": "r", "parameters": {"GameID": "x"},
            "resultSets": [{"name": n, "headers": h, "rowSet": r} for n, h, r in sets]}


def free_throw(game, number, clock):
    head = [game, number, 3, 11, 1, clock, "9:42", None, None, "Free Throw 1 of 2", "5 - 4", "-1"]
    one = [5, 202694, "Name", 1610612765, "Detroit", "Pistons", "DET"]
    return head + one + [0, 0, None, None, None, None, None] * 2


def test_play_by_play(spark, rows, tmp_path):
    put(tmp_path, "a.json", response(
        ("PlayByPlay", PBP_HEADERS, [free_throw("0021500001", 15, "8:15 PM"),
                                     free_throw("0021500001", 17, None)]),
        ("AvailableVideo", ["VIDEO_AVAILABLE_FLAG"], [[1]]),
    ))
    docs = readers.read_result_sets(spark, str(tmp_path))
    df = result_sets.play_by_play(docs)
    assert dict(df.dtypes)["player1_team_id"] == "double" and dict(df.dtypes)["score"] == "string"
    assert rows(df, "game_id", "eventnum", "wctimestring", "player1_id", "player2_id", "season") == [
        ("0021500001", 15.0, "20:15:00", 202694.0, 0.0, "2015-16"),
        ("0021500001", 17.0, None, 202694.0, 0.0, "2015-16"),
    ]
    with_flag = result_sets.play_by_play(docs, keep_video_row=True)
    assert rows(with_flag, "game_id", "video_available_flag")[0] == (None, 1.0)
    view = legacy.legacy_view(df, "play_by_play")
    assert set(legacy.PRIMARY_KEYS["play_by_play"]) < set(view.columns)
    assert rows(view, "event_id", "pctimestring", "score_visitor", "score_home", "player1_id")[0] == (
        15, 582.0, 5.0, 4.0, 202694,
    )


@pytest.mark.parametrize("kind, own", [("traditional", "PTS"), ("player", "PASS")])
def test_box_score(spark, rows, tmp_path, kind, own):
    head = ["GAME_ID", "TEAM_ID", "TEAM_ABBREVIATION", "TEAM_CITY"]
    put(tmp_path, "a.json", response(
        ("PlayerStats", [*head, "PLAYER_ID", "MIN", own],
         [["0021500001", 5, "DET", "Detroit", 7, "32:44", 12], ["0021500001", 5, "DET", "D", 8, None, 3]]),
        ("PlayerStats", [own, *head, "MIN", "TEAM_NAME"], [[90, "0021500001", 5, "DET", "D", "240:00", "P"]]),
    ))
    df = result_sets.boxscore(readers.read_result_sets(spark, str(tmp_path)), kind)
    value = {"PTS": "pts", "PASS": "passes"}[own]
    assert rows(df, "player_id", "minutes", value, "team_name", "result_set") == [
        (None, "240.00", 90.0, "P", "PlayerStats"),
        (7.0, "32.44", 12.0, None, "PlayerStats"),
        (8.0, None, 3.0, None, "PlayerStats"),
    ]
    view = {"traditional": "box_score_traditional", "player": "box_score_player_tracking"}[kind]
    assert rows(legacy.legacy_view(df, view), "minutes") == [(None,), (32.44,), (240.0,)]


def gamelog_file(folder):
    heads = ["TEAM_ID", "GAME_ID", "GAME_DATE", "MATCHUP", "PTS"]
    put(folder, "log.json", response(("LeagueGameLog", heads, [
        [1, "02", "2015-10-27", "DET @ ATL", 106], [2, "02", "2015-10-27", "ATL vs. DET", 94],
        [3, "03", "2015-10-31", "CLE @ CHI", 95.0], [4, "03", "2015-10-31", "CHI vs. CLE", 97],
    ])))


def test_gamelog_then_stats(spark, rows, tmp_path):
    gamelog_file(tmp_path / "log")
    tables, log = str(tmp_path / "tables"), str(tmp_path / "log_manifest")
    loads.load_gamelog(spark, str(tmp_path / "log"), tables, log, "now", base_url="u", params="p")
    schema = schemas.GAME_LOG.replace("game_id", "gameid") + ", season string"
    stored = readers.read_table(spark, f"{tables}/gamelog", schema)
    assert rows(stored, "season", "gameid", "team_id", "pts") == [
        ("2015-2016", "02", 1, 106), ("2015-2016", "02", 2, 94),
        ("2015-2016", "03", 3, 95), ("2015-2016", "03", 4, 97),
    ]
    assert rows(loads.season_bounds(stored)) == [("2015-2016", "10/27/2015", "10/31/2015")]
    manifest = writers.load_manifest(spark, log, schemas.GAME_LOG_MANIFEST)
    assert rows(manifest, "game_id", "team1", "team2", "gamelog_uploadedFLG", "base_url") == [
        ("02", "DET", "ATL", 1, "u"), ("02", "DET", "ATL", 1, "u"),
        ("03", "CLE", "CHI", 1, "u"), ("03", "CLE", "CHI", 1, "u"),
    ]
    assert rows(loads.games_between(manifest), "game_id", "team1", "team2") == [
        ("02", "DET", "ATL"), ("03", "CLE", "CHI"),
    ]
    assert rows(loads.games_between(manifest, "2015-10-28"), "game_id") == [("03",)]
    assert rows(loads.games_between(manifest, None, "2015-10-28"), "game_id") == [("02",)]

    put(tmp_path / "pbp", "02.json",
        response(("PlayByPlay", PBP_HEADERS, [free_throw("02", 15, "8:15 PM")])))
    put(tmp_path / "pbp", "03.json", "{oops")
    put(tmp_path / "pbp", "04.json",
        response(("PlayByPlay", PBP_HEADERS, [free_throw("04", 1, "8:15 PM")])))
    done = str(tmp_path / "stats_manifest")
    games = loads.games_between(manifest)
    loads.load_stats(spark, str(tmp_path / "pbp"), tables, "playbyplay", games, done, "now")
    schema = schemas.PLAY_BY_PLAY.replace("game_id", "gameid") + ", season string"
    stored = readers.read_table(spark, f"{tables}/playbyplay", schema)
    assert rows(stored, "season", "gameid", "eventnum") == [("2015-2016", "02", 15.0)]
    assert rows(
        writers.load_manifest(spark, done, schemas.STATS_MANIFEST), "game_id", "fileuploadedFLG"
    ) == [("02", 1), ("03", 0)]


@pytest.mark.parametrize("large", [False, True])
def test_csv_loads(spark, rows, tmp_path, request, large):
    if large:
        request.getfixturevalue("small_groups")
    schema = "game_id string, player_id int, name string"
    table, csv = str(tmp_path / "t"), tmp_path / "new.csv"
    spark.createDataFrame([("02", 1, "old"), ("02", 1, "old")], schema).write.parquet(table)
    csv.write_text("game_id,player_id,name\n02,1,new\n02,2,\n03,2,b\n03,2,a\n")
    version = str(tmp_path / "t2")
    loads.append_csv_distinct(spark, str(csv), table, schema, version)
    assert rows(readers.read_table(spark, version, schema)) == [
        ("02", 1, "new"), ("02", 1, "old"), ("02", 2, None), ("03", 2, "a"), ("03", 2, "b"),
    ]
    loads.insert_csv(spark, str(csv), table, schema, ["game_id", "player_id"], ["name"])
    assert rows(readers.read_table(spark, table, schema)) == [
        ("02", 1, "old"), ("02", 1, "old"), ("02", 2, None), ("03", 2, "a"),
    ]


def test_shooting_side_manifest(spark, rows):
    sides = spark.createDataFrame(
        [("2015-10-27", "DET", 1.0, "s", "02"), ("2015-10-27", "ATL", 1.0, "s", "02"),
         ("2015-10-27", "XXX", 2.0, "s", "02")],
        "game_date string, team_abbreviation string, period double, season string, gameid string",
    )
    assert rows(loads.shooting_side_manifest(sides, "now")) == [
        ("s", "02", "20151027", "ATL", "DET", 1, "now"),
    ]


def test_event_codes(spark, rows, tmp_path):
    put(tmp_path, "codes.xml", """<?xml version="1.0"?><stats><codes><version number="3"/><event-codes>
      <event id="5" text="Offensive Rebound"><detail id="1" text="Placeholder"/></event>
      <event id="10" text="Substitution"/>
      <event id="11" text="Timeout"><detail id="1" text="Regular"/><detail id="2" text="Short"/></event>
    </event-codes></codes></stats>""")
    events = readers.read_event_codes(spark, str(tmp_path / "codes.xml"))
    assert rows(event_codes.event_codes(events)) == [
        (5, "offensive rebound", 1, "placeholder"), (10, "substitution", None, None),
        (11, "timeout", 1, "regular"), (11, "timeout", 2, "short"),
    ]
    assert rows(event_codes.event_codes_legacy(events))[1] == (10, "Substitution", -1, "None")
    assert rows(event_codes.event_code_names(events))[0] == ("10", "Substitution")


def test_file_catalogue(spark, rows):
    paths = spark.createDataFrame(
        [("2015-2016/rawdata/01.05.2016.CHA.at.TOR.7z",), ("2015-2016/Raw/01.05.2016.A.7z",),
         ("2015-2016/rawdata/notes.txt",), ("2014-2015/rawdata/12.1.2014.A.at.B.7z",)],
        "key string",
    )
    found = readers.file_catalogue(paths, "key")
    assert [(r[1], str(r[2])) for r in found.orderBy("season").collect()] == [
        ("2014-2015", "2014-12-01"), ("2015-2016", "2016-01-05"),
    ]


def test_manifest_of_the_wrong_shape_is_refused(spark, tmp_path):
    path = str(tmp_path / "m")
    assert writers.load_manifest(spark, path, schemas.DERIVED_MANIFEST).count() == 0
    spark.createDataFrame([("1", "s")], "gameid string, season string").write.parquet(path)
    with pytest.raises(ValueError, match="column order"):
        writers.load_manifest(spark, path, schemas.DERIVED_MANIFEST)


def test_create_table_as_keeps_an_existing_table(spark, rows, tmp_path):
    path = str(tmp_path / "sides")
    one = spark.createDataFrame([("s", "02", 1)], "season string, gameid string, v int")
    writers.create_table_as(one, "sides_for_test", path)
    writers.create_table_as(one.withColumn("v", F.lit(2)), "sides_for_test", path)
    assert rows(spark.table("sides_for_test"), "gameid", "v") == [("02", 1)]
    spark.sql("DROP TABLE sides_for_test")


def test_a_large_partition_is_cut_over_several_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(200_000).select(
            F.lit("s").alias("season"),
            F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 5).cast("string")).alias("gameid"),
            F.xxhash64("id").alias("v"),
        )
        writers.write_table(df.repartition(16), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t/season=s/gameid=hot").glob("*.parquet"))) > 1
    assert readers.read_table(spark, path, "season string, gameid string, v bigint").count() == 200_000


def test_documents_with_wrong_values_or_without_id_write_nothing(spark, rows, tmp_path):
    wrong, nameless = document("0021500494"), document(None)
    wrong["events"][0]["home"]["teamid"] = "abc"
    for name, content in (("a", document("0021500492")), ("b", wrong), ("c", nameless)):
        put(tmp_path / "raw", f"{name}.json", content)
    paths = [str(tmp_path / n) for n in ("raw", "tables", "manifest")]
    bad = loads.load_tracking(spark, *paths, loaded_at="2016-07-01")
    assert rows(bad.select(F.substring_index("input_filename", "/", -1))) == [("b.json",), ("c.json",)]
    for name in ("gameposition", "gameinfo", "playerinfo", "teaminfo"):
        table = spark.read.parquet(f"{paths[1]}/{name}")
        assert rows(table.select("gameid").distinct()) == [("0021500492",)], name
    manifest = writers.load_manifest(spark, paths[2], schemas.TRACKING_MANIFEST)
    flags = {r[0][-6:]: set(r[2:6]) for r in manifest.collect()}
    assert flags == {"a.json": {1}, "b.json": {0}, "c.json": {0}}


def test_partly_broken_responses_write_nothing(spark, rows, tmp_path):
    gamelog_file(tmp_path / "log")
    put(tmp_path / "log", "broken.json", '{"resource": "x", "resultSets": [{"name": "Leag')
    tables, log = str(tmp_path / "tables"), str(tmp_path / "log_manifest")
    bad = loads.load_gamelog(spark, str(tmp_path / "log"), tables, log, "now")
    assert [r["input_filename"].endswith("broken.json") for r in bad.collect()] == [True]
    manifest = writers.load_manifest(spark, log, schemas.GAME_LOG_MANIFEST)
    assert rows(manifest.where("gamelog_uploadedFLG = 0"), "game_id", "lastuploadDTS") == [(None, "now")]

    good = response(("PlayByPlay", PBP_HEADERS, [free_throw("02", 15, "8:15 PM")]))
    good["resultSets"].append({"name": "AvailableVideo", "headers": "none", "rowSet": 7})
    put(tmp_path / "pbp", "02.json", good)
    games = loads.games_between(manifest.where("gamelog_uploadedFLG = 1"))
    bad = loads.load_stats(
        spark, str(tmp_path / "pbp"), tables, "playbyplay", games, str(tmp_path / "done"), "now"
    )
    assert bad.count() == 1
    done = writers.load_manifest(spark, str(tmp_path / "done"), schemas.STATS_MANIFEST)
    assert rows(done, "game_id", "fileuploadedFLG") == [("02", 0), ("03", 0)]


def test_a_game_that_becomes_empty_loses_its_rows(spark, rows, tmp_path):
    schema = "v int, season string, gameid string"
    target, log = str(tmp_path / "derived"), str(tmp_path / "log")
    first = spark.createDataFrame([(1, "s", "01"), (2, "s", "02"), (3, "s", "03")], schema)
    loads.refresh_derived(first, target, log, "t1")
    asked = first.where("gameid < '03'")
    loads.refresh_derived(first.where("gameid = '01'"), target, log, "t2", games=asked)
    stored = readers.read_table(spark, target, schema)
    assert rows(stored, "v", "gameid") == [(1, "01"), (3, "03")]
    # a game that has rows again is back; one that is emptied again is gone again
    loads.refresh_derived(first.where("gameid = '02'"), target, log, "t2", games=asked.where("gameid = '02'"))
    assert rows(readers.read_table(spark, target, schema), "v") == [(1,), (2,), (3,)]
    loads.refresh_derived(first.where("false"), target, log, "t2", games=asked.where("gameid = '02'"))
    assert rows(readers.read_table(spark, target, schema), "v") == [(1,), (3,)]
    loads.refresh_derived(first.where("gameid = '02'"), target, log, "t2")
    assert rows(readers.read_table(spark, target, schema), "v") == [(1,), (2,), (3,)]
    done = writers.load_manifest(spark, log, schemas.DERIVED_MANIFEST)
    assert rows(done, "gameid", "lastuploadDTS") == [("01", "t2"), ("02", "t2"), ("03", "t1")]


def test_manifests_are_logs(spark, rows, tmp_path):
    path, schema = str(tmp_path / "m"), schemas.DERIVED_MANIFEST

    def add(*some):
        writers.record(spark.createDataFrame(list(some), schema), path, schema)

    add(("s", "01", "a", 1, "t5"), ("s", "02", "a", 1, "t1"), ("s", "02", "b", 0, "t2"))
    # the later batch counts, whatever time stamp it names
    add(("s", "01", "c", 0, "t1"))
    latest = writers.load_manifest(spark, path, schema)
    assert rows(latest, "gameid", "params") == [("01", "c"), ("02", "b")]
    assert latest.columns == [n for n, _ in schemas.columns(schema)]
    # a batch that was not committed leaves a folder that readers skip
    (tmp_path / "m" / "_temporary").mkdir()
    (tmp_path / "m" / "_temporary" / "part-1.parquet").write_text("half")
    assert rows(writers.load_manifest(spark, path, schema), "gameid") == [("01",), ("02",)]
    with pytest.raises(ValueError, match="column order"):
        writers.record(latest.select("gameid", "season"), path, schema)


def test_writers_use_no_internals():
    import inspect

    assert "_jvm" not in inspect.getsource(writers) and "toLocalIterator" not in inspect.getsource(writers)


def test_games_that_a_response_names(spark):
    rows = [["1", "0021"], ["2", None], ["3", "0022"], ["4", "0021"], ["5"], None]
    docs = spark.createDataFrame(
        [
            (1, [("A", ["N", "Game_ID"], rows), ("B", None, [["0023"]]), ("C", ["GAME_ID"], None)]),
            (2, [("D", ["X"], [["0024"]]), None]),
            (3, None),
        ],
        "k int, resultSets array<struct<name:string,headers:array<string>,"
        "rowSet:array<array<string>>>>",
    )
    found = docs.select("k", result_sets.game_ids().alias("ids")).collect()
    ids = {r.k: sorted(r.ids or []) for r in found}
    assert ids == {1: ["0021", "0022"], 2: [], 3: []}
    typed = result_sets.result_sets_to_df(docs, "game_id string").where("game_id IS NOT NULL")
    assert {r.game_id for r in typed.collect()} == {"0021", "0022"}


def test_headers_are_found_in_any_case_and_the_first_counts(spark, rows):
    """A NULL header, one that comes twice, a set without rows and one without headers."""
    sets = [
        ("a", [None, "PTS", "Game_ID", "pts"], [["x", "1", "g1", "2"], ["x", None, "g2", "3"]]),
        ("b", ["game_id"], []),
        ("c", None, [["g3"]]),
        ("d", ["REB"], [["7"]]),
    ]
    schema = schemas.RESULT_SET_DOCUMENT
    docs = spark.createDataFrame([(None, sets), (None, None), (None, [None])], schema)
    table = result_sets.result_sets_to_df(docs, "game_id string, pts bigint")
    assert rows(table, "result_set", "game_id", "pts") == [
        ("a", "g1", 1), ("a", "g2", None), ("c", None, None), ("d", None, None),
    ]


def test_sets_are_expanded_without_being_rebuilt(spark):
    docs = spark.createDataFrame([(None, [("a", ["PTS"], [["1"]])])], schemas.RESULT_SET_DOCUMENT)
    plan = result_sets.result_sets_to_df(docs, "pts bigint")._jdf.queryExecution().toString()
    optimized = plan.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert not [line for line in optimized.split("\n") if "explode(transform" in line]


def test_documents_are_made_by_as_many_tasks_as_shuffles_have(spark, tmp_path):
    """Adaptive execution does not merge them, and each text is made before it is parsed."""
    table = spark.range(200).selectExpr("id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey",
                                        "CAST(id AS INT) AS l_linenumber", "1.5D AS l_quantity",
                                        "2D AS l_extendedprice", "0.1D AS l_discount",
                                        "'R' AS l_returnflag")
    table.write.parquet(str(tmp_path / "lineitem.parquet"))
    docs = documents.box_score_documents(spark, str(tmp_path), "traditional")
    assert docs.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("\n") if "Generate" in line and "concat(" in line]
    assert docs.count() == 200
