"""Mixed files: each text is made and read once, odd ones go to the files of neither layout or give no rows."""

import json

from pyspark.sql import functions as F

from rimsight.operators import plays

GAME = {"Date": "1997-01-02", "HomeTeam": {"Name": "A"}, "VisitingTeam": {"Name": "B"}}
PLAY = {"Type": "LAYUP", "Action": "GOOD", "Period": 1, "ClockSeconds": 30, "Id": 7, "Team": "HomeTeam", "Player": {"Team": "VisitingTeam", "UniformNumber": "4"}}
OTHER = {"play_action_sub_type": "layup", "name_tabular": "TA", "play_successful": True, "period_number": 2, "play_time": "01:05:00", "id": 9}
DATA = {
    "game_date": "2000-01-02", "competitors": [{"schoolId": 1, "nameTabular": "A"}, {"schoolId": 2, "nameTabular": "B"}],
    "actions": {"data": [{"school_id": 1, "action": OTHER}, {"school_id": 1, "action": {**OTHER, "play_action_sub_type": "jumper"}}]},
}


def _teams(spark):
    rows = [(1, "TA", "A"), (2, "TA", None), (3, "TB", "B")]
    return spark.createDataFrame(rows, "ncaa_id int, team string, stats_name string")


def test_each_text_is_made_once(spark, capsys):
    made = spark.range(3).select(F.lit(1).alias("ncaa_id"), F.col("id").cast("string").alias("game_id"), F.concat(F.lit("body"), F.col("id").cast("string")).alias("body"))
    for part in plays.routed_layups(made, _teams(spark)):
        part.explain()
        assert capsys.readouterr().out.count("concat(body") == 1


def test_odd_bodies(spark):
    own = {**PLAY, "Player": None}
    bodies = [
        (3, {"Game": GAME, "Plays": [PLAY, {**PLAY, "Type": "DUNK"}, own]}),  # the visitor's is tracked
        (1, {"Game": GAME, "Plays": [own], "data": DATA}),  # both: the first layout
        (2, {"Game": GAME, "Plays": [own]}),  # no name of the first layout
        (2, {"data": DATA}),  # falls back to the other name
        (1, {"data": DATA}),
        (1, {"Plays": "x"}), (1, {"Plays": []}), (1, {"data": {}}), (1, {"Plays": None}), (1, {}), (1, None), (1, []),
    ]
    texts = [(t, str(k), json.dumps(b)) for k, (t, b) in enumerate(bodies)] + [(1, "12", None), (1, "13", "{broken")]
    rows, neither = plays.routed_layups(spark.createDataFrame(texts, "ncaa_id int, game_id string, body string"), _teams(spark))
    first = ("1997-01-02", "B", "A", "GOOD", 1, 30, "4", 7)
    assert sorted(tuple(r) for r in rows.collect()) == [
        (1, "1", "1997-01-02", "A", "B", "GOOD", 1, 30, None, 7),
        (2, "3", "2000-01-02", "TA", "B", "GOOD", 2, 65, None, 9),
        (3, "0", *first),
    ]
    assert rows.columns == ["ncaa_id", "game_id", "date", "team", "opponent", "action", "period", "seconds", "uniform", "play_id"]
    assert sorted(int(r.game_id) for r in neither.collect()) == [8, 9, 10, 11, 12, 13]
