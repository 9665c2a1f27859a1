import json

import pytest

from meshfeed.operators.columns import rename_columns
from meshfeed.plans import activation
from meshfeed.sources.tables import read_csv

HEADER = "id,hr,mins,sec,mdn1,mdn2,mdn3,date_1,date_2,date_3,AVG_SCORE_1_3"


def line(key, score, header=HEADER):
    return f"{key},1,2,3,a,b,c,2024-01-01,2024-01-02,2024-01-03,{score}"


def report(spark, tmp_path, scores, header=HEADER):
    rows = [line(i, s) for i, s in enumerate(scores)]
    (tmp_path / "report.csv").write_text("\n".join([header, *rows]) + "\n")
    return read_csv(spark, str(tmp_path), infer=True)


def sent(df):
    return sorted((json.loads(r.value) for r in df.collect()), key=lambda m: m["id"])


def test_strictly_below_and_missing_excluded(spark, tmp_path):
    df = report(spark, tmp_path, [84.5, 85, 100, "", 12])
    messages = sent(activation.low_score_feed(df))
    assert [m["id"] for m in messages] == [0, 4]
    assert messages[0] == {
        "id": 0,
        "outage_date_1": "2024-01-01",
        "outage_date_2": "2024-01-02",
        "outage_date_3": "2024-01-03",
        "AVG_SCORE_1_3": 84.5,
    }


def test_score_that_is_text_somewhere_does_not_stop_the_job(spark, tmp_path):
    df = report(spark, tmp_path, ["84.5", "n/a", "90"])
    assert dict(df.dtypes)["AVG_SCORE_1_3"] == "string"
    assert [m["id"] for m in sent(activation.low_score_feed(df))] == [0]


def test_trial_takes_first_rows_whatever_the_score(spark, tmp_path):
    header = HEADER.replace("date_", "date")
    df = report(spark, tmp_path, [99, 98, 1], header)
    messages = sent(activation.trial_feed(df.repartition(3), ["id"]))
    assert [m["id"] for m in messages] == [0, 1]
    assert "outage_date_1" in messages[0]


def test_other_spelling_is_passed_over_unless_strict(spark, tmp_path):
    df = report(spark, tmp_path, [1])
    assert "date_1" in activation.activation_rows(df, activation.TRIAL_RENAMED).columns
    with pytest.raises(ValueError, match="date1"):
        rename_columns(df, activation.TRIAL_RENAMED, strict=True)
