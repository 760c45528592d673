import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fairway.sources import ingest
from tests.conftest import ts

EVENT_LIST = [
    {"calendar_year": 2023, "date": "2023-09-10", "event_id": 812, "event_name": "Harbour Trophy",
     "sg_categories": "no", "traditional_stats": "yes", "tour": "kft"},
    {"calendar_year": 2023, "date": "2023-09-10", "event_id": 812, "event_name": "Harbour Trophy",
     "sg_categories": "yes", "traditional_stats": "yes", "tour": "pga"},
    {"calendar_year": 2023, "date": "2023-09-10", "event_id": 61, "event_name": "Elsewhere",
     "sg_categories": "no", "traditional_stats": "yes", "tour": "euro"},
]

# Invented rounds: (score, sg_app, sg_arg, sg_ott, sg_putt, sg_t2g, sg_total, teetime text)
ROUNDS = [(71, 0.11, 0.52, -0.4, 0.9, 0.23, 1.13, "2:45pm"),
          (68, 0.6, 0.2, 1.1, 0.75, 1.9, 2.65, "8:05am"),
          (74, -0.9, 0.0, 0.3, -1.2, -0.6, -1.8, "12:10pm"),
          (66, 1.5, 0.4, 0.8, 1.25, 2.7, 3.95, "11:30am")]


def payload(completed="2023-09-10", rounds=ROUNDS, event_id="812", drop=(), dg_id=4077, **more):
    player = {"dg_id": dg_id, "fin_text": "T3", "player_name": "Moreau, Lin"}
    for i, (score, app, arg, ott, putt, t2g, total, tee) in enumerate(rounds, start=1):
        if i in drop:
            continue
        r = {"course_name": "Dunes East", "course_num": 301, "course_par": 70,
             "score": score, "sg_app": app, "sg_arg": arg, "sg_ott": ott, "sg_putt": putt,
             "sg_t2g": t2g, "sg_total": total, "birdies": 3, "gir": 0.6, "start_hole": 10}
        if tee is not None:
            r["teetime"] = tee
        player[f"round_{i}"] = r
    return {"event_name": "Harbour Trophy", "event_id": event_id, "event_completed": completed,
            "year": 2023, "season": 2023, "tour": "pga", "sg_categories": "yes",
            "scores": [player]} | more


def text_df(spark, docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")


def events(spark):
    return ingest.pga_events(ingest.parse_event_list(text_df(spark, [EVENT_LIST])))


def test_event_list_tour_filter(spark, tmp_path):
    path = tmp_path / "all-events.json"
    path.write_text(json.dumps(EVENT_LIST, indent=4))
    out = ingest.pga_events(ingest.read_event_list(spark, str(path))).collect()
    assert [r.asDict() for r in out] == [EVENT_LIST[1]]


def ingested(spark, *docs, **kw):
    return ingest.rounds_from_payloads(ingest.parse_payloads(text_df(spark, docs)), events(spark), **kw)


def test_payload_to_rounds(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps(payload(), indent=2))
    res = ingest.rounds_from_payloads(ingest.read_payloads(spark, str(tmp_path)), events(spark))
    rows = sorted(res.rounds.collect(), key=lambda r: r["round"])
    assert res.quarantine.count() == 0
    assert [r.teetime for r in rows] == [ts(2023, 9, 7, 14, 45), ts(2023, 9, 8, 8, 5),
                                         ts(2023, 9, 9, 12, 10), ts(2023, 9, 10, 11, 30)]
    assert [(r.score, r.sg_total) for r in rows] == [(71, 1.13), (68, 2.65), (74, -1.8), (66, 3.95)]
    assert rows[0].asDict() == dict(
        year=2023, event_id=812, event_name="Harbour Trophy", dg_id=4077,
        player_name="Moreau, Lin", round=1, course_name="Dunes East", course_num=301, course_par=70,
        score=71, sg_app=0.11, sg_arg=0.52, sg_ott=-0.4, sg_putt=0.9, sg_t2g=0.23, sg_total=1.13,
        teetime=ts(2023, 9, 7, 14, 45))


@pytest.mark.parametrize("completed", ["2023-09-11", "2023-09-10", "2023-09-09"])
def test_finish_days_all_start_thursday(spark, completed):
    first = [r for r in ingested(spark, payload(completed)).rounds.collect() if r["round"] == 1][0]
    assert first.teetime.date() == dt.date(2023, 9, 7)


# document, rows it gives, reason
FAULTS = [
    (payload("2023-09-06"), 4, "completed on Wednesday, expected Saturday to Monday"),
    (payload(None), 4, "no usable completion date"),
    (payload("09/10/2023"), 4, "no usable completion date"),
    (payload(event_id="61"), 4, "event not in the list"),
    (payload(event_id="x1"), 4, "event not in the list"),
    (payload(year=2022), 4, "event not in the list"),
    (payload(tour="kft"), 4, "other tour"),
    (payload(tour=None), 4, "other tour"),
    (payload(rounds=[("sixty", *ROUNDS[0][1:]), *ROUNDS[1:]]), 1, "unreadable document"),
    (payload(scores=[]), 1, "document without rounds"),
]


@pytest.mark.parametrize("case", range(len(FAULTS)))
def test_nothing_is_dropped(spark, case):
    doc, rows, reason = FAULTS[case]
    res = ingested(spark, payload(), doc)
    assert res.rounds.count() == 4
    assert [r.reason for r in res.quarantine.collect()] == [reason] * rows
    strict = ingested(spark, doc, strict=True)
    with pytest.raises(Exception, match=reason):
        strict.rounds.collect()


def test_broken_json_is_quarantined_whole(spark, tmp_path):
    text = json.dumps(payload())[:90]
    res = ingest.rounds_from_payloads(ingest.parse_payloads(
        spark.createDataFrame([(text,)], "value string")), events(spark))
    assert res.rounds.count() == 0
    assert [(r.reason, r.document) for r in res.quarantine.collect()] == [("unreadable document", text)]
    (tmp_path / "bad.json").write_text(text)
    (tmp_path / "good.json").write_text(json.dumps(payload()))
    res = ingest.rounds_from_payloads(ingest.read_payloads(spark, str(tmp_path)), events(spark))
    assert res.rounds.count() == 4 and [r.reason for r in res.quarantine.collect()] == ["unreadable document"]


def test_duplicate_and_conflicting_event_list_rows(spark):
    docs = ingest.parse_payloads(text_df(spark, [payload()]))
    twice = events(spark).unionByName(events(spark))
    assert ingest.rounds_from_payloads(docs, twice).rounds.count() == 4
    other = events(spark).unionByName(events(spark).withColumn("event_name", F.lit("Another Name")))
    res = ingest.rounds_from_payloads(docs, other)
    assert res.rounds.count() == 0
    assert {r.reason for r in res.quarantine.collect()} == {"event listed under several names"}


def test_missing_round_missing_and_bad_teetime(spark):
    rounds = list(ROUNDS)
    rounds[1] = rounds[1][:7] + (None,)      # no tee time -> midnight
    rounds[2] = rounds[2][:7] + ("25:99xm",)  # malformed -> quarantine
    res = ingested(spark, payload(rounds=rounds, drop=(4,)))
    got = {r["round"]: r.teetime for r in res.rounds.collect()}
    assert got == {1: ts(2023, 9, 7, 14, 45), 2: ts(2023, 9, 8, 0, 0)}
    assert [(r["round"], r.teetime_text) for r in res.quarantine.collect()] == [(3, "25:99xm")]


@pytest.mark.parametrize("text,hour,minute", [("3:6pm", 15, 6), ("12:00am", 0, 0), ("12:59PM", 12, 59),
                                              ("07:05Am", 7, 5), ("13:00pm", None, None), ("0:10am", None, None)])
def test_teetime_texts(spark, text, hour, minute):
    df = spark.createDataFrame([(dt.date(2023, 9, 7), text), (None, text)], "d date, t string")
    got = [r[0] for r in df.select(ingest.teetime_at(F.col("d"), F.col("t"))).collect()]
    assert got == [None if hour is None else ts(2023, 9, 7, hour, minute), None]


def test_null_score_round_is_kept(spark):
    rounds = [(None,) + ROUNDS[0][1:], *ROUNDS[1:]]
    assert ingested(spark, payload(rounds=rounds)).rounds.filter(F.col("score").isNull()).count() == 1


def test_new_events_by_id_and_slug(spark):
    ev = spark.createDataFrame(
        [(2021, "2021-01-01", 1, "Café Open", "y", "y", "pga"),
         (2021, "2021-02-01", 2, "Cafe Open", "y", "y", "pga"),
         (2021, "2021-03-01", 3, "Third", "y", "y", "pga")],
        "calendar_year long, date string, event_id long, event_name string, "
        "sg_categories string, traditional_stats string, tour string")
    landed = ingest.landed_event_keys(spark.createDataFrame(
        [(2021, 1, "Café Open")], "year long, event_id long, event_name string"))
    assert sorted(r.event_id for r in ingest.new_events(ev, landed).collect()) == [2, 3]
    # name-keyed files collide: the second "Cafe Open" counts as landed
    assert sorted(r.event_id for r in ingest.new_events(ev, landed, by_slug=True).collect()) == [3]


def test_slug_letters(spark):
    from fairway.functions.rules import slug

    names = {"Łódź": "lodz", "Straße": "strasse", "1,000 Guineas": "1000-guineas", "Åre Øst": "are-ost",
             "  The -- Öpen! ": "the-open", "Ærø": "aero", "Năm 2": "nam-2"}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r.n: r.s for r in df.select("n", slug("n").alias("s")).collect()} == names


def test_course_dimension(spark):
    schedule = spark.createDataFrame(
        [(812, "Dunes East", "301", 51.2, 3.1, "Ostend"), (999, "Nowhere", "1", 0.0, 0.0, "None")],
        "event_id long, course string, course_key string, latitude double, longitude double, "
        "location string")
    out = ingest.course_dimension(schedule, events(spark)).collect()
    assert [(r.course_name, r.course_num) for r in out] == [("Dunes East", 301)]


def test_json_lines_payloads(spark, tmp_path):
    lines = "\n".join([json.dumps(payload()), json.dumps(payload("2023-09-06")), "{broken"])
    (tmp_path / "batch.jsonl").write_text(lines + "\n")
    res = ingest.rounds_from_payloads(
        ingest.read_payloads(spark, str(tmp_path), multi_line=False), events(spark))
    assert res.rounds.count() == 4 and res.quarantine.count() == 5


def test_strict_mode_fails_on_malformed_teetime(spark):
    rounds = [ROUNDS[0][:7] + ("noon",), *ROUNDS[1:]]
    with pytest.raises(Exception, match="malformed tee time 'noon'"):
        ingested(spark, payload(rounds=rounds), strict=True).rounds.collect()


@pytest.mark.parametrize("text", ['[{"tour": "pga"}, {"tour": ', '{"tour": "pga"', '[{"tour": "pga"}, 7]', '[{"calendar_year": "x"}]',
                                  "not json", '[{"tour": "pga"}] [', '[null]'])
def test_unreadable_event_lists_fail(spark, text):
    with pytest.raises(Exception, match="unreadable event list"):
        ingest.parse_event_list(spark.createDataFrame([(text,)], "value string")).collect()


def test_readable_event_lists_in_any_shape(spark):
    texts = ['﻿ [{"tour": "pga", "event_id": 1}, {"tour": "euro", "event_id": 2, "more": {"a": [1]}}]',
             '{"tour": "pga", "event_id": 3}', "[]", "", "  ", None]
    got = ingest.parse_event_list(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert sorted((r.event_id, r.tour) for r in got.collect()) == [(1, "pga"), (2, "euro"), (3, "pga")]
    assert [f.name for f in got.schema] == [f.name for f in ingest.EVENT_LIST.fields]
