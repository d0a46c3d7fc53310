"""End-to-end jobs on small files with one row per edge case."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.plans.flow import Sources, incremental_load, initial_load
from tidemark.plans.operational import import_history
from tidemark.plans.staging import Warehouse
from tidemark.schemas import BABY_INFO, DIAPER_DATA, SLEEP_DATA
from tidemark.sources.readers import fan_out, read_csv

UTC = timezone.utc

# four good rows among others that lack a part or can't be typed
AMOUNTS = '''ID,Baby ID,Time,Amount (ml)
3017,1,"31.11.2025, 08:40",75
3003,1,"04.10.2025, 23:55",210
3021,1,"11.11.2025, 16:25",lots
3008,1,"29.10.2025, 00:05",185
,1,"07.11.2025, 13:30",65
3011,1,,240
3014,,"02.11.2025, 04:45",170
3005,1,"13.10.2025, 17:15",55
3022,1,"12.11.2025, 18:05",-20
3009,1,"31.10.2025, 21:50",225
3012,1,"09.11.2025, 03:35",
3023,1,"12.11.2025, 25:10",90
'''

MORE_AMOUNTS = '''ID,Baby ID,Time,Amount (ml),Note
3040,1,"26.11.2025, 20:20",many,in words
3031,1,"23.11.2025, 02:10",205,in between
3042,1,"30.02.2025, 09:00",80,February
3032,1,"24.11.2025, 15:40",70,in between
,1,"27.11.2025, 09:25",190,unnumbered
3030,1,"19.10.2025, 12:05",145,found again
3033,1,2025-11-25 22:30,60,typed by hand
3041,1,"26.11.2025, 21:45",-1,below zero
3034,1,"26.11.2025, 05:55",215,in between
3037,1,,"85",undated
3035,1,"27.11.2025, 07:45",230,after the move
3038,,"27.11.2025, 08:15",175,whose
3036,1,"27.11.2025, 11:10",50,after the move
3039,1,"26.11.2025, 23:05",,how much
'''

SLEEPS = '''\ufeffBaby,Time,Duration(minutes),Note
Mira,"14.11.2025, 03:20",205,
Mira,"2025-10-22 06:00",70,dashes
Mira,"02.10.2025, 06:10",33,first
Mira,"17.11.2025, 05:00",1.5,fraction
Mira,"19.10.2025, 22:45",148,
Mira,,"80",undated
Mira,"27.10.2025, 13:05",17,short
Mira,"18.11.2025, 02:30",0,awake
Mira,"01.01.2098, 04:00",50,to come
Mira,"08.11.2025, 16:55",91,
Mira,"16.11.2025, 01:15",-40,backwards
'''

DIAPERS = '''Baby,Time,Status,Note
Mira,"03.11.2025, 19:40",MIXED,
Mira,"30.13.2025, 10:00",dirty,month
Mira,"06.10.2025, 04:25",dirty,
Mira,"12.11.2025, 08:30",unknown,word
Mira,"15.11.2025, 23:10",Wet,
Mira,,"Mixed",undated
Mira,"21.10.2025, 14:50",Wet,
Mira,"13.11.2025, 09:00",,blank
'''


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """A warehouse after the seed import, an initial and an incremental load."""
    base = tmp_path_factory.mktemp("star")
    for name, text in {
        "sleep.csv": SLEEPS, "diaper.csv": DIAPERS, "amounts.csv": AMOUNTS, "more.csv": MORE_AMOUNTS
    }.items():
        (base / name).write_text(text, encoding="utf-8")
    subject, slept, changed = import_history(
        read_csv(spark, str(base / "sleep.csv")), read_csv(spark, str(base / "diaper.csv")),
        "Mira", "Asia/Tokyo", at("2025-11-20T00:00"),
    )
    docs = base / "docs"
    for row in changed.good.collect():
        folder = docs / f"parent_id={row.baby_id}"
        folder.mkdir(parents=True, exist_ok=True)
        entry = {"id": row.id, "status": row.status, "change_time": row.change_time.strftime("%Y-%m-%dT%H:%M:%S+00:00")}
        (folder / f"{row.id}.json").write_text(json.dumps([entry]))

    documents = fan_out(spark, str(docs), ["id", "change_time", "status"], "parent_id", multiline=True)
    wh = Warehouse(spark, str(base / "wh"), at("2025-11-21T08:15"))
    first = initial_load(
        wh,
        Sources(subject, slept.good, str(base / "amounts.csv"), status_documents=documents),
        at("2025-11-21T00:00"),
    )
    snapshot = {t: wh.tables.read(t).count() for t in ("fact_sleep", "fact_diaper", "fact_formula_feed", "dim_baby", "dim_diaper_status", "dim_date", "dim_time", "stg_formula")}

    # A second subject appears, the first one moves to another zone.
    subjects = spark.createDataFrame([(1, "Mira", "America/Lima"), (2, "Odo", "Africa/Cairo")], BABY_INFO)
    naps = ["2025-11-02T05:15", "2025-11-22T21:05", "2025-11-23T11:50", "2025-11-24T18:35", "2025-11-25T02:25", "2025-11-26T14:00"]
    durations = slept.good.unionByName(spark.createDataFrame(
        [(5000 + i, at(t), 21 + 7 * i, 2) for i, t in enumerate(naps)], SLEEP_DATA))
    changes = [("2025-11-25T16:20", "mixed"), ("2025-11-01T10:30", "dirty"), ("2025-11-26T07:05", "wet")]
    statuses = changed.good.unionByName(spark.createDataFrame(
        [(6000 + i, at(t), status, 2) for i, (t, status) in enumerate(changes)], DIAPER_DATA))
    later = Warehouse(spark, str(base / "wh"), at("2025-11-27T06:30"))
    sources = Sources(subjects, durations, str(base / "more.csv"), statuses=statuses)
    second = incremental_load(later, sources, at("2025-11-27T00:00"))
    return {"wh": later, "first": first, "second": second, "snapshot": snapshot,
            "slept": slept, "changed": changed, "sources": sources}


def test_seed_import_counts(star):
    counts = {part: (star[part].good.count(), star[part].bad.count()) for part in ("slept", "changed")}
    assert counts == {"slept": (5, 6), "changed": (4, 4)}


def test_seed_import_times_and_statuses(star):
    first = star["slept"].good.orderBy("sleep_start").select(
        F.date_format("sleep_start", "yyyy-MM-dd HH:mm")).first()[0]
    assert first == "2025-10-01 21:10"  # nine hours ahead of UTC
    statuses = {r.status for r in star["changed"].good.select("status").collect()}
    assert statuses == {"wet", "dirty", "mixed"}


def test_initial_load(star):
    assert star["snapshot"] == {
        "fact_sleep": 5, "fact_diaper": 4, "fact_formula_feed": 6, "dim_baby": 2,
        "dim_diaper_status": 4, "dim_date": 4018, "dim_time": 1440, "stg_formula": 8,
    }
    assert all(o.status == "success" for o in star["first"].values())
    assert star["first"]["stg_formula"].mark == at("2025-11-09T03:35")


def test_incremental_load_counts(star):
    done = star["second"]
    assert done["stg_sleep"].inserted == 5  # one of the six lies before the mark
    assert done["stg_diaper"].inserted == 2
    assert done["stg_formula"].inserted == 11  # a file is not filtered by the mark
    assert done["fact_sleep"].inserted == 5
    assert done["fact_diaper"].inserted == 2
    assert done["fact_formula_feed"].inserted == 9
    assert done["dim_diaper_status"].inserted == 0


def test_subject_versions(star):
    dim = star["wh"].tables.read("dim_baby")
    rows = dim.where("baby_nk = 1").orderBy("valid_from").select(
        "timezone_iana", "is_current", F.date_format("valid_from", "MM-dd HH:mm").alias("f"),
        F.date_format("valid_to", "yyyy-MM-dd HH:mm:ss").alias("t")).collect()
    assert [tuple(r) for r in rows] == [
        ("Asia/Tokyo", False, "11-21 08:15", "2025-11-27 06:30:00"),
        ("America/Lima", True, "11-27 06:30", "2099-12-31 23:59:59"),
    ]
    assert dim.where("baby_nk = 2 AND is_current").count() == 1
    assert dim.where("baby_nk = -1").first().baby_sk == -1
    assert dim.select("baby_sk").distinct().count() == dim.count() == 4
    assert star["second"]["dim_baby"].inserted == 2
    assert star["second"]["dim_baby"].affected == 3


def test_facts_take_the_version_of_their_time(star):
    wh = star["wh"]
    dim = wh.tables.read("dim_baby").select("baby_sk", "timezone_iana", "baby_nk")
    amounts = wh.tables.read("fact_formula_feed").where("f_feeding_date_sk >= 20251123").join(dim, "baby_sk")
    zones = {(r.f_feeding_date_sk, r.timezone_iana) for r in amounts.collect()}
    # 23-26 November lie in the older version, what follows on the 27th in the newer
    assert (20251123, "Asia/Tokyo") in zones and (20251127, "America/Lima") in zones
    late = wh.tables.read("fact_formula_feed").where("f_feeding_date_sk = 20251019").join(dim, "baby_sk")
    assert [r.timezone_iana for r in late.collect()] == ["America/Lima"]  # before every version


def test_repeating_a_run_adds_nothing(star):
    wh, src = star["wh"], star["sources"]
    before = {t: wh.tables.read(t).count() for t in ("fact_sleep", "fact_diaper", "fact_formula_feed", "dim_baby")}
    again = incremental_load(wh, src, at("2025-11-27T00:00"))
    assert {o.status for o in again.values()} == {"skipped"}
    # A new run finds no new rows; the same file is not taken twice.
    other = incremental_load(wh, src, at("2025-11-28T00:00"))
    assert other["stg_formula"].status == "skipped"
    assert other["stg_sleep"].inserted == 0
    # an empty batch keeps its mark
    assert other["stg_sleep"].mark == star["second"]["stg_sleep"].mark
    assert {t: wh.tables.read(t).count() for t in before} == before


def test_quarantine_and_good_rows_add_up(star, spark):
    wh = star["wh"]
    bad = spark.read.json(f"{wh.quarantine}/*/*/")
    by_job = {r.job_id: r["count"] for r in bad.groupBy("job_id").count().collect()}
    runs = {r.job_id: r for r in wh.ledger.runs().collect()}
    jobs = [o["stg_formula"].job_id for o in (star["first"], star["second"])]
    assert [by_job[j] for j in jobs] == [4, 3]
    assert [runs[j].rows_inserted_count for j in jobs] == [8, 11]
    messages = {r.error_message for r in bad.collect()}
    assert "Cannot convert '-20' to non-negative int" in messages
    assert "Cannot convert '31.11.2025, 08:40' to datetime" in messages


def test_ledger_lineage(star):
    runs = {r.job_id: r for r in star["wh"].ledger.runs().collect()}
    fact, staged = star["second"]["fact_sleep"].job_id, star["second"]["stg_sleep"].job_id
    assert runs[fact].parent_job_id == staged
    assert runs[fact].pipeline_stage == "transform_load"


def test_failed_run_is_recorded_and_resumed(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), at("2026-01-01T00:00"))
    from tidemark.plans.ledger import Outcome, run_job
    from tidemark.plans.staging import STAGE_DURATIONS

    def broken(job_id):
        raise RuntimeError("disk full")

    when = at("2026-01-01T00:00")
    with pytest.raises(RuntimeError, match="disk full"):
        run_job(wh.ledger, STAGE_DURATIONS, "d", when, broken)
    row = wh.ledger.runs().first()
    assert (row.status, row.error_message) == ("failed", "[step=work] disk full")
    job = wh.ledger.start("d", "to_stg_sleep", when)  # left running
    done = run_job(wh.ledger, STAGE_DURATIONS, "d", when, lambda j: Outcome("success", j))
    assert done.job_id == job
    with pytest.raises(ValueError):
        wh.ledger.finish(job, "unknown")
    with pytest.raises(RuntimeError):
        wh.ledger.finish(999, "success")


def test_several_changes_in_one_batch(spark, tmp_path):
    """New members with two values in one batch, and values that return."""
    from tidemark.operators import scd2

    by = scd2.VersionedBy("nk", "attr", "loaded_at", ("job_id", "loaded_at"))
    rows = [(1, "A", 1, at("2026-01-01T00:00")), (1, "B", 2, at("2026-01-02T00:00")),
            (1, "A", 3, at("2026-01-03T00:00")), (2, "X", 1, at("2026-01-01T00:00")),
            (2, "Y", 2, at("2026-01-02T00:00"))]
    batch = spark.createDataFrame(rows, "nk int, attr string, job_id int, loaded_at timestamp")
    dim = spark.createDataFrame([(1, "A", True)], "nk int, value string, is_current boolean")
    for collapse, expected in ((True, [(1, "B"), (2, "X"), (2, "Y")]),
                               (False, [(1, "A"), (1, "B"), (2, "X"), (2, "Y")])):
        changes = scd2.compare_with_current(batch, dim, by, "value", collapse)
        opened = scd2.new_versions(changes, by)
        assert sorted((r.nk, r.attr) for r in opened.collect()) == expected
        current = opened.where("is_current").groupBy("nk").count().collect()
        assert all(r["count"] == 1 for r in current) and len(current) == 2


def test_a_broken_run_leaves_nothing(spark, tmp_path, monkeypatch):
    """Rows count with the success of their run, and a resumed run starts from what it began with."""
    from tidemark.plans import dimensions, staging

    root, day = str(tmp_path / "wh"), [at(f"2026-02-0{d}T00:00") for d in (1, 2, 3)]
    first = Warehouse(spark, root, day[0])
    staging.stage_subjects(first, "a", day[0], spark.createDataFrame([(1, "Ann", "Asia/Tokyo")], BABY_INFO))
    dimensions.load_subjects(first, "a", day[0])
    later = Warehouse(spark, root, day[1])
    moved = spark.createDataFrame([(1, "Ann", "America/Lima")], BABY_INFO)
    staging.restage_subjects(later, "b", day[1], moved)

    def lost(*_, **__):
        raise KeyboardInterrupt

    monkeypatch.setattr(later.ledger, "finish", lost)
    with pytest.raises(KeyboardInterrupt):
        dimensions.load_subject_versions(later, "b", day[1])
    again = Warehouse(spark, root, day[1])
    assert [r.timezone_iana for r in again.tables.read("dim_baby").where("baby_nk = 1").collect()] == ["Asia/Tokyo"]
    assert dimensions.load_subject_versions(again, "b", day[1]).inserted == 1
    versions = again.tables.read("dim_baby").where("baby_nk = 1").orderBy("valid_from").collect()
    assert [(r.timezone_iana, r.is_current) for r in versions] == [("Asia/Tokyo", False), ("America/Lima", True)]
    assert versions[0].valid_to == versions[1].valid_from

    naps = spark.createDataFrame([(1, day[0], 30, 1), (2, day[0], -5, 1)], SLEEP_DATA)
    with monkeypatch.context() as broken:
        broken.setattr(staging, "write_quarantine", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            staging.stage_durations(again, "c", day[2], naps)
    assert again.tables.read("stg_sleep").count() == 0
    staging.stage_durations(again, "c", day[2], naps)
    assert again.tables.read("stg_sleep").count() == 1


def test_streamed_batches_stand_beside_others(spark, tmp_path):
    from tidemark.operators.lineage import new_batches
    from tidemark.plans.mappings import AMOUNT_FILE
    from tidemark.plans.staging import stage_amounts
    from tidemark.sources.readers import text_schema
    from tidemark.streaming.file_ingest import ingest_available, landed_files

    head = "ID,Baby ID,Time,Amount (ml)\n"
    inbox, wh = tmp_path / "in", Warehouse(spark, str(tmp_path / "wh"), at("2026-02-01T00:00"))
    inbox.mkdir()
    (tmp_path / "whole.csv").write_text(head + "1,1,2026-01-01 08:00,50\n2,1,2026-01-01 09:00,60\n")
    stage_amounts(wh, "a", at("2026-02-01T00:00"), str(tmp_path / "whole.csv"))
    mark = wh.ledger.last_mark("staging", "stg_formula", "extract")
    schema = text_schema(["ID", "Baby ID", "Time", "Amount (ml)"])
    for n in range(2):
        (inbox / f"{n}.csv").write_text(head + f"{7 + n},1,2026-01-02 08:0{n},70\n")
        files = landed_files(spark, str(inbox), schema)
        ingest_available(wh, files, "stg_formula", AMOUNT_FILE, str(tmp_path / f"checkpoint{n}"))
    staged = [(r.source_id, r.job_id) for r in wh.tables.read("stg_formula").orderBy("source_id", "job_id").collect()]
    assert [s for s, _ in staged] == ["1", "2", "7", "7", "8"]  # the second checkpoint knows no file
    batches = new_batches(wh.ledger.runs(), "stg_formula", "fact_formula_feed")
    assert {r.job_id for r in batches.collect()} == {j for _, j in staged}
    assert wh.ledger.last_mark("staging", "stg_formula", "extract") == mark


def test_a_resumed_extract_is_loaded_after_later_ones(spark, tmp_path):
    """Extract 2 stays open while 1 and 3 are loaded; once it succeeds the next load takes it, and it alone."""
    from tidemark.plans.ledger import JobSpec, Outcome, run_job

    wh = Warehouse(spark, str(tmp_path / "wh"), at("2026-02-01T00:00"))

    def extract(day, work):
        spec = JobSpec("to_stg", "extract", "db", "x", "staging", "stg_sleep", "incremental")
        return run_job(wh.ledger, spec, "d", at(f"2026-02-0{day}T00:00"), work)

    def load(day, ledger):
        seen = []
        spec = JobSpec("to_core", "transform_load", "db", "staging.stg_sleep", "core", "fact_sleep", "incremental")
        done = run_job(ledger, spec, "d", at(f"2026-02-0{day}T00:00"), lambda job: (
            seen.extend(ledger.take(job, "stg_sleep", "fact_sleep")), Outcome("success", job))[1])
        return sorted(seen), done.job_id

    def broken(job):
        raise KeyboardInterrupt  # the driver is gone: no state is written

    first = extract(1, lambda job: Outcome("success", job)).job_id
    with pytest.raises(KeyboardInterrupt):
        extract(2, broken)
    third = extract(3, lambda job: Outcome("success", job)).job_id
    assert load(4, wh.ledger) == ([first, third], third + 1)
    assert load(5, wh.ledger)[0] == []
    ranges = wh.ledger.runs().where("job_id = 4").select("loaded_batches").first()[0]
    assert [(r.first, r.last) for r in ranges] == [(first, first), (third, third)]
    assert extract(2, lambda job: Outcome("success", job)).job_id == 2
    other = Warehouse(spark, str(tmp_path / "wh"), at("2026-02-01T00:00")).ledger  # reads the states from their files
    late, job = load(6, other)
    assert late == [2] and load(7, other)[0] == []
    ranges = other.runs().where(F.col("job_id") == job).select("loaded_batches").first()[0]
    assert [(r.first, r.last) for r in ranges] == [(first, third)]  # no gap is left


def test_collisions_are_counted(spark, tmp_path):
    """Two of three events share subject and minute; a later batch brings one that is there already."""
    from tidemark.plans import dimensions, facts, staging

    wh = Warehouse(spark, str(tmp_path / "wh"), at("2026-02-01T00:00"))
    day = [at(f"2026-02-0{d}T00:00") for d in (1, 2)]

    def naps(*rows):
        return spark.createDataFrame([(i, at(t), n, 1) for i, t, n in rows], SLEEP_DATA)

    staging.stage_subjects(wh, "a", day[0], spark.createDataFrame([(1, "Ann", "Asia/Tokyo")], BABY_INFO))
    staging.stage_durations(wh, "a", day[0], naps((1, "2026-01-01T08:00:10", 5), (2, "2026-01-01T08:00:50", 6), (3, "2026-01-01T09:00", 7)))
    dimensions.load_subjects(wh, "a", day[0])
    first = facts.load_fact(wh, "a", day[0], facts.DURATIONS)
    assert (first.inserted, first.collided) == (2, 1)
    staging.stage_new_durations(wh, "b", day[1], naps((4, "2026-01-01T09:00:30", 8), (5, "2026-01-01T10:00", 9)))
    second = facts.load_new_facts(wh, "b", day[1], facts.DURATIONS)
    assert (second.inserted, second.collided) == (1, 1)
    runs = wh.ledger.runs().where("destination_table_name = 'fact_sleep'").select("job_id", "rows_collided_count")
    assert {tuple(r) for r in runs.collect()} == {(first.job_id, 1), (second.job_id, 1)}
