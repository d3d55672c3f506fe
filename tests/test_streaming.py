
import itertools

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tests.test_parse import event, line
from usagelens.operators import anomaly, facts, findings, parse
from usagelens.schemas import BODIES, CONTRACT
from usagelens.sources import star
from usagelens.streaming import ingest, upsert, windows

HOUR = 3600 * 1000
T0 = 1700002800000  # on the hour


def request(i, at=T0):
    attributes = {"cost_usd": f"0.{i}", "input_tokens": "1", "output_tokens": "2", "session.id": "s"}
    return event({"body": BODIES["api_request"], "attributes": attributes}, id=f"r{i}", timestamp=at)


def error(i, at=T0):
    return event({"body": BODIES["api_error"], "attributes": {}}, id=f"x{i}", timestamp=at)


@pytest.fixture
def folder(tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "a.jsonl").write_text(line(request(1), request(2)) + "\njunk\n")
    (logs / "b.jsonl").write_text(line(error(1), request(3, T0 + HOUR)) + "\n")
    return logs


def typed(spark, *events):
    lines = spark.createDataFrame([(line(*events),)], "value STRING")
    return facts.typed_events(parse.parse_lines(lines))


def same(a, b):
    columns = sorted(a.columns)
    return sorted(map(str, rows_of(a.select(columns)))) == sorted(map(str, rows_of(b.select(columns))))


def test_stream_equals_batch(spark, folder, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "ckpt")
    lines = ingest.stream_lines(spark, str(folder), files_per_trigger=1)
    ingest.stream_ingest(lines, out, checkpoint).awaitTermination()
    batch = facts.typed_events(parse.parse_lines(spark.read.text(str(folder))))
    assert same(star.read_events(spark, out), batch)
    # more files arrive; what is loaded is not loaded again
    (folder / "c.jsonl").write_text(line(request(4)) + "\n")
    ingest.stream_ingest(lines, out, checkpoint).awaitTermination()
    assert same(star.read_events(spark, out), facts.typed_events(parse.parse_lines(spark.read.text(str(folder)))))
    loaded = star.read_star(spark, out)
    assert loaded.fact_api_requests.count() == 4 and loaded.dim_employees.count() == 0
    star.compact(spark, out)
    assert star.read_star(spark, out).fact_api_requests.count() == 4


def test_upsert_adds_only_unseen_events(spark, tmp_path):
    path = str(tmp_path / "events")
    no_id = [{**request(8), "id": None}, {**request(9), "id": None}]
    upsert.incremental_upsert(typed(spark, request(1), request(1), request(2)), path)
    upsert.incremental_upsert(typed(spark, request(2), request(3, T0 + 48 * HOUR), *no_id), path)
    upsert.incremental_upsert(typed(spark, request(1), request(3, T0 + 48 * HOUR)), path)
    upsert.incremental_upsert(typed(spark, event({"body": "z"}, id="n", timestamp=None)), path)
    upsert.incremental_upsert(typed(spark, event({"body": "z"}, id="n", timestamp=None)), path)
    ids = [r["event_id"] for r in star.read_events(spark, path).collect()]
    assert sorted(ids, key=str) == [None, None, "n", "r1", "r2", "r3"]


def broken(i):
    return {**request(i), "message": "{"}


@pytest.mark.parametrize("order", ["bad first", "good first", "one delta", "one delta, bad last"])
def test_a_rejected_event_never_blocks_its_repair(spark, tmp_path, order):
    root = str(tmp_path / "star")
    deltas = {
        "bad first": [[broken(1)], [request(1)], [broken(1)]],
        "good first": [[request(1)], [broken(1)]],
        "one delta": [[broken(1), request(1)]],
        "one delta, bad last": [[request(1), broken(1)]],
    }[order]
    for delta in deltas:
        upsert.incremental_upsert(typed(spark, *delta), root)
    assert star.read_star(spark, root).fact_api_requests.count() == 1
    rejected = [r.event_id for r in star.read_quarantine(spark, root).collect()]
    assert rejected == (["r1"] if order == "bad first" else [])


@pytest.mark.parametrize("order", list(itertools.permutations(["load", "stream", "upsert"])))
def test_all_writers_share_one_star(spark, folder, tmp_path, order):
    root = str(tmp_path / "star")
    expected = set()
    for step in order:
        if step == "load":
            # a load starts anew
            star.write_star(spark.createDataFrame([], CONTRACT["dim_employees"]), typed(spark, request(7)), root)
            expected = {"r7"}
        elif step == "stream":
            lines = ingest.stream_lines(spark, str(folder), files_per_trigger=1)
            ingest.stream_ingest(lines, root, str(tmp_path / "ckpt")).awaitTermination()
            expected |= {"r1", "r2", "r3", "x1"}
        else:
            upsert.incremental_upsert(typed(spark, request(1 if "r1" in expected else 8), request(9)), root)
            expected |= {"r9"} if "r1" in expected else {"r8", "r9"}
    ids = [r.event_id for r in star.read_events(spark, root).filter("event_id IS NOT NULL").collect()]
    assert sorted(ids) == sorted(expected)


def test_unfinished_parts_are_not_seen_and_retries_count_once(spark, tmp_path):
    root = str(tmp_path / "star")
    star.append_part(typed(spark, request(1)), root, "a")
    version = star.current_version(spark, root)
    star.write_events(typed(spark, request(2)), f"{star.events_path(root, version)}/part=b", "overwrite")
    star.append_part(typed(spark, request(3)), root, "a")
    assert [r.event_id for r in star.read_events(spark, root).collect()] == ["r1"]
    star.append_part(typed(spark, request(4)), root, "b")
    assert sorted(r.event_id for r in star.read_events(spark, root).collect()) == ["r1", "r4"]


def test_staged_deltas_are_removed(spark, tmp_path, monkeypatch):
    staged = str(tmp_path / "delta")
    monkeypatch.setattr(upsert, "scratch_path", lambda *_: staged)
    upsert.incremental_upsert(typed(spark, request(1)), str(tmp_path / "star"))
    assert not (tmp_path / "delta").exists()


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_times_do_not_follow_the_session_zone(spark, tmp_path, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    root = str(tmp_path / "star")
    upsert.incremental_upsert(typed(spark, request(1), error(1)), root)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        upsert.incremental_upsert(typed(spark, request(1), error(1)), root)
        loaded = star.read_star(spark, root)
        assert loaded.fact_api_requests.count() == 1
        kpis = windows.windowed_kpis(star.read_events(spark, root))
        assert [str(r.window_start) for r in kpis.collect()] == ["2023-11-14 23:00:00"]
        assert [str(r.hour_start) for r in findings.errors_by_hour(loaded).collect()] == ["2023-11-14 23:00:00"]
        costs = anomaly.cost_anomalies(loaded, -1.0).collect()
        assert [r.timestamp for r in costs] in ([], ["2023-11-14 23:00:00"])
        assert spark.conf.get("spark.sql.session.timeZone") == zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_stream_upsert_survives_replayed_files(spark, folder, tmp_path):
    path, checkpoint = str(tmp_path / "events"), str(tmp_path / "ckpt")
    lines = ingest.stream_lines(spark, str(folder))
    upsert.stream_upsert(lines, path, checkpoint).awaitTermination()
    for name in ("a", "b"):
        (folder / f"{name}-again.jsonl").write_text((folder / f"{name}.jsonl").read_text())
    upsert.stream_upsert(lines, path, checkpoint).awaitTermination()
    events = star.read_events(spark, path).filter(F.col("event_id").isNotNull())
    assert sorted(r["event_id"] for r in events.collect()) == ["r1", "r2", "r3", "x1"]


def test_windows(spark, folder, tmp_path):
    events = facts.typed_events(parse.parse_lines(spark.read.text(str(folder))))
    rows = windows.windowed_kpis(events).orderBy("window_start").collect()
    got = [(str(r["window_start"]), *tuple(r)[2:]) for r in rows]
    assert got == [("2023-11-14 23:00:00", 0.3, 6, 2, 1), ("2023-11-15 00:00:00", 0.3, 3, 1, 0)]

    # as a stream: the first hour is out once the watermark has passed it
    (folder / "late.jsonl").write_text(line(request(5, T0 + 3 * HOUR)) + "\n")
    lines = ingest.stream_lines(spark, str(folder))
    kpis = windows.windowed_kpis(ingest.stream_events(lines), lateness="10 minutes")
    run = (
        kpis.writeStream.format("memory")
        .queryName("kpis")
        .option("checkpointLocation", str(tmp_path / "ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    closed = sorted(str(r["window_start"]) for r in spark.table("kpis").collect())
    assert closed == ["2023-11-14 23:00:00", "2023-11-15 00:00:00"]


def test_open_windows_are_delivered_and_emitted_once(spark, tmp_path):
    logs, out, checkpoint = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "ckpt")
    logs.mkdir()
    batches = [[request(1), request(2), error(1)], [request(3, T0 + HOUR)], [request(4, T0 + 5 * HOUR), error(2, T0 + 5 * HOUR)]]
    for i in range(len(batches)):
        (logs / f"{i}.jsonl").write_text(line(*batches[i]) + "\n")
        windows.stream_windowed_kpis(ingest.stream_lines(spark, str(logs)), out, checkpoint).awaitTermination()
        found = windows.read_windows(spark, out, checkpoint)
        batch = windows.windowed_kpis(facts.typed_events(parse.parse_lines(spark.read.text(str(logs)))))
        assert same(found.drop("is_final"), batch)
    final = {str(r.window_start)[11:16] for r in found.filter("is_final").collect()}
    assert final == {"23:00", "00:00"}
    # nothing open is lost by reading it: the next event closes it
    (logs / "end.jsonl").write_text(line(request(6, T0 + 9 * HOUR)) + "\n")
    windows.stream_windowed_kpis(ingest.stream_lines(spark, str(logs)), out, checkpoint).awaitTermination()
    assert windows.read_windows(spark, out, checkpoint).filter("is_final").count() == 3


def test_a_stream_without_repeats_fills_the_star_like_one_load(spark, tmp_path):
    logs, root, checkpoint = tmp_path / "logs", str(tmp_path / "star"), str(tmp_path / "ckpt")
    logs.mkdir()
    states = []
    for day in range(4):
        events = [request(10 * day + i, T0 + day * 24 * HOUR + i) for i in range(5)]
        (logs / f"{day}.jsonl").write_text(line(*events) + "\n")
        (logs / f"{day}-again.jsonl").write_text(line(*events[:3]) + "\n" + line(*events) + "\n")
        lines = ingest.stream_lines(spark, str(logs))
        run = ingest.stream_ingest(lines, root, checkpoint, lateness="1 hour")
        run.awaitTermination()
        states.append(run.lastProgress["stateOperators"][0]["numRowsTotal"])
    once = typed(spark, *[request(10 * day + i, T0 + day * 24 * HOUR + i) for day in range(4) for i in range(5)])
    assert same(star.read_events(spark, root), once)
    # ids of days that have passed are forgotten
    assert max(states) <= 10


def test_a_stream_with_state_writes_few_files(spark, tmp_path):
    logs, root = tmp_path / "logs", tmp_path / "star"
    logs.mkdir()
    (logs / "a.jsonl").write_text("\n".join(line(request(i, T0 + i)) for i in range(60)) + "\n")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        lines = ingest.stream_lines(spark, str(logs))
        ingest.stream_ingest(lines, str(root), str(tmp_path / "ckpt"), lateness="1 hour").awaitTermination()
    finally:
        spark.conf.unset("spark.sql.shuffle.partitions")
    # not one from each of the state's tasks
    assert len(list(root.glob("versions/*/events/part=*/table=fact_api_requests/**/*.parquet"))) == 1
    assert star.read_star(spark, str(root)).fact_api_requests.count() == 60


@pytest.mark.parametrize("most", [0, 100])
def test_only_rows_of_repeated_ids_are_sorted_out(spark, tmp_path, monkeypatch, most):
    no_id = [{**request(8), "id": None}, {**request(8), "id": None}]
    delta = typed(spark, request(1), request(2), broken(2), request(2, T0 + HOUR), broken(3), request(4), *no_id)
    expected, given = upsert.one_per_id(delta), []
    one_per_id = upsert.one_per_id
    monkeypatch.setattr(upsert, "BROADCAST_ROWS", most)
    monkeypatch.setattr(upsert, "one_per_id", lambda rows: given.append(rows.count()) or one_per_id(rows))
    once, ids = upsert.staged_once(delta, str(tmp_path / "staged"))
    assert same(once, expected)
    assert sorted(map(tuple, ids.collect())) == [("r1", 1), ("r2", 3), ("r3", 1), ("r4", 1)]
    assert given == [3 if most else 8]
    once, _ = upsert.staged_once(typed(spark, request(1), request(2), *no_id), str(tmp_path / "none"))
    assert once.count() == 4 and len(given) == 1
