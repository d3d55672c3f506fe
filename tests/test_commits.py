"""The commit log: snapshots, two writers, retention."""

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import request, typed
from usagelens.schemas import CommitConflictError
from usagelens.sources import commits, star
from usagelens.sources.commits import Entry, commit, read_log


def entry(i, version="v"):
    return Entry(version, "events", f"p{i}", f"events/part=p{i}")


def test_reading_opens_a_bounded_number_of_files(spark, tmp_path, monkeypatch):
    root, log = str(tmp_path), read_log(spark, str(tmp_path))
    for i in range(200):
        log = commit(spark, root, log, [entry(i)])
    opened = []
    read = commits.Folder.read
    monkeypatch.setattr(commits.Folder, "read", lambda self, name: opened.append(name) or read(self, name))
    found = read_log(spark, root)
    assert found == log and found.parts("v") == [f"p{i}" for i in range(200)]
    assert len(opened) <= commits.SNAPSHOT_EVERY + 1
    assert len(list((tmp_path / "commits").glob("[0-9]*.json"))) <= 2 * commits.SNAPSHOT_EVERY + 2


def test_of_two_writers_one_gets_an_error(spark, tmp_path):
    root = str(tmp_path)
    seen = read_log(spark, root)
    commit(spark, root, seen, [entry(1)])
    with pytest.raises(CommitConflictError):
        commit(spark, root, seen, [entry(2)])
    assert read_log(spark, root).parts("v") == ["p1"]
    commit(spark, root, read_log(spark, root), [entry(2)])
    assert read_log(spark, root).parts("v") == ["p1", "p2"]


def test_a_writer_that_was_away_for_long_gets_an_error(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "SNAPSHOT_EVERY", 2)
    root = str(tmp_path)
    old = log = commit(spark, root, read_log(spark, root), [entry(0)])
    for i in range(1, 9):
        log = commit(spark, root, log, [entry(i)])
    with pytest.raises(CommitConflictError):
        commit(spark, root, old, [entry(99)])
    assert read_log(spark, root).parts("v") == [f"p{i}" for i in range(9)]


def test_racing_parts_lose_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "star")
    star.append_part(typed(spark, request(1)), root, "a")
    write = star.write_events

    def overtaken(events, path, *rest):
        monkeypatch.setattr(star, "write_events", write)
        star.append_part(typed(spark, request(2)), root, "b")
        return write(events, path, *rest)

    monkeypatch.setattr(star, "write_events", overtaken)
    with pytest.raises(CommitConflictError):
        star.append_part(typed(spark, request(3)), root, "c")
    assert sorted(r.event_id for r in star.read_events(spark, root).collect()) == ["r1", "r2"]
    star.append_part(typed(spark, request(3)), root, "c")
    assert sorted(r.event_id for r in star.read_events(spark, root).collect()) == ["r1", "r2", "r3"]


def test_old_versions_can_be_dropped(spark, tmp_path):
    root = str(tmp_path / "star")
    star.append_part(typed(spark, request(1)), root, "a")
    star.append_part(typed(spark, request(2)), root, "b")
    first = star.current_version(spark, root)
    second = star.compact(spark, root)
    assert star.read_events(spark, root, first).count() == 2
    assert star.remove_versions(spark, root) == [first]
    assert not (tmp_path / "star" / "versions" / first).exists()
    assert star.current_version(spark, root) == second
    # a part that was joined with others is still known
    star.append_part(typed(spark, request(2)), root, "b")
    assert sorted(r.event_id for r in star.read_events(spark, root).collect()) == ["r1", "r2"]
    assert star.remove_versions(spark, root) == []


def test_many_parts_are_read_by_path(spark, tmp_path):
    root = str(tmp_path / "star")
    for i in range(3):
        star.append_part(typed(spark, request(i)), root, f"p{i}")
    plan = star.read_events(spark, root).filter(F.col("table") == "fact_api_requests")
    assert "part IN" not in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count() == 3
