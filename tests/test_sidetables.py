"""What is kept beside the parts: moments, roll-ups, the id index."""

import math
import random
import statistics as plain
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tests.test_parse import event
from tests.test_streaming import HOUR, T0, error, request, same, typed
from usagelens.functions.moments import merged, moments, statistics
from usagelens.operators import anomaly, metrics, rolled
from usagelens.schemas import BODIES
from usagelens.sources import idindex, sidetables, star
from usagelens.sources.commits import read_log
from usagelens.sources.sidetables import COST_MOMENTS, ROLLUPS
from usagelens.streaming import ingest, outliers, upsert


def values_frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double")


def stats_of(spark, values):
    return tuple(statistics(moments(values_frame(spark, values), F.col("v"))).first())


@pytest.mark.parametrize(
    "values",
    [
        [],
        [3.5],
        [0.1, 0.2, 0.3],
        [1e9 + x for x in (1, 2, 3, 4)],
        [1e-9 * x for x in range(1, 50)],
        [1e-7, 5.0, 1e6, 3e12, 2.5],
        [0.01] * 1000 + [7.0],
    ],
)
def test_statistics(spark, values):
    n, mean, std = stats_of(spark, values)
    assert n == len(values)
    assert mean == (pytest.approx(plain.fmean(values), rel=1e-12) if values else None)
    assert std == (pytest.approx(plain.stdev(values), rel=1e-9, abs=1e-15) if len(values) > 1 else None)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(1e-8, 1e8), min_size=2, max_size=40))
def test_statistics_of_any_values(spark, values):
    _, mean, std = stats_of(spark, values)
    assert mean == pytest.approx(math.fsum(values) / len(values), rel=1e-11)
    assert std == pytest.approx(plain.stdev(values), rel=1e-7, abs=1e-11 * max(values))


def test_order_and_parts_change_no_digit(spark):
    rng = random.Random(4)
    values = [rng.lognormvariate(-3, 2) for _ in range(5000)]
    whole = stats_of(spark, values)
    rng.shuffle(values)
    parts = [values_frame(spark, values[i::7]).repartition(i + 1) for i in range(7)]
    rows = moments(parts[0], F.col("v"))
    for part in parts[1:]:
        rows = rows.unionByName(moments(part, F.col("v")))
    assert tuple(statistics(rows).first()) == whole
    # what is added and taken away again leaves nothing behind
    more = values_frame(spark, [1e5, 2e-6])
    rows = rows.unionByName(moments(more, F.col("v"))).unionByName(moments(more, F.col("v"), -1))
    assert tuple(statistics(rows).first()) == whole
    assert merged(rows).count() == merged(moments(values_frame(spark, values), F.col("v"))).count()


def costly(i, cost, at=T0, **more):
    attributes = {"cost_usd": str(cost), "input_tokens": "3", "output_tokens": "4", "model": f"m{i % 2}", "user.email": f"u{i % 3}"}
    return event({"body": BODIES["api_request"], "attributes": attributes | more}, id=f"c{i}", timestamp=at)


def test_cost_anomalies_read_the_requests_twice_without_moments_and_once_with(spark, tmp_path):
    root = str(tmp_path / "star")
    star.append_part(typed(spark, *[costly(i, 1 + i % 3 / 10) for i in range(40)], costly(99, 50)), root, sides=(COST_MOMENTS,))
    loaded = star.read_star(spark, root)
    known = sidetables.read_side(spark, root, read_log(spark, root), COST_MOMENTS)

    def scans_of_events(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return sum("cost_usd" in line and "Relation" in line for line in plan.splitlines())

    assert scans_of_events(anomaly.cost_anomalies(loaded)) == 2
    assert scans_of_events(anomaly.cost_anomalies(loaded, known=known)) == 1
    assert same(anomaly.cost_anomalies(loaded), anomaly.cost_anomalies(loaded, known=known))
    assert [r.cost_usd for r in anomaly.cost_anomalies(loaded).collect()] == [50.0]
    assert same(anomaly.anomaly_summary(loaded), anomaly.anomaly_summary(loaded, known))


def test_streaming_outliers_are_those_of_the_same_moments(spark, tmp_path):
    from tests.test_parse import line

    root, logs, out = str(tmp_path / "star"), tmp_path / "logs", str(tmp_path / "out")
    logs.mkdir()
    star.append_part(typed(spark, *[costly(i, 1 + i % 5 / 10) for i in range(60)]), root, "old")
    batches = [[costly(100, 1.2), costly(101, 9.0)], [costly(102, 9.5), costly(103, 1.1)], [costly(104, 30.0)]]
    expected, held = [], [1 + i % 5 / 10 for i in range(60)]
    for n, batch in enumerate(batches):
        (logs / f"{n}.jsonl").write_text(line(*batch) + "\n")
        stream = ingest.stream_lines(spark, str(logs), files_per_trigger=1)
        outliers.stream_cost_anomalies(stream, root, str(tmp_path / "ckpt"), out).awaitTermination()
        costs = [[1.2, 9.0], [9.5, 1.1], [30.0]][n]
        held += costs
        mean, std = plain.fmean(held), plain.stdev(held)
        expected += [(c, round((c - mean) / std, 2)) for c in costs if (c - mean) / std >= 3]
    found = outliers.read_outliers(spark, out)
    assert sorted((r.cost_usd, r.z_score) for r in found.collect()) == sorted(expected)
    # a batch that is judged again later gives the same rows
    log = read_log(spark, root)
    for part in log.parts(log.version)[2:]:
        again = outliers.part_outliers(spark, root, part)
        assert same(again, found.filter(F.col("batch") == part).drop("batch"))


def fact_report(report, loaded):
    return getattr(metrics, report)(loaded)


REPORTS = (
    "kpis cost_by_practice cost_by_level token_efficiency_by_practice model_usage_breakdown "
    "tool_usage_frequency common_api_errors error_rate_by_model"
).split()


def tool(i, at=T0, **more):
    attributes = {"tool_name": f"t{i % 2}", "decision": ["accept", "reject", ""][i % 3], "user.email": f"u{i % 3}"}
    return event({"body": BODIES["tool_decision"], "attributes": attributes | more}, id=f"t{i}", timestamp=at)


def failed(i, at=T0):
    attributes = {"model": f"m{i % 2}", "error": f"e{i % 2}", "status_code": "429", "user.email": f"u{i % 3}"}
    return event({"body": BODIES["api_error"], "attributes": attributes}, id=f"f{i}", timestamp=at)


def two_days():
    day = 24 * HOUR
    first = [costly(i, f"0.{i}1") for i in range(7)] + [tool(i) for i in range(6)] + [failed(i) for i in range(4)]
    second = [costly(i, "x" if i == 21 else f"1.{i}", T0 + day) for i in range(20, 25)] + [failed(9, T0 + day), tool(7, T0 + day)]
    return first, second


def test_rolled_reports_equal_those_over_facts(spark, tmp_path):
    root = str(tmp_path / "star")
    people = [("u0", "A", "P", "L1", "x"), ("u1", "B", "Q", "L10", "x"), ("u2", "C", "P", "L2", "x")]
    dim = spark.createDataFrame(people, "email string, full_name string, practice string, level string, location string")
    first, second = two_days()
    star.write_star(dim, typed(spark, *first), root)
    rolled.rolled(spark, root)
    upsert.incremental_upsert(typed(spark, *second, first[0]), root, sides=ROLLUPS)
    # one event moves to another day and costs something else: the old one no longer counts
    upsert.incremental_upsert(typed(spark, costly(3, "77", T0 + 50 * HOUR)), root, sides=ROLLUPS)
    loaded, rows = star.read_star(spark, root), rolled.rolled(spark, root)
    for report in REPORTS:
        assert rows_of(getattr(rolled, report)(rows)) == rows_of(fact_report(report, loaded)), report
    by_decision = rolled.tool_usage_frequency(rows, "decisions")
    assert rows_of(by_decision) == rows_of(metrics.tool_usage_frequency(loaded, "decisions"))
    day = rolled.rolled(spark, root, date(2023, 11, 15), date(2023, 11, 15))
    assert rolled.kpis(day).first().total_cost_usd == 1.20 + 1.22 + 1.23 + 1.24


def test_a_new_part_does_not_read_the_old_ones(spark, tmp_path):
    root = str(tmp_path / "star")
    first, second = two_days()
    star.append_part(typed(spark, *first), root, "a", sides=ROLLUPS)
    version = star.current_version(spark, root)
    before = rows_of(rolled.model_usage_breakdown(rolled.rolled(spark, root)))
    # the old part's events can't be read any more
    (tmp_path / "star/versions" / version / "events/part=a").rename(tmp_path / "away")
    star.append_part(typed(spark, *second), root, "b", sides=ROLLUPS)
    after = rows_of(rolled.model_usage_breakdown(rolled.rolled(spark, root)))
    assert sum(r[1] for r in after) == sum(r[1] for r in before) + 5


def test_side_rows_of_many_parts_are_one_table(spark, tmp_path):
    root = str(tmp_path / "star")
    for i in range(4):
        star.append_part(typed(spark, costly(i, 1)), root, f"p{i}", sides=(COST_MOMENTS,))
    log = sidetables.brought_up(spark, root, COST_MOMENTS, *ROLLUPS)
    for side in (COST_MOMENTS, *ROLLUPS):
        plan = sidetables.read_side(spark, root, log, side)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") <= 2
    assert statistics(sidetables.read_side(spark, root, log, COST_MOMENTS)).first().n == 4


def test_sides_made_late_know_what_was_replaced(spark, tmp_path):
    root = str(tmp_path / "star")
    upsert.incremental_upsert(typed(spark, costly(1, 5), costly(2, 6)), root)
    upsert.incremental_upsert(typed(spark, costly(1, 8, T0 + 30 * HOUR)), root)
    rows = rolled.rolled(spark, root)
    assert rolled.kpis(rows).first().total_cost_usd == 14.0
    log = sidetables.brought_up(spark, root, COST_MOMENTS)
    assert tuple(statistics(sidetables.read_side(spark, root, log, COST_MOMENTS)).first())[:2] == (2, 7.0)


# The id index


def test_an_id_whose_time_changed_is_replaced(spark, tmp_path):
    root = str(tmp_path / "star")
    upsert.incremental_upsert(typed(spark, costly(1, 5), costly(2, 6)), root)
    later = T0 + 100 * HOUR
    for delta in ([costly(1, 8, later)], [costly(1, 8, later)]):
        upsert.incremental_upsert(typed(spark, *delta), root)
    rows = sorted((r.event_id, r.cost_usd, r.epoch_ms) for r in star.read_events(spark, root).collect())
    assert rows == [("c1", 8.0, later), ("c2", 6.0, T0)]
    # the first delivery again: the one that comes last counts, and it can change its mind
    upsert.incremental_upsert(typed(spark, costly(1, 5)), root)
    star.compact(spark, root)
    rows = sorted((r.event_id, r.cost_usd, r.epoch_ms) for r in star.read_events(spark, root).collect())
    assert rows == [("c1", 5.0, T0), ("c2", 6.0, T0)]
    # a rejected event replaces nothing
    upsert.incremental_upsert(typed(spark, {**costly(2, 1, later), "message": "{"}), root)
    assert star.read_star(spark, root).fact_api_requests.count() == 2


def test_a_lookup_reads_the_buckets_of_its_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(idindex, "BUCKET_ROWS", 4)
    root = str(tmp_path / "star")
    upsert.incremental_upsert(typed(spark, *[error(i) for i in range(200)]), root)
    log = read_log(spark, root)
    entry = log.of(log.version, idindex.TABLE)[-1]
    n = idindex._buckets(entry)
    assert n == 64
    wanted = spark.createDataFrame([("x7",), ("x9",), ("nobody",)], "event_id string")
    hit = {r.b for r in wanted.select(idindex.bucket_of(n).alias("b")).collect()}
    found = idindex.looked_up(spark, root, log, wanted)
    assert sorted((r.event_id, r.epoch_ms, r.is_good) for r in found.collect()) == [("x7", T0, True), ("x9", T0, True)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("FileScan parquet ") if "bucket#" in x.split("PushedFilters")[0].split("PartitionFilters")[-1])
    buckets = scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert all(str(b) in buckets for b in hit)
    assert "In(event_id, " in scan
    read = found.select(F.input_file_name().alias("file")).distinct().collect()
    assert {int(r.file.split("bucket=")[1].split("/")[0]) for r in read} <= hit
    # beyond the ids that are pushed, the same by a join
    monkeypatch.setattr(idindex, "PUSHED_IDS", 1)
    assert same(idindex.looked_up(spark, root, log, wanted), found)


def test_index_files_have_bloom_filters(spark, tmp_path):
    import pyarrow.parquet as pq

    root = str(tmp_path / "star")
    upsert.incremental_upsert(typed(spark, *[request(i) for i in range(50)]), root)
    (path,) = (tmp_path / "star").rglob("ids/*/part=*/bucket=*/*.parquet")
    raw = path.read_bytes()
    meta = pq.ParquetFile(path).metadata
    # the filter lies between the columns and the footer: more bytes than the columns take
    columns = sum(meta.row_group(0).column(i).total_compressed_size for i in range(meta.num_columns))
    assert len(raw) > columns + meta.serialized_size + 1024


def test_plain_parts_are_indexed_when_an_upsert_needs_it(spark, tmp_path):
    root = str(tmp_path / "star")
    star.append_part(typed(spark, request(1), request(2)), root, "plain")
    upsert.incremental_upsert(typed(spark, request(2), request(3)), root)
    assert sorted(r.event_id for r in star.read_events(spark, root).collect()) == ["r1", "r2", "r3"]
    log = read_log(spark, root)
    assert sorted(log.parts(log.version, idindex.TABLE)) == sorted(log.parts(log.version))


# Counts taken while writing


def recounted(spark, root):
    events = star.read_events(spark, root)
    rows = events.agg(*[F.count_if(F.expr(c)).alias(name) for name, c in star.COUNTS.items()]).first().asDict()
    return sorted((*name.split("."), n) for name, n in rows.items())


def test_counts_of_the_writing_jobs_equal_a_recount(spark, tmp_path):
    root = str(tmp_path / "star")
    first, second = two_days()
    star.append_part(typed(spark, *first, event({"body": "z"}, id="z"), event("junk", id="j")), root)
    assert sorted(map(tuple, star.load_counts(spark, root).collect())) == recounted(spark, root)
    upsert.incremental_upsert(typed(spark, *second, first[0], first[8]), root)
    upsert.incremental_upsert(typed(spark, costly(3, "x", T0 + 50 * HOUR), tool(2, T0 + 50 * HOUR)), root)
    assert sorted(map(tuple, star.load_counts(spark, root).collect())) == recounted(spark, root)
    star.compact(spark, root)
    found = sorted(map(tuple, star.load_counts(spark, root).collect()))
    assert found == recounted(spark, root) and ("fact_api_requests", "rejected_rows", 0) not in found


def test_counts_are_taken_in_the_stage_that_writes(spark):
    """There a task's counts come from the run that finishes; before the shuffle a stage that runs again would add to them."""
    seen = Observation()
    observed = typed(spark, request(1)).hint("rebalance", "table").observe(seen, *star.counters())
    plan = observed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("CollectMetrics") < plan.index("RebalancePartitions")
