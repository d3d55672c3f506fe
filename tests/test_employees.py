"""Employee CSV: any text comes back as it was, and every malformed record is counted with a reason."""

import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import rows_of
from tests.test_parse import event, line
from usagelens.plans import ingest
from usagelens.schemas import CONTRACT
from usagelens.sources import employees, star

HEADER = "email,full_name,practice,level,location"
numbers = itertools.count()


def written(tmp_path, *records, header=HEADER, end="\n"):
    folder = tmp_path / f"people{next(numbers)}"
    folder.mkdir()
    (folder / "a.csv").write_bytes((end.join([header, *records]) + end).encode())
    return str(folder)


def judged(spark, path):
    rows = employees.read_records(spark, path).orderBy("file", "record").collect()
    return [r.reason or tuple(r)[:5] for r in rows]


GOOD = "a@x,Ann,P,L1,Peru"
ANN = ("a@x", "Ann", "P", "L1", "Peru")


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_reasons(spark, tmp_path, end):
    path = written(
        tmp_path, GOOD, "b@x,Bo", GOOD + ",more,fields", 'c@x,"Cy,P,L1,Peru', "", GOOD, '"d@x","D ""Di"" D",,"",Chile', 'e@x,E"d,P,L1,Peru',
        'f@x,"Fi"x,P,L1,Peru', GOOD, end=end,
    )
    few, many, quotes = employees.TOO_FEW, employees.TOO_MANY, employees.QUOTES
    assert judged(spark, path) == [ANN, few, many, quotes, ANN, ("d@x", 'D "Di" D', None, "", "Chile"), quotes, quotes, ANN]
    rejected = employees.rejected_employees(spark, path).orderBy("source_offset").collect()
    assert [(r.stage, r.reason, r.source_offset) for r in rejected] == [
        ("employee", few, 2), ("employee", many, 3), ("employee", quotes, 4), ("employee", quotes, 7), ("employee", quotes, 8)
    ]
    assert all(r.source_file.endswith("a.csv") for r in rejected)
    assert [r.raw for r in rejected][2] == 'c@x,"Cy,P,L1,Peru'


def test_an_unclosed_quote_costs_its_line_only(spark, tmp_path):
    quotes = employees.QUOTES
    # the next quoted field would close it, and the two lines would pass for one record of five fields
    path = written(tmp_path, 'b@x,"Bo,P,L1,Peru', 'c@x,"Cy",Q,L2,Chile', '"d@x","D\nD",P,L1,"Peru"', 'z@x,"Zed')
    assert judged(spark, path) == [quotes, ("c@x", "Cy", "Q", "L2", "Chile"), ("d@x", "D\nD", "P", "L1", "Peru"), quotes]


def test_files_may_order_their_columns_differently(spark, tmp_path):
    path = written(tmp_path, GOOD)
    (tmp_path / path / "b.csv").write_text("﻿level,extra,email,full_name,practice,location\nL2,x,b@x,Bo,Q,Chile\n")
    (tmp_path / path / "c.csv").write_text("email,level\nc@x,L3\n")
    (tmp_path / path / "d.csv").write_text("")
    (tmp_path / path / "e.csv").write_text(HEADER)
    assert judged(spark, path) == [ANN, ("b@x", "Bo", "Q", "L2", "Chile"), employees.NO_COLUMN]


def test_long_fields(spark, tmp_path):
    long = 'x""' * 200_000
    path = written(tmp_path, f'a@x,"{long}\n{long}",P,L1,Peru', 'b@x,"' + "y" * 300_000, GOOD)
    (first, *rest) = judged(spark, path)
    assert first[1] == 'x"' * 200_000 + "\n" + 'x"' * 200_000
    assert rest == [employees.QUOTES, ANN]


texts = st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"]), max_size=8), st.text('",\n\r \t\\﻿\0a', max_size=8))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(*[texts] * 5), max_size=8))
def test_round_trip_of_any_text(spark, tmp_path, rows):
    path = str(tmp_path / f"out{next(numbers)}")
    employees.write_employees(spark.createDataFrame(rows, CONTRACT["dim_employees"]), path)
    records = employees.read_records(spark, path)
    assert records.filter("reason IS NOT NULL").count() == 0
    assert sorted(map(str, rows_of(employees.read_employees(spark, path)))) == sorted(map(str, rows))


def test_rejected_employees_are_in_the_report_of_the_load(spark, tmp_path):
    logs = tmp_path / "logs.jsonl"
    logs.write_text(line(event({"body": "other"}, id="u")) + "\njunk\n")
    root = str(tmp_path / "star")
    ingest.load_star(spark, str(logs), written(tmp_path, GOOD, "b@x,Bo", 'c@x,"Cy,P'), root)
    report = {(r.table_name, r.detail): r.row_count for r in ingest.load_report(spark, root).collect()}
    assert report == {("quarantine", "batch"): 1, ("quarantine", "employee"): 2, ("unknown_body", "other"): 1}
    reasons = sorted(r.reason for r in star.read_quarantine(spark, root).filter("stage = 'employee'").collect())
    assert reasons == [employees.QUOTES, employees.TOO_FEW]
    assert star.read_star(spark, root).dim_employees.count() == 1
