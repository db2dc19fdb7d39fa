from __future__ import annotations

import gzip
import json
from pathlib import Path

import frames
import pytest
import run_refresh
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import types as T

from activity_mart.contracts import EXTRACTS, FACT, LENDER_EXTRACT
from activity_mart.operators.expectations import QualityGateError
from activity_mart.plans.refresh import refresh
from activity_mart.sources import readers, sinks, store

HEADER = ",".join(LENDER_EXTRACT.columns)
SCHEMA = T.StructType([T.StructField("code", T.StringType()), T.StructField("n", T.LongType())])


def test_bulk_load_resolves_null_tokens_and_padding(spark, tmp_path):
    path = tmp_path / "rows.csv.gz"
    text = 'code,n\n007,1\nNULL,2\nnull,3\n"",4\n,5\n  x  , 6 \n"a,b",NULL\n'
    path.write_bytes(gzip.compress(text.encode()))
    rows = [tuple(r) for r in readers.load_csv(spark, str(path), SCHEMA).collect()]
    assert rows == [("007", 1), (None, 2), (None, 3), (None, 4), (None, 5), ("x", 6), ("a,b", None)]


def test_bulk_load_aborts_on_a_bad_row(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text("code,n\na,1\nb,2,3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.load_csv(spark, str(path), SCHEMA).collect()
    path.write_text("code,n\na,many\n")
    with pytest.raises((SparkRuntimeException, Exception), match="CAST_INVALID_INPUT"):
        readers.load_csv(spark, str(path), SCHEMA).collect()


def test_typed_import_goes_by_header(spark, tmp_path):
    schema = T.StructType([T.StructField("left_key", T.LongType()), T.StructField("right_key", T.LongType()), T.StructField("note", T.StringType())])
    path = tmp_path / "swapped.csv"
    path.write_text('note,extra,right_key,left_key\n"two\nlines",x,20,10\n')
    (row,) = readers.typed_import(spark, str(path), schema, quoted_line_breaks=True).collect()
    assert tuple(row) == (10, 20, "two\nlines")
    with pytest.raises(ValueError, match="absent"):
        readers.typed_import(spark, str(path), T.StructType([*schema.fields, T.StructField("absent", T.LongType())]))


KEYS = T.StructType([T.StructField("left_key", T.LongType()), T.StructField("right_key", T.LongType())])


def test_typed_import_goes_by_each_file_s_header(spark, tmp_path):
    files = {
        "a.csv": "left_key,right_key\n1,2\n3,4\n",
        "b.csv": "right_key,left_key\n20,10\n",
        "c c.csv": 'remark,right_key,left_key\n"x, y",200,100\n',
        "d.csv": "left_key,right_key\n5,6\n",
        "header only.csv": "right_key,left_key\n",
        "nothing.csv": "",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    groups = readers.files_by_header(spark, str(tmp_path))
    assert {names: len(found) for names, found in groups.items()} == {("left_key", "right_key"): 2, ("right_key", "left_key"): 2, ("remark", "right_key", "left_key"): 1}
    found = readers.typed_import(spark, str(tmp_path), KEYS)
    assert sorted(map(tuple, found.collect())) == [(1, 2), (3, 4), (5, 6), (10, 20), (100, 200)]
    # One scan a header, however many files have it.
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 3
    (tmp_path / "e.csv").write_text("left_key,other\n7,8\n")
    with pytest.raises(ValueError, match=r"e\.csv has no column right_key"):
        readers.typed_import(spark, str(tmp_path), KEYS)


def test_typed_import_of_ragged_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("left_key,right_key\n1,2,3\n4\n")
    assert sorted(map(tuple, readers.typed_import(spark, str(tmp_path), KEYS).collect())) == [(1, 2), (4, None)]
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.typed_import(spark, str(tmp_path), KEYS, strict=True).collect()
    (tmp_path / "a.csv").write_text("")
    with pytest.raises(ValueError, match="no file with a header"):
        readers.typed_import(spark, str(tmp_path), KEYS)


def test_extract_files_with_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "\nAlpha,Austin,TX,4,200.00,150.00\n")
    turned = list(reversed(LENDER_EXTRACT.columns))
    (tmp_path / "b.csv").write_text(",".join([*turned, "Note"]) + '\n30,40,2,FL,Miami,Beta,"two\nlines"\n')
    rows = readers.read_extract(spark, str(tmp_path), spec=LENDER_EXTRACT, quoted_line_breaks=True)
    assert rows.columns == [*LENDER_EXTRACT.columns, "Note"]
    assert sorted(map(tuple, rows.collect())) == [("Alpha", "Austin", "TX", "4", "200.00", "150.00", None), ("Beta", "Miami", "FL", "2", "40", "30", "two\nlines")]
    (tmp_path / "c.csv").write_text(",".join(turned[1:]) + "\n40,2,FL,Miami,Beta\n")
    with pytest.raises(ValueError, match="approved_sba_guaranty_dollars"):
        readers.read_extract(spark, str(tmp_path), spec=LENDER_EXTRACT)


def test_bulk_load_with_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text('code,n\n"a\nb",1\nc,2\n')
    assert [tuple(r) for r in readers.load_csv(spark, str(path), SCHEMA, quoted_line_breaks=True).collect()] == [("a\nb", 1), ("c", 2)]


def test_typed_import_turns_bad_values_into_nulls(spark, tmp_path):
    path = tmp_path / "fact.csv"
    path.write_text(
        ",".join(FACT.names) + "\n1,2,20240930,2024-09-30,4,10.50,5\nx,,bad,never,1.5,$1,\n", encoding="utf-8"
    )
    first, second = readers.typed_import(spark, str(path), FACT).collect()
    assert (first.lender_key, first.date_key, str(first.approved_dollars)) == (1, 20240930, "10.50")
    assert all(value is None for value in second)


def test_extract_columns_stay_text(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('DO Code,Name\n0651,"a ""quoted"", name"\n')
    frame = readers.read_extract(spark, str(path))
    assert {f.dataType for f in frame.schema} == {T.StringType()}
    assert tuple(frame.first()) == ("0651", 'a "quoted", name')


def test_missing_sources_are_fatal(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        readers.read_extract(spark, str(tmp_path / "absent"))
    with pytest.raises(FileNotFoundError, match="table specification"):
        readers.load_specs(str(tmp_path / "absent.json"))


def test_specs_from_json(spark, tmp_path):
    spec = {"sheet": "Lender", "required_text": ["lender"], "columns": {"Lender": "lender"}}
    path = tmp_path / "specs.json"
    path.write_text(json.dumps({"tables": {"t": spec}}))
    loaded = readers.load_specs(str(path))["t"]
    assert (loaded.name, loaded.section, loaded.required_text) == ("t", "Lender", ("lender",))
    assert readers.load_specs(str(path), spark) == {"t": loaded}
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        readers.load_specs(str(tmp_path / "absent.json"), spark)


def test_csv_sink_keeps_padding_and_overwrites(spark, tmp_path):
    path = str(tmp_path / "out")
    for value in (" old ", " new "):
        frame = spark.createDataFrame([(value, None)], "a string, b string")
        back = sinks.write_table(frame, path, "csv")
    assert [tuple(r) for r in back.collect()] == [(" new ", None)]


def test_views_are_replaced(spark):
    for n in (1, 2):
        sinks.register_views({"v": spark.range(n)})
    assert spark.sql("SELECT count(*) AS n FROM v").first().n == 2


def test_stored_tables_come_back_whole(spark):
    frame = frames.counties(spark)
    back = store.stored(frame, "t", partition_by=["project_state"])
    assert back.columns == frame.columns and sorted(back.collect()) == sorted(frame.collect())


def deliver(root, lender_rows):
    counties = ",".join(EXTRACTS["sba_lender_county_activity"].columns)
    offices = ",".join(EXTRACTS["sba_district_office_activity"].columns)
    texts = {
        "Lender": [HEADER, *lender_rows],
        "Lender_ProjCnty": [counties, "Alpha,Austin,TX,TX,TRAVIS,4,200.00,150.00", "Beta,Miami,FL,FL,DADE,2,40,30"],
        "Lender_DO": [offices, "Alpha,Austin,TX,0651,DALLAS,4,200.00,150.00"],
    }
    for section, lines in texts.items():
        (root / section).mkdir(parents=True)
        (root / section / "part.csv").write_text("\n".join(lines) + "\n")


def test_refresh_writes_every_product(spark, tmp_path):
    deliver(
        tmp_path / "in",
        ["  Alpha ,Austin,TX,4,200.00,150.00", "Beta,Miami,FL,2,40,30", "Bad,Reno,NV,n/a,1,1", ",,,,,"],
    )
    result = refresh(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert result.cleaned["sba_lender_activity"].count() == 2
    assert result.rejected.first().lender == "Bad"
    log = {r.source_table: r for r in result.log.collect()}["sba_lender_activity"]
    assert (log.raw_rows, log.rows_after_blank_drop, log.clean_rows, log.rows_removed) == (4, 3, 2, 2)
    assert log.missing_before == {"approved_loans": 1}
    assert result.report.count() == 19 and result.report.where("status <> 'pass'").isEmpty()
    assert result.star.fact.count() == 2 and len(result.analytics) == 6
    assert spark.sql("SELECT count(*) AS n FROM dim_lender").first().n == 2
    assert spark.read.parquet(str(tmp_path / "out/warehouse/fact_lending_activity")).count() == 2


def test_refresh_gate_raises_after_writing(spark, tmp_path):
    deliver(tmp_path / "in", ["Alpha,Austin,TX,4,200.00,250.00", "Beta,Miami,FL,2,40,30"])
    with pytest.raises(QualityGateError, match="guaranty_not_above_approved"):
        refresh(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/analytics/kpi_summary")).count() == 1


def under(folder):
    return {p for p in folder.rglob("*") if p.is_file()} if folder.exists() else set()


@pytest.mark.parametrize("fails", [False, True])
def test_nothing_of_a_run_remains_but_its_outputs(spark, tmp_path, monkeypatch, fails):
    shared = Path(store.shared_folder(spark).removeprefix("file:"))
    before = under(shared)
    deliver(tmp_path / "in", ["Alpha,Austin,TX,4,200.00,250.00", "Beta,Miami,FL,2,40,30"])
    if fails:
        with pytest.raises(QualityGateError):
            refresh(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    else:
        result = refresh(spark, str(tmp_path / "in"), str(tmp_path / "out"), gate=False)
        for frame in (*result.cleaned.values(), result.rejected, result.log, *result.star.tables().values(), result.report, *result.analytics.values()):
            frame.collect()
    assert under(shared) == before
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"processed", "quality", "warehouse", "analytics"}


def test_a_run_folder_goes_after_an_error(spark):
    with pytest.raises(ZeroDivisionError), store.run_folder(spark) as folder:
        back = store.side_by_side(spark, {"t": lambda: store.stored(spark.range(3), "t")})["t"]
        assert back.count() == 3 and all(folder in f for f in back.inputFiles())
        1 / 0  # noqa: B018
    assert not Path(folder.removeprefix("file:")).exists()
    assert "run-" not in store.new_path(spark, "t")


def test_refresh_as_csv_files(spark, tmp_path):
    deliver(tmp_path / "in", ["Alpha ,Austin,TX,4,200.00,150.00", "Beta,Miami,FL,2,40,30", "Bad,Reno,NV,n/a,1,1"])
    typed = refresh(spark, str(tmp_path / "in"), str(tmp_path / "parquet"))
    text = refresh(spark, str(tmp_path / "in"), str(tmp_path / "csv"), out_fmt="csv")
    tables = {**typed.cleaned, **typed.star.tables(), **typed.analytics, "rejects": typed.rejected, "report": typed.report}
    others = {**text.cleaned, **text.star.tables(), **text.analytics, "rejects": text.rejected, "report": text.report}
    for name, frame in tables.items():
        assert frame.schema.simpleString() == others[name].schema.simpleString()
        assert sorted(map(repr, frame.collect())) == sorted(map(repr, others[name].collect())), name
    header = next((tmp_path / "csv/warehouse/fact_lending_activity").glob("*.csv")).read_text().splitlines()[0]
    assert header == ",".join(FACT.names)
    assert '"{""approved_loans"":1}"' in "".join(f.read_text() for f in (tmp_path / "csv/quality/cleaning_log").glob("*.csv"))


def test_the_job_reports_and_returns_an_exit_code(spark, tmp_path, capsys):
    deliver(tmp_path / "good", ["Alpha,Austin,TX,4,200.00,150.00", "Beta,Miami,FL,2,40,30"])
    assert run_refresh.main([str(tmp_path / "good"), str(tmp_path / "out1")]) == 0
    assert "$240 approved across 6 loans" in capsys.readouterr().out
    deliver(tmp_path / "bad", ["Alpha,Austin,TX,4,200.00,250.00", "Beta,Miami,FL,2,40,30"])
    assert run_refresh.main([str(tmp_path / "bad"), str(tmp_path / "out2")]) == 1
