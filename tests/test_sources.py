import json
import os

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gramline.operators import metrics
from gramline.sources import large_csv, registry, tables

CSV = '''id,tweet,target
1,"two
lines",a
2,"say ""hi"", you",b
3,NA,c
4,"",d
5,no label,
'''


def test_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text(CSV)
    got = [tuple(r) for r in tables.read_labelled_csv(spark, str(tmp_path)).collect()]
    assert got == [("two\nlines", "a"), ('say "hi", you', "b"), ("NA", "c"), (None, "d"), ("no label", None)]


def test_written_csv_reads_back(spark, tmp_path):
    rows = [(' "quoted", spaced ', "a"), ("two\r\nlines\n", "b"), ('"', "d"), ("back\\slash", "e")]
    tables.write_prepared(spark.createDataFrame(rows, "tweet string, target string"), str(tmp_path / "out"), "csv")
    got = tables.read_labelled_csv(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, got.collect())) == sorted(rows)


FIELDS = st.text(alphabet='ab," \n\r', max_size=12)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(FIELDS, FIELDS), min_size=1, max_size=12), st.sampled_from(["\n", "\r\n"]), st.integers(5, 60))
def test_files_cut_anywhere(spark, tmp_path_factory, rows, line_end, split):
    """Blocks far smaller than a record give the same rows as a plain CSV reader."""
    path = tmp_path_factory.mktemp("cut")
    quoted = [",".join('"' + f.replace('"', '""') + '"' for f in ("1", *row)) for row in rows]
    for name in ("a.csv", "b.csv"):
        (path / name).write_text(line_end.join(['id,tweet,"target"', *quoted]) + line_end, newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        got = [tuple(r) for r in tables.read_labelled_csv(spark, str(path), cut=True).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    key = lambda row: tuple((v is not None, v or "") for v in row)
    expected = [tuple(f or None for f in row) for row in rows for _ in range(2)]
    assert sorted(got, key=key) == sorted(expected, key=key)


LINES = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 2), st.text(alphabet='x"', max_size=3)), max_size=30)


@settings(max_examples=60, deadline=None)
@given(LINES, st.lists(st.integers(0, 30), max_size=6))
def test_both_readings_of_a_block(lines, cuts):
    """However a task's lines are dealt to batches, each gets the last start before it for both readings of its block."""
    lines = [(f, b, i, v) for i, (f, b, v) in enumerate(sorted(lines, key=lambda x: x[:2]))]
    names = ["file", "block", "pos", "value"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    ends = sorted({0, len(lines), *(c for c in cuts if c < len(lines))})
    batches = [
        pa.RecordBatch.from_arrays([pa.array([x[i] for x in lines[lo:hi]], k) for i, k in enumerate(kinds)], names)
        for lo, hi in zip([0, *ends], ends, strict=False)
    ]
    got = [tuple(r.values()) for b in large_csv._read_both_ways(iter(batches)) for r in b.to_pylist()]
    expected = []
    for f, b, pos, value in lines:
        block = [x for x in lines if x[:2] == (f, b) and x[2] <= pos]
        odd = {x[2]: sum(y[3].count('"') for y in block if y[2] < x[2]) % 2 for x in block}
        last = [max((p for p, o in odd.items() if o == state), default=None) for state in (0, 1)]
        expected.append((f, b, pos, value, value.count('"'), *last))
    assert got == expected


def test_scan_of_a_csv_moves_no_line(spark, tmp_path, monkeypatch):
    plans = []
    monkeypatch.setattr(large_csv, "written", lambda df, name: plans.append(df) or df)
    (tmp_path / "x.csv").write_text(CSV)
    large_csv._counted_lines(spark, str(tmp_path))
    assert "Exchange" not in plans[0]._jdf.queryExecution().executedPlan().toString()


def test_cut_and_whole_files_agree(spark, tmp_path):
    (tmp_path / "x.csv").write_text(CSV)
    whole = tables.read_labelled_csv(spark, str(tmp_path)).collect()
    assert sorted(map(str, tables.read_labelled_csv(spark, str(tmp_path), cut=True).collect())) == sorted(map(str, whole))


@pytest.mark.parametrize("stray", ['5" pipe,A', '5" pipe,A\n6" pipe,A', 'x,"a"b', '"a" ,b'])
def test_a_stray_quote_is_an_error(spark, tmp_path, stray):
    (tmp_path / "x.csv").write_text("tweet,target\n" + stray + "\n" + "plain,B\n" * 20)
    with pytest.raises(Exception, match="a quote"):
        tables.read_labelled_csv(spark, str(tmp_path), cut=True).collect()


def test_columns_go_by_each_files_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("tweet,target\nhello,A\n")
    (tmp_path / "b.csv").write_text('id,target,"tweet"\n1,B,"good\nbye"\n')
    got = tables.read_labelled_csv(spark, str(tmp_path), cut=True).collect()
    assert sorted(map(tuple, got)) == [("good\nbye", "B"), ("hello", "A")]
    with pytest.raises(Exception):
        tables.read_labelled_csv(spark, str(tmp_path)).collect()
    (tmp_path / "c.csv").write_text("text,target\nhello,A\n")
    with pytest.raises(ValueError, match="no column tweet"):
        tables.read_labelled_csv(spark, str(tmp_path), cut=True)


def test_row_ids(spark):
    ids = [r["row_id"] for r in tables.with_row_id(spark.range(100).repartition(4)).collect()]
    assert len(set(ids)) == 100


def test_dataset_versions(spark, tmp_path):
    root = str(tmp_path)
    assert tables.latest_version(spark, root, "d") == 0
    with pytest.raises(ValueError):
        tables.read_dataset(spark, root, "d")
    assert [tables.register_dataset(spark.range(n), root, "d") for n in (1, 2)] == [1, 2]
    assert tables.register_dataset(spark.range(5), root, "other") == 1
    assert tables.read_dataset(spark, root, "d").count() == 2
    assert {r["version"] for r in tables.read_dataset(spark, root, "d", 1).collect()} == {1}


def test_metrics_are_appended(spark, tmp_path):
    path = str(tmp_path / "m")
    for step in range(2):
        tables.log_metrics(spark.createDataFrame([("r", step, "F1", 0.5)], tables.METRICS), path)
    assert tables.read_metrics(spark, path).count() == 2


def test_report_is_one_json_object(spark, tmp_path):
    rows = spark.createDataFrame([("x", "x"), ("y", "x")], "t string, p string")
    report = metrics.classification_report(rows, "t", "p")
    tables.write_report(report, str(tmp_path / "r"))
    files = [f for f in os.listdir(tmp_path / "r") if f.startswith("part")]
    (text,) = [t for f in files if (t := (tmp_path / "r" / f).read_text())]
    parsed = json.loads(text)
    assert parsed["accuracy"] == 0.5 and parsed["x"] == {"precision": 0.5, "recall": 1, "f1-score": pytest.approx(2 / 3), "support": 1}
    assert sorted(map(str, tables.read_report(spark, str(tmp_path / "r")).collect())) == sorted(map(str, report.collect()))


def test_registry(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert registry.latest_model(registry.read_registry(spark, path), "m").count() == 0
    assert registry.register_model(spark, path, "m", "p1") == 1
    assert registry.register_model(spark, path, "m", "p2", {"label": "target"}, {"Accuracy": "0.9"}) == 2
    assert registry.register_model(spark, path, "n", "q") == 1
    newest = registry.latest_model(registry.read_registry(spark, path), "m").first()
    assert (newest["version"], newest["path"], newest["tags"]) == (2, "p2", {"label": "target"})


def test_failed_write_leaves_the_name_usable(spark, tmp_path):
    root = str(tmp_path / "data")
    broken = spark.range(3).selectExpr("raise_error('lost') AS x")
    with pytest.raises(Exception):
        tables.register_dataset(broken, root, "d")
    assert tables.register_dataset(spark.range(3), root, "d") == 1
    assert tables.read_dataset(spark, root, "d").count() == 3


def test_two_writers_get_two_versions(spark, tmp_path):
    folder = str(tmp_path / "claims")
    assert [tables.claim(spark, folder, 1) for _ in range(3)] == [1, 2, 3]
