"""Every registered query against its SQL, on the smallest given tables."""

import pytest
from compare import connect, difference

from gramline import queries
from gramline.operators import model, search
from gramline.oracle import ORACLE_SQL
from gramline.plans import flows
from gramline.queries import CHECKED_BY_SQL, LEARNED, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_is_checked():
    assert {f.__name__ for f in CHECKED_BY_SQL} == set(ORACLE_SQL)
    assert len(QUERIES) == len(CHECKED_BY_SQL) + len(LEARNED)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF), duck, ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", ["cross_val_accuracy", "evaluate_trials"])
def test_searches_beat_chance(spark, name):
    for row in QUERIES[name](spark, SF).collect():
        assert 0.4 < row["accuracy"] <= 1


def test_training_flows_log_their_metrics(spark):
    a = {r["name"]: r["value"] for r in QUERIES["train_a"](spark, SF).collect()}
    assert set(a) == {"accuracy"}
    b = {r["name"]: r["value"] for r in QUERIES["train_b"](spark, SF).collect()}
    assert set(b) == {"Accuracy", "Precision", "Recall", "F1", "Number of classes", "Dataset Version"}
    assert b["Accuracy"] > 0.7 and b["Dataset Version"] == 1 and b["Number of classes"] >= 2


@pytest.mark.parametrize("name", sorted(f.__name__ for f in LEARNED))
def test_learned_queries_run_with_the_flows_settings(spark, monkeypatch, name):
    """Each query hands the flows' own settings to its operator, which is not run here."""
    asked = {}

    class Asked(Exception):
        pass

    def stands_for(module, operator):
        import inspect

        signature = inspect.signature(getattr(module, operator))

        def ask(*args, **kwargs):
            bound = signature.bind(*args, **kwargs)
            bound.apply_defaults()
            asked.update({"operator": operator, **bound.arguments})
            raise Asked

        monkeypatch.setattr(module, operator, ask)

    for module, operator in [
        (model, "fit_text_model"), (model, "cross_val_accuracy"), (flows, "train_a"), (flows, "train_b"), (flows, "flow_a"),
        (flows, "flow_b"), (search, "evaluate_trials"),
    ]:
        stands_for(module, operator)
    with pytest.raises(Asked):
        QUERIES[name](spark, "/root/testdata/sf0.01")
    flow = model.FLOW_B if asked["operator"] in ("train_b", "flow_b") or name == "evaluate_trials" else model.FLOW_A
    assert (asked.get("params") or asked["defaults"]) == flow
    if name == "cross_val_accuracy":
        assert asked["k"] == 5
    if name == "flow_b":
        assert asked["n_trials"] == 10
    if name in ("search_a", "evaluate_trials"):
        # Flow A's eighteen trials go in rounds of six, of which the first is drawn at random.
        space, n = (search.SPACE_A, 6) if name == "search_a" else (search.SPACE_B, 10)
        assert asked["folds"] == (5 if name == "search_a" else None)
        drawn = search.sample_trials(spark, space, n).collect()
        assert sorted(map(tuple, asked["trials"].collect())) == sorted(map(tuple, drawn))


@pytest.mark.parametrize("files", [0, 3])
def test_a_table_streams_as_a_file_or_as_a_folder_of_files(spark, tmp_path, files):
    rows, path = spark.range(20).toDF("conv_id"), tmp_path / "conversations.parquet"
    if files:
        rows.repartition(files).write.parquet(str(path))
    else:
        rows.toPandas().to_parquet(path)
    rows.toDF("other").write.parquet(str(tmp_path / "pages.parquet"))
    stream = queries._arriving(spark, str(tmp_path), "conversations").writeStream.format("parquet").trigger(availableNow=True)
    stream.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).start().awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(20))
