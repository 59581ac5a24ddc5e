import json

import pytest
from pyspark.sql import functions as F

from gramline.operators import model, scoring, search
from gramline.plans import flows
from gramline.sources import registry, tables
from gramline.streaming.scoring import read_responses, score_stream

SMALL = model.Params(ngram_min=2, ngram_max=3, n_estimators=5, min_df=2, max_df=0.9, max_depth=4, min_class_frequency=5)


def _texts(n=60):
    animals, tools = ["cat", "dog", "bird", "zebra"], ["hammer", "wrench", "drill", "saw"]
    return [(i, f"the {(animals if i % 2 else tools)[i // 2 % 4]} number {i % 7}", "animal" if i % 2 else "tool") for i in range(n)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(_texts(), "row_id bigint, tweet string, target string")


@pytest.fixture(scope="module")
def fitted(rows):
    return model.fit_text_model(rows, SMALL)


def test_learns(fitted, rows):
    hits = model.predict(fitted, rows).filter("target = predicted").count()
    assert hits > 55
    assert model.classes(fitted) == ["animal", "tool"]


def test_probabilities(spark, fitted):
    odd = spark.createDataFrame([("",), ("unseen qqq",), ("the cat",)], "tweet string")
    for row in model.predict_proba(fitted, odd).collect():
        assert set(row["scores"]) == {"animal", "tool"} and sum(row["scores"].values()) == pytest.approx(1)


def test_saved_model_scores_the_same(fitted, rows, tmp_path):
    tables.save_model(fitted, str(tmp_path / "m"))
    loaded = tables.load_model(str(tmp_path / "m"))
    key = lambda df: sorted((r["row_id"], r["scores"]["tool"]) for r in df.collect())
    assert key(model.predict_proba(loaded, rows)) == key(model.predict_proba(fitted, rows))


def test_same_rows_give_the_same_model_on_any_number_of_partitions(spark, rows):
    def scores(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        try:
            found = model.predict_proba(model.fit_text_model(rows.repartition(partitions), SMALL), rows)
            return sorted((r["row_id"], r["scores"]["tool"]) for r in found.collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")

    assert scores(4) == scores(7)


def test_bound_on_the_rows_of_a_fit(rows):
    few = model.replace(SMALL, fit_rows=20)
    assert model.fit_sample(rows, few, "row_id", "tweet", "target").groupBy("target").count().collect() != []
    assert model.fit_sample(rows, few, "row_id", "tweet", "target").count() == 20
    assert model.fit_text_model(rows, few).vocabulary.n == 60
    assert model.cross_val_accuracy(rows, few, 3).first()["accuracy"] > 0.8


def test_vocabulary_of_any_size(spark):
    grams = spark.range(300_000).selectExpr("lpad(id, 8, '0') AS gram", "2L AS df", "1.5D AS idf")
    vocabulary, size = model.numbered(model.Vocabulary(grams, 10, 8, 8))
    assert size == 300_000 and vocabulary.grams.filter("index != cast(gram AS int)").isEmpty()


def test_cross_validation(rows):
    assert model.cross_val_accuracy(rows, SMALL, 3).first()["accuracy"] > 0.9
    assert model.cross_val_accuracy(rows, SMALL, 3, fit_scope="train").first()["accuracy"] > 0.9
    with pytest.raises(ValueError, match="fit_scope"):
        model.cross_val_accuracy(rows, SMALL, 3, fit_scope="test")


REQUESTS = [
    ('{"data": ["the cat"]}', "the cat"),
    ('{"data": ["the cat", "the saw"]}', "the cat"),
    ('{"data": [""]}', ""),
    ('{"data": "the cat"}', "t"),
    ('{"data": ""}', None),
    ("{'data': ['the cat']}", None),
    ('{"data": [[\'the cat\']]}', None),
    ('{"data": [["the cat"]]}', None),
    ('{"data": [3]}', None),
    ('{"data": [null]}', None),
    ('{"data": []}', None),
    ('{"data": {"0": "x"}}', None),
    ('{"text": ["the cat"]}', None),
    ("[]", None),
    ("junk", None),
    ("", None),
    (None, None),
]


def test_requests(spark, fitted):
    df = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(REQUESTS)], "id int, body string")
    parsed = {r["id"]: r["tweet"] for r in scoring.parse_requests(df, "body").collect()}
    assert [parsed[i] for i in range(len(REQUESTS))] == [t for _, t in REQUESTS]
    for row in scoring.answer_requests(fitted, df, "body").collect():
        answer = json.loads(row["response"])
        assert (answer == {}) == (REQUESTS[row["id"]][1] is None)


def test_prepared_scoring_keeps_every_row(spark, fitted):
    df = spark.createDataFrame([(1, "The cats"), (2, "the"), (3, None)], "id int, tweet string")
    got = {r["id"]: r for r in scoring.score_batch(fitted, df, prepare=True).collect()}
    assert got[1]["tweet"] == "The cats" and got[2]["scores"] and got[3]["scores"] is None


def test_ranking(spark):
    df = spark.createDataFrame([(1, {"b": 0.25, "a": 0.25, "c": 0.5}), (2, {})], "id int, scores map<string,double>")
    got = [tuple(r) for r in scoring.rank_scores(df).collect()]
    assert got == [(1, 1, "c", 0.5), (1, 2, "a", 0.25), (1, 3, "b", 0.25)]
    assert [r["class"] for r in scoring.rank_scores(df, k=1).collect()] == ["c"]


def test_split_requests(spark):
    body = '{"index": [7, 8], "columns": ["other", "tweet"], "data": [["x", "one"], ["y", "two"]]}'
    got = scoring.decode_split(spark.createDataFrame([(body,), ("junk",)], "body string"), "body")
    assert [(r["index"], r["tweet"]) for r in got.collect()] == [(7, "one"), (8, "two")]
    one = scoring.encode_records(spark.createDataFrame([('say "x"',)], "tweet string")).first()["body"]
    assert json.loads(one) == [{"tweet": 'say "x"'}]


def test_stream_answers_like_a_batch(spark, fitted, tmp_path):
    bodies = [b for b, _ in REQUESTS if b]
    for i, half in enumerate((bodies[:5], bodies[5:])):
        spark.createDataFrame([(b,) for b in half], "body string").write.mode("append").parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema("body string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    score_stream(fitted, arriving, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True).awaitTermination()
    batch = scoring.answer_requests(fitted, spark.read.parquet(str(tmp_path / "in")), "body")
    streamed = read_responses(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


@pytest.fixture(scope="module")
def csv(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("csv") / "in")
    tables.write_prepared(rows.select("tweet", "target"), path, "csv")
    return path


def test_flow_a(spark, csv, tmp_path):
    outcome = flows.flow_a(spark, csv, str(tmp_path), SMALL, cut=True)
    assert outcome.version == 1 and outcome.predictions.count() == 12
    assert tables.read_metrics(spark, f"{tmp_path}/metrics").first()["value"] > 0.7
    newest = registry.latest_model(registry.read_registry(spark, f"{tmp_path}/registry"), flows.MODEL_A).first()
    assert model.classes(tables.load_model(newest["path"])) == ["animal", "tool"]


def test_search_a(spark, rows, monkeypatch):
    space = {"min_df": ("int", 1, 3), "ngram_min": ("int", 2, 4), "ngram_max": ("int", 4, 6), "n_estimators": ("int", 3, 5)}
    monkeypatch.setattr(flows.search, "SPACE_A", {**space, "min_class_frequency": ("int", 1, 60)})
    results = flows.search_a(rows.withColumn("split", F.lit("train")), 4, 4, SMALL)
    scores = {r["min_class_frequency"]: r["accuracy"] for r in results.collect()}
    assert all((s is None) == (k > 30) for k, s in scores.items()) and len(scores) == 4
    best = search.best_trial(results, "accuracy").first()
    assert best["accuracy"] == max(s for s in scores.values() if s is not None) > 0.8
    assert SMALL.with_trial(best.asDict()).n_estimators == best["n_estimators"]


def test_flow_b(spark, csv, tmp_path, monkeypatch):
    monkeypatch.setattr(flows.search, "SPACE_B", {**flows.search.SPACE_B, "n_estimators": ("int", 3, 8)})
    outcome = flows.flow_b(spark, csv, str(tmp_path), SMALL, n_trials=2, parallelism=2)
    logged = tables.read_metrics(spark, f"{tmp_path}/metrics")
    assert {r["name"] for r in logged.collect()} == {
        "Accuracy", "Precision", "Recall", "F1", "Number of classes", "Dataset Version"
    }
    newest = registry.latest_model(registry.read_registry(spark, f"{tmp_path}/registry"), flows.MODEL_B).first()
    assert newest["tags"]["label"] == "target" and float(newest["properties"]["Accuracy"]) > 0.5
    assert tables.read_report(spark, newest["path"] + "-report").count() >= 4
    assert outcome.version == 1


def test_without_a_bound_the_forest_sees_every_row(spark, monkeypatch):
    """The flows' own settings draw no sample, however many rows there are."""
    assert model.FLOW_A.fit_rows is None and model.FLOW_B.fit_rows is None
    many = spark.range(20_500).selectExpr("id AS row_id", "concat('word', id % 9) AS tweet", "if(id % 3 = 0, 'a', 'b') AS target")
    assert model.fit_sample(many, model.FLOW_A, "row_id", "tweet", "target").count() == 20_500
    fitted, real = [], model.forest.grow

    def grow(vectors, plans, n_classes, rows):
        fitted.extend(vectors.filter(F.col("folds")[p.split] >= 0).filter(F.col("folds")[p.split] != (-1 if p.fold is None else p.fold)).count() for p in plans)
        return real(vectors, plans, n_classes, rows)

    monkeypatch.setattr(model.forest, "grow", grow)
    tiny = model.replace(SMALL, n_estimators=1, max_depth=1, min_df=1, max_df=1.0)
    model.fit_text_model(many, tiny)
    assert model.cross_val_accuracy(many.unionByName(many.withColumn("row_id", F.col("row_id") + 20_500)), tiny, 2).first()["accuracy"] >= 0.6
    trials = spark.createDataFrame([(0, 1)], "trial_id bigint, n_estimators int")
    assert search.evaluate_trials(many.unionByName(many.withColumn("row_id", F.col("row_id") + 20_500)), trials, tiny).first()["trees"] == 1
    assert fitted == [20_500, 20_500, 20_500, 32_800]


def test_vectors_are_not_collected_to_be_broadcast(spark, rows, monkeypatch):
    """However small Spark takes them to be."""
    rows = model.written(rows, "rows")
    vocabulary, size = model.numbered(model.fit_vocabulary(rows, "tweet", 2, 3, 1, 1.0))
    of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in of(model.with_features(vocabulary, size, rows, "row_id", "tweet"))
    plans = []
    monkeypatch.setattr(model, "written", lambda df, name: plans.append((name, of(df))) or df)
    model.vectorise(vocabulary, size, rows, "row_id", "tweet", "target")
    assert all("Broadcast" not in plan for _, plan in plans) and "vectors" in dict(plans)
