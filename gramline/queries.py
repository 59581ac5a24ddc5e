"""The registered queries: every operator run over whole given tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramline.functions import payload
from gramline.operators import features, forest, metrics, model, relational, scoring, search, splits, text
from gramline.plans import flows
from gramline.plans.storage import scratch_path, spread, written
from gramline.sources import registry, tables
from gramline.streaming.scoring import read_responses, score_stream

#: The class bound where the flows' own leaves fewer than two classes to tell apart, as on the smallest tables.
SMALL_CLASSES = 20


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark, sf, label: str = "lang") -> DataFrame:
    """(row_id, tweet, target)"""
    return relational.select_labelled(table(spark, sf, "documents"), "text", label, "doc_id")


def messages(spark, sf) -> DataFrame:
    """(row_id, tweet, target): conversation turns labelled by role, with a whole-number id."""
    turns = table(spark, sf, "conversations")
    width = (turns.agg(F.max("turn")).first()[0] or 0) + 1
    turns = turns.withColumn("id", F.col("conv_id") * width + F.col("turn"))
    return relational.select_labelled(turns, "text", "role", "id")


def judged(spark, sf) -> DataFrame:
    """(row_id, tweet, target): documents with their quality, null where nobody judged them."""
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    rows = table(spark, sf, "documents").select("doc_id", "text").join(labels, "doc_id", "left")
    return relational.select_labelled(rows, "text", "quality", "doc_id")


def guesses(spark, sf) -> DataFrame:
    """(row_id, target, predicted): the language of the next document stands for a prediction."""
    docs = documents(spark, sf).select("row_id", "target")
    following = docs.select((F.col("row_id") - 1).alias("row_id"), F.col("target").alias("predicted"))
    return docs.join(following, "row_id")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def tokens_of(df: DataFrame, tokens: str) -> DataFrame:
    """(row_id, pos, token). The outer form, because the plain one adds a test that computes the tokens twice."""
    return df.select("row_id", F.posexplode_outer(tokens).alias("pos", "token")).filter("pos IS NOT NULL")


# Sources and sinks


def read_labelled_csv(spark, sf):
    path = scratch_path(spark, "csv")
    tables.write_prepared(documents(spark, sf).select("tweet", "target"), path, "csv")
    return tables.read_labelled_csv(spark, path)


def read_labelled_csv_cut(spark, sf):
    path = scratch_path(spark, "csv")
    tables.write_prepared(documents(spark, sf).select("tweet", "target"), path, "csv")
    return tables.read_labelled_csv(spark, path, cut=True)


def write_prepared(spark, sf):
    path = scratch_path(spark, "prepared")
    tables.write_prepared(messages(spark, sf), path)
    tables.write_prepared(relational.drop_nulls(judged(spark, sf), ["tweet", "target"]), path)
    return spark.read.parquet(path)


def _registered(spark, sf) -> str:
    root = scratch_path(spark, "datasets")
    tables.register_dataset(documents(spark, sf, "lang"), root, "docs")
    tables.register_dataset(documents(spark, sf, "source"), root, "docs")
    tables.register_dataset(messages(spark, sf), root, "messages")
    return root


def register_dataset(spark, sf):
    return tables.read_dataset(spark, _registered(spark, sf), "docs")


def read_dataset_version(spark, sf):
    return tables.read_dataset(spark, _registered(spark, sf), "docs", 1)


def log_metrics(spark, sf):
    path = scratch_path(spark, "metrics")
    for step, label in enumerate(["lang", "source"]):
        counts = relational.class_counts(documents(spark, sf, label), "target")
        tables.log_metrics(
            counts.select(
                F.lit(label).alias("run_id"), F.lit(step).cast("bigint").alias("step"), F.col("target").alias("name"),
                F.col("n").cast("double").alias("value"),
            ),
            path,
        )
    return tables.read_metrics(spark, path)


def write_report(spark, sf):
    path = scratch_path(spark, "report")
    tables.write_report(metrics.classification_report(guesses(spark, sf), "target", "predicted"), path)
    return rounded(tables.read_report(spark, path), "precision", "recall", "f1")


# Selecting, filtering, counting


def select_labelled(spark, sf):
    return documents(spark, sf, "source")


def drop_nulls(spark, sf):
    return relational.drop_nulls(judged(spark, sf), ["tweet", "target"])


def filter_min_class_frequency(spark, sf):
    return relational.filter_min_class_frequency(messages(spark, sf), "target", 50)


def filter_min_class_frequency_sources(spark, sf):
    return relational.filter_min_class_frequency(judged(spark, sf), "target", 150).select("row_id", "target")


def filter_known_labels(spark, sf):
    toxic = table(spark, sf, "labels").filter("toxic = 1").select("doc_id")
    train = table(spark, sf, "documents").join(toxic, "doc_id", "left_semi").select(F.col("source").alias("target"))
    return relational.filter_known_labels(documents(spark, sf, "source"), train, "target")


def exclude_rows(spark, sf):
    taken = table(spark, sf, "labels").select(F.col("doc_id").alias("row_id"))
    return relational.exclude_rows(documents(spark, sf), taken, "row_id")


def class_counts(spark, sf):
    return relational.class_counts(documents(spark, sf), "target")


def class_counts_lineitem(spark, sf):
    return relational.class_counts(table(spark, sf, "lineitem"), "l_returnflag")


def n_classes(spark, sf):
    return relational.n_classes(documents(spark, sf, "source"), "target")


def distinct_labels(spark, sf):
    return relational.distinct_labels(messages(spark, sf), "target")


def mean_over_folds(spark, sf):
    folds = splits.stratified_kfold(guesses(spark, sf), "target", "row_id")
    hit = (F.col("target") == F.col("predicted")).cast("int")
    per_fold = folds.groupBy("fold").agg(F.avg(hit).alias("accuracy"))
    return rounded(per_fold.agg(F.avg("accuracy").alias("accuracy")), "accuracy")


# Text


def tokenize_space(spark, sf):
    return tokens_of(text.tokenize_space(spread(documents(spark, sf)), "tweet", "tokens"), "tokens")


def remove_stopwords(spark, sf):
    rows = text.tokenize_space(spread(documents(spark, sf)), "tweet", "tokens")
    return tokens_of(text.remove_stopwords(rows, "tokens", "kept"), "kept")


def stem_tokens(spark, sf):
    rows = text.tokenize_space(spread(documents(spark, sf)), "tweet", "tokens")
    return tokens_of(text.stem_tokens(rows, "tokens", "stems"), "stems")


def join_tokens(spark, sf):
    rows = documents(spark, sf).withColumn("tokens", F.split("tweet", "\n"))
    return text.join_tokens(rows, "tokens", "joined").select("row_id", "joined")


def strip_quotes(spark, sf):
    return text.strip_quotes(documents(spark, sf), "tweet", "bare").select("row_id", "bare")


def char_wb_ngrams(spark, sf):
    rows = features.char_wb_ngrams(spread(messages(spark, sf)), "tweet", "grams", 3, 7)
    return rows.select("row_id", F.posexplode_outer("grams").alias("pos", "gram")).filter("pos IS NOT NULL")


def prepare_text(spark, sf):
    return text.prepare_text(judged(spark, sf)).select("row_id", "tweet", "target")


# Features


def term_frequency(spark, sf):
    return features.term_frequency(messages(spark, sf), "row_id", "tweet", 3, 7)


def document_frequency_of_text(spark, sf):
    return features.document_frequency_of_text(spread(documents(spark, sf)), "tweet", 3, 4)


def document_frequency(spark, sf):
    return features.document_frequency(features.term_frequency(documents(spark, sf), "row_id", "tweet", 3, 4))


def prune_vocabulary(spark, sf):
    docs = documents(spark, sf)
    frequencies = features.document_frequency(features.term_frequency(docs, "row_id", "tweet", 3, 4))
    return features.prune_vocabulary(frequencies, docs.count(), 5, 0.6)


def inverse_document_frequency(spark, sf):
    docs = documents(spark, sf)
    frequencies = features.document_frequency(features.term_frequency(docs, "row_id", "tweet", 3, 4))
    return rounded(features.inverse_document_frequency(frequencies, docs.count()), "idf")


def fold_vocabularies(spark, sf):
    """The vocabulary outside each fold, with the range and limits of flow A."""
    folds = splits.stratified_kfold(spread(messages(spark, sf)), "target", "row_id")
    found = features.fold_vocabularies(folds, "tweet", 3, 7, 5, 0.6)
    return rounded(found, "idf")


def tfidf(spark, sf):
    return rounded(features.tfidf(spread(documents(spark, sf)), "row_id", "tweet", 3, 4, 5, 0.6), "tfidf")


def tfidf_range_a(spark, sf):
    return rounded(features.tfidf(spread(messages(spark, sf)), "row_id", "tweet", 3, 7, 5, 0.6), "tfidf")


def tfidf_range_b(spark, sf):
    return rounded(features.tfidf(spread(messages(spark, sf)), "row_id", "tweet", 4, 7, 5, 0.6), "tfidf")


def tfidf_transform(spark, sf):
    vocabulary = features.fit_vocabulary(spread(documents(spark, sf)), "tweet", 3, 4, 5, 0.6)
    return rounded(features.tfidf_transform(vocabulary, messages(spark, sf), "row_id", "tweet"), "tfidf")


def text_features(spark, sf):
    """The model's own vectors, summed up per row; they must agree with the TF-IDF table."""
    rows = spread(messages(spark, sf))
    vocabulary, size = model.numbered(features.fit_vocabulary(rows, "tweet", 3, 7, 5, 0.6))
    vectors = model.with_features(vocabulary, size, rows, "row_id", "tweet")
    sparse = F.from_json(F.to_json(F.struct("features")), "features struct<values: array<double>>")
    values = vectors.select("row_id", sparse["features"]["values"].alias("values"))
    total = F.aggregate("values", F.lit(0.0), lambda a, x: a + x)
    return values.select("row_id", F.size("values").cast("bigint").alias("n"), F.round(total, 4).alias("total"))


# Splits


def stratified_split(spark, sf):
    return splits.stratified_split(documents(spark, sf), "target", "row_id").select("row_id", "target", "split")


def shuffled_split(spark, sf):
    return splits.shuffled_split(documents(spark, sf), "row_id").select("row_id", "split")


def shuffled_split_lineitem(spark, sf):
    rows = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"))
    return splits.shuffled_split(rows, "row_id")


def stratified_kfold(spark, sf):
    return splits.stratified_kfold(documents(spark, sf), "target", "row_id").select("row_id", "target", "fold")


# Models


def best_splits(spark, sf):
    """The first split of 16 trees, one for every sixteenth of the messages, each seeing all grams of two to three
    characters; `gram` is a gram's place among all of them."""
    rows = messages(spark, sf).filter("tweet IS NOT NULL AND target IS NOT NULL")
    vocabulary, _ = model.numbered(features.fit_vocabulary(rows, "tweet", 2, 3, 1, 1.0))
    weights = features.tfidf_transform(vocabulary, rows, "row_id", "tweet", keep=("index",))
    label = F.when(F.col("target") == "user", 1).otherwise(0).cast("bigint")
    node = F.pmod("row_id", F.lit(16)).cast("int")
    one = F.lit(1).cast("bigint")
    labelled = rows.select("row_id", label.alias("label"), node.alias("node"))
    held = labelled.select("node", forest.class_code(F.col("label")).cast("bigint").alias("code"), one.alias("w"), one.alias("n"))
    entries = weights.join(labelled, "row_id").select(
        "node", forest.entry_code(F.col("index").cast("bigint"), F.col("label"), forest.bin_of(F.col("tfidf")), 0).alias("code"),
        one.alias("w"), one.alias("n"),
    )
    return forest.best_splits(held.unionByName(entries)).withColumnRenamed("distance", "gram")


def _settings(params: model.Params, train: DataFrame) -> model.Params:
    """The flow's settings, with the smaller class bound if fewer than two classes of the training rows reach its own."""
    told_apart = relational.frequent_classes(train, "target", params.min_class_frequency).limit(2).count() == 2
    return params if told_apart else replace(params, min_class_frequency=SMALL_CLASSES)


def _fitted(spark, sf):
    rows = spread(messages(spark, sf))
    params = _settings(model.FLOW_A, rows)
    kept = relational.filter_min_class_frequency(rows, "target", params.min_class_frequency)
    split = written(splits.stratified_split(kept, "target", "row_id"), "split")
    return model.fit_text_model(split.filter("split = 'train'"), params), split.filter("split = 'test'")


def fit_random_forest(spark, sf):
    fitted, test = _fitted(spark, sf)
    return model.predict(fitted, test).select("row_id", "target", "predicted")


def predict_proba(spark, sf):
    fitted, test = _fitted(spark, sf)
    return model.predict_proba(fitted, test).select("row_id", F.explode("scores").alias("class", "probability"))


def save_model(spark, sf):
    fitted, test = _fitted(spark, sf)
    path = scratch_path(spark, "model")
    tables.save_model(fitted, path)
    return model.predict(tables.load_model(path), test).select("row_id", "target", "predicted")


def cross_val_accuracy(spark, sf):
    rows = spread(messages(spark, sf))
    return model.cross_val_accuracy(rows, _settings(model.FLOW_A, rows))


def train_a(spark, sf):
    split = flows.prepare_a(spread(messages(spark, sf)))
    return flows.train_a(split, _settings(model.FLOW_A, split.filter("split = 'train'"))).metrics


def train_b(spark, sf):
    rows = spread(documents(spark, sf))
    return flows.train_b(rows, _settings(model.FLOW_B, rows), 1).metrics


def _csv(rows: DataFrame) -> str:
    path = scratch_path(rows.sparkSession, "csv")
    tables.write_prepared(rows.select("tweet", "target"), path, "csv")
    return path


def flow_a(spark, sf):
    rows, root = messages(spark, sf), scratch_path(spark, "flow-a")
    train = flows.prepare_a(spread(rows)).filter("split = 'train'")
    flows.flow_a(spark, _csv(rows), root, _settings(model.FLOW_A, train))
    return tables.read_metrics(spark, f"{root}/metrics")


def flow_b(spark, sf):
    root = scratch_path(spark, "flow-b")
    flows.flow_b(spark, _csv(documents(spark, sf)), root)
    return tables.read_metrics(spark, f"{root}/metrics")


# Metrics


def accuracy(spark, sf):
    return rounded(metrics.accuracy(guesses(spark, sf), "target", "predicted"), "accuracy")


def weighted_precision(spark, sf):
    return rounded(metrics.weighted_precision(guesses(spark, sf), "target", "predicted"), "weighted_precision")


def weighted_recall(spark, sf):
    return rounded(metrics.weighted_recall(guesses(spark, sf), "target", "predicted"), "weighted_recall")


def weighted_f1(spark, sf):
    return rounded(metrics.weighted_f1(guesses(spark, sf), "target", "predicted"), "weighted_f1")


def classification_report(spark, sf):
    report = metrics.classification_report(guesses(spark, sf), "target", "predicted")
    return rounded(report, "precision", "recall", "f1")


# Search and registry


def _runs(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(F.col("user_id").alias("run_id")).distinct()


def sample_trials_a(spark, sf):
    return rounded(search.draw_parameters(_runs(spark, sf), "run_id", search.SPACE_A), "max_df")


def sample_trials_b(spark, sf):
    return rounded(search.draw_parameters(_runs(spark, sf), "run_id", search.SPACE_B), "max_df")


def search_a(spark, sf):
    return flows.search_a(flows.prepare_a(spread(messages(spark, sf))))


def suggest_trials(spark, sf):
    """Eighteen settings suggested by what users reached with the settings that their ids draw."""
    drawn = rounded(search.draw_parameters(_runs(spark, sf), "run_id", search.SPACE_A), "max_df")
    reached = table(spark, sf, "events").groupBy(F.col("user_id").alias("run_id")).agg(F.max("value").alias("metric"))
    asked = spark.range(18).select((F.col("id") + 1_000_000).alias("run_id"))
    return rounded(search.suggest_trials(drawn.join(reached, "run_id"), asked, search.SPACE_A, "metric", "run_id"), "max_df")


def evaluate_trials(spark, sf):
    """The trials of flow B, tried on the documents."""
    trials = search.sample_trials(spark, search.SPACE_B, 10, model.FLOW_B.seed)
    return search.evaluate_trials(spread(documents(spark, sf)), trials, model.FLOW_B)


def _reports(spark, sf) -> DataFrame:
    """(run_id, step, metric): the best value each user reached per day stands for a run's reports."""
    step = F.datediff(F.to_date("ts"), F.to_date(F.lit("2024-01-01"))).cast("bigint")
    events = table(spark, sf, "events").select(F.col("user_id").alias("run_id"), step.alias("step"), "value")
    return events.groupBy("run_id", "step").agg(F.max("value").alias("metric"))


def bandit_keep(spark, sf):
    return search.bandit_keep(_reports(spark, sf), 3, 0.05)


def surviving_runs(spark, sf):
    return search.surviving_runs(_reports(spark, sf), 20, 200.0)


def _results(spark, sf) -> DataFrame:
    """(trial_id, accuracy, reports): users as trials."""
    runs = table(spark, sf, "events").groupBy(F.col("user_id").alias("trial_id"))
    return runs.agg(F.max("value").alias("accuracy"), F.count("*").alias("reports"))


def best_trial(spark, sf):
    return search.best_trial(_results(spark, sf), "accuracy")


def trial_metrics(spark, sf):
    path = scratch_path(spark, "metrics")
    tables.log_metrics(search.trial_metrics(_results(spark, sf)), path)
    return tables.read_metrics(spark, path)


def register_model(spark, sf):
    """A model registered once per language, with that language's share of all documents as its accuracy."""
    path = scratch_path(spark, "registry")
    shares = relational.class_counts(documents(spark, sf), "target").orderBy("target")
    for row in shares.toLocalIterator():
        n = str(row["n"])
        registry.register_model(spark, path, "docs", f"models/{row['target']}", {"label": "target"}, {"Accuracy": n})
    rows = registry.read_registry(spark, path)
    return rows.select(
        "name", "version", "path", F.col("tags")["label"].alias("label"), F.col("properties")["Accuracy"].alias("accuracy")
    )


def latest_model(spark, sf):
    versions = table(spark, sf, "events").select(
        F.col("event_type").alias("name"),
        F.col("event_id").cast("int").alias("version"),
        F.concat(F.lit("models/"), F.col("event_id")).alias("path"),
        F.create_map(F.lit("label"), F.lit("target")).alias("tags"),
        F.create_map(F.lit("Accuracy"), F.col("value").cast("string")).alias("properties"),
    )
    return registry.latest_models(versions).select("name", "version", "path")


# Scoring


def _requests(spark, sf) -> DataFrame:
    """(row_id, body): one request per message, six in ten of them unusual or broken, each in its own way."""
    t = F.col("tweet")
    good = payload.encode_request(t)
    odd = [
        F.concat(F.lit("{'data': ['"), F.col("row_id"), F.lit("']}")),
        F.lit('{"data": []}'),
        F.to_json(F.struct(F.array(t).alias("text"))),
        F.lit('{"data": [3, "three"]}'),
        F.to_json(F.struct(F.array(F.array(t)).alias("data"))),
        F.to_json(F.struct(t.alias("data"))),
        F.to_json(F.struct(F.array(t, F.lit("second")).alias("data"))),
    ]
    body = good
    for i, broken in enumerate(odd):
        body = F.when(F.pmod("row_id", F.lit(10)) == i, broken).otherwise(body)
    return messages(spark, sf).select("row_id", body.alias("body"))


def parse_requests(spark, sf):
    return scoring.parse_requests(_requests(spark, sf), "body").select("row_id", "tweet")


def _shares(spark, sf) -> DataFrame:
    """(conv_id, scores): each role's share of the turns of a conversation, as a map."""
    counts = table(spark, sf, "conversations").groupBy("conv_id", "role").agg(F.count("*").alias("n"))
    entries = counts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("role", "n"))).alias("counts"))
    total = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, c: a + c["n"])
    shares = F.transform("counts", lambda c: F.struct(c["role"].alias("role"), (c["n"] / F.col("total")).alias("p")))
    return entries.withColumn("total", total).select("conv_id", F.map_from_entries(shares).alias("scores"))


def encode_response(spark, sf):
    short = F.transform_values("scores", lambda k, v: F.round(v, 2))
    return scoring.encode_response(_shares(spark, sf).withColumn("scores", short)).select("conv_id", "response")


def error_to_empty(spark, sf):
    parsed = scoring.parse_requests(_requests(spark, sf), "body")
    long = F.when(F.length("tweet") > 200, 1.0).otherwise(0.0)
    scores = F.when(F.col("tweet").isNotNull(), F.create_map(F.lit("long"), long, F.lit("short"), 1 - long))
    return scoring.encode_response(parsed.withColumn("scores", scores)).select("row_id", "response")


def rank_scores(spark, sf):
    return scoring.rank_scores(_shares(spark, sf))


def rank_scores_top(spark, sf):
    return scoring.rank_scores(_shares(spark, sf), k=1)


def decode_split(spark, sf):
    bodies = scoring.encode_split(messages(spark, sf)).select("row_id", "body")
    return scoring.decode_split(bodies, "body").select("row_id", "index", "tweet")


def encode_records(spark, sf):
    return scoring.encode_records(messages(spark, sf)).select("row_id", "body")


def score_batch(spark, sf):
    fitted, _ = _fitted(spark, sf)
    batch = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("tweet"))
    return scoring.rank_scores(scoring.score_batch(fitted, batch).drop("tweet"))


def _arriving(spark, sf, name: str) -> DataFrame:
    """A table as a file stream. A pattern names it, because a stream takes no path of one file; the table may be a file
    or a folder of files."""
    return spark.readStream.schema(table(spark, sf, name).schema).parquet(f"{sf}/{name}.parque[t]")


def score_stream_requests(spark, sf):
    """The messages arrive as a file stream, become requests and are answered by a running query."""
    fitted, _ = _fitted(spark, sf)
    requests = _arriving(spark, sf, "conversations").select("conv_id", "turn", payload.encode_request(F.col("text")).alias("body"))
    path = scratch_path(spark, "responses")
    score_stream(fitted, requests, path, f"{path}-checkpoint", available_now=True).awaitTermination()
    return read_responses(spark, path).select("conv_id", "turn", "response")


CHECKED_BY_SQL = [
    read_labelled_csv, read_labelled_csv_cut, write_prepared, register_dataset, read_dataset_version, log_metrics, write_report,
    select_labelled, drop_nulls, filter_min_class_frequency, filter_min_class_frequency_sources, filter_known_labels,
    exclude_rows, class_counts, class_counts_lineitem, n_classes, distinct_labels, mean_over_folds, tokenize_space,
    remove_stopwords, stem_tokens, join_tokens, strip_quotes, char_wb_ngrams, prepare_text, term_frequency,
    document_frequency, document_frequency_of_text, prune_vocabulary, inverse_document_frequency, fold_vocabularies,
    tfidf, tfidf_range_a, tfidf_range_b, tfidf_transform, text_features, stratified_split, shuffled_split, shuffled_split_lineitem, stratified_kfold,
    accuracy, weighted_precision, weighted_recall, weighted_f1, classification_report, sample_trials_a,
    sample_trials_b, suggest_trials, bandit_keep, surviving_runs, best_trial, trial_metrics,
    best_splits, register_model, latest_model,
    parse_requests, encode_response, error_to_empty, rank_scores, rank_scores_top, decode_split, encode_records,
]
LEARNED = [
    fit_random_forest, predict_proba, save_model, cross_val_accuracy, train_a, train_b, flow_a, flow_b, search_a,
    evaluate_trials, score_batch, score_stream_requests,
]
QUERIES = {f.__name__: f for f in CHECKED_BY_SQL + LEARNED}
