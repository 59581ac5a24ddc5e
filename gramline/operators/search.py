"""Hyper-parameter trials as tables: drawing them, stopping weak ones, picking the best."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gramline.operators import forest
from gramline.operators.features import Vocabulary, document_frequency_by, inverse_document_frequency, prune_vocabulary, term_frequency
from gramline.operators.model import Params, TextModel, numbered, place_vectors, plan, sparse_rows
from gramline.operators.splits import shuffled_split, stratified_kfold, stratified_split
from gramline.plans.lookup import BROADCAST_BYTES, lookup_join
from gramline.plans.storage import written

SCORES = ("accuracy", "precision", "recall", "f1")
# The names under which trials log their metrics.
METRIC_NAMES = {"Accuracy": "accuracy", "Precision": "precision", "Recall": "recall", "F1": "f1", "Number of classes": "n_classes"}

# Parameter spaces, each bound as (kind, low, high); `int` excludes high.
SPACE_A = {
    "min_class_frequency": ("int", 50, 100),
    "n_estimators": ("int", 5, 120),
    "min_df": ("int", 1, 10),
    "max_df": ("uniform", 0.4, 0.8),
    "ngram_min": ("int", 2, 4),
    "ngram_max": ("int", 4, 10),
}
SPACE_B = {
    "min_doc_freq": ("int", 2, 10),
    "max_doc_freq": ("uniform", 0.4, 0.7),
    "n_estimators": ("int", 1, 1000),
    "min_class_frequency": ("int", 1, 50),
}
PARAMETER_NAMES = {"min_doc_freq": "min_df", "max_doc_freq": "max_df"}


def _draw(id: Column, name: str, seed: int) -> Column:
    """A number in [0, 2**32), the same for the same seed, parameter and trial wherever the row is."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.lit(name), id.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def draw_parameters(trials: DataFrame, id: str, space: dict, seed: int = 42) -> DataFrame:
    """Adds one random value per parameter of the space to every trial."""
    values = {}
    for name, (kind, low, high) in space.items():
        draw = _draw(F.col(id), name, seed)
        if kind == "int":
            value = (F.pmod(draw, F.lit(high - low)) + low).cast("int")
        else:
            value = F.lit(low) + draw / F.lit(2.0**32) * F.lit(high - low)
        values[PARAMETER_NAMES.get(name, name)] = value
    return trials.withColumns(values)


def sample_trials(spark: SparkSession, space: dict, n: int, seed: int = 42) -> DataFrame:
    """n trials (trial_id, parameters...)."""
    return draw_parameters(spark.range(n).withColumnRenamed("id", "trial_id"), "trial_id", space, seed)


def bandit_keep(reports: DataFrame, interval: int = 3, slack: float = 0.05) -> DataFrame:
    """(run_id, step, metric, best, keep) for every interval-th report: keep is false more than `slack` below the best.

    `reports` is (run_id, step, metric), one row per run and step. The best of a step is a partial maximum, joined
    back, so a step that every run reached is not gathered into one task.
    """
    due = reports.filter(F.col("step") % interval == 0)
    best = due.groupBy("step").agg(F.max("metric").alias("best"), F.count("*").alias("n"))
    joined = lookup_join(due, written(best, "best"), ["step"], weight="n")
    return joined.select("run_id", "step", "metric", "best", (F.col("metric") >= F.col("best") - slack).alias("keep"))


def surviving_runs(reports: DataFrame, interval: int = 3, slack: float = 0.05) -> DataFrame:
    """Runs that were kept at every one of their due reports, and runs with none due."""
    dropped = bandit_keep(reports, interval, slack).filter(~F.col("keep")).select("run_id").distinct()
    return reports.select("run_id").distinct().join(dropped, "run_id", "left_anti")


def best_trial(results: DataFrame, metric: str, id: str = "trial_id") -> DataFrame:
    """The row with the highest metric; of equal ones, that with the lowest id. Null and NaN never win. A partial
    maximum, no sort."""
    scored = results.filter(F.col(metric).isNotNull() & ~F.isnan(F.col(metric).cast("double")))
    rank = F.struct(F.col(metric), -F.col(id))
    return scored.agg(F.max_by(F.struct(*results.columns), rank).alias("best")).filter("best is not null").select("best.*")


def grams_in_range(tf: DataFrame, lo: int, hi: int) -> DataFrame:
    """The part of a wider gram table that a narrower range of lengths yields.

    A word shorter than `lo` counts as a whole; a gram with a space at both ends is always a whole word.
    """
    n = F.length("gram")
    whole = F.col("gram").startswith(" ") & F.col("gram").endswith(" ") & (n > 2)
    return tf.filter(n.between(lo, hi) | ((n < lo) & whole))


@dataclass(frozen=True)
class Bandit:
    """Stops trials early: forests grow in `reports` instalments with a report after each, and at every `interval`-th
    report a trial more than `slack` below the best one is stopped."""

    interval: int = 3
    slack: float = 0.05
    reports: int = 4


@dataclass
class _Trial:
    params: Params
    kept: frozenset
    weights: np.ndarray | None = None
    forests: list = field(default_factory=list)  # one per held-out fold
    grown: int = 0
    stopped: bool = False
    scores: dict | None = None
    reason: str | None = None


@dataclass
class Search:
    """What a search found: a row per trial, and its reports (run_id, step, metric)."""

    results: DataFrame
    reports: DataFrame
    _model: Callable

    def model(self, trial_id: int) -> TextModel:
        """The model that a trial was measured with. Only trials with one held-out part have one."""
        return self._model(trial_id)


def weights_of(index: np.ndarray, df: np.ndarray, allowed: np.ndarray, n: int, params: Params, size: int) -> np.ndarray:
    """The idf of each gram of a wider vocabulary, by position, 0 for those that a trial leaves out: too rare or too
    common among its `n` rows, or of a length it does not ask for."""
    low = params.min_df if isinstance(params.min_df, int) else params.min_df * n
    high = params.max_df if isinstance(params.max_df, int) else params.max_df * n
    kept = allowed & (df >= low) & (df <= high) & (df > 0)
    weights = np.zeros(size)
    weights[index * forest.stride(size) % size] = np.where(kept, np.log((1.0 + n) / (1.0 + df)) + 1.0, 0.0)
    return weights


def scores_of(counts: np.ndarray) -> dict[str, float]:
    """Metrics of a confusion matrix, rows the truth: accuracy, and precision, recall and F1 weighted by support."""
    support, given, hits = counts.sum(axis=1), counts.sum(axis=0), np.diag(counts)
    ratio = lambda a, b: np.divide(a, b, out=np.zeros(len(a)), where=b > 0)
    parts = {"precision": ratio(hits, given), "recall": ratio(hits, support), "f1": ratio(2.0 * hits, given + support)}
    total = support.sum()
    return {"accuracy": float(hits.sum() / total)} | {k: float((v * support).sum() / total) for k, v in parts.items()}


class _Shared:
    """One vector table for all trials: counts of the grams of the widest range, found in one superset vocabulary, and
    every way to split the rows that a trial's classes ask for."""

    def __init__(self, df: DataFrame, trials: dict[int, _Trial], names: list[str], folds: int | None, id: str, text: str, label: str):
        self.df, self.names, self.folds = df.withColumn(label, F.col(label).cast("string")), names, folds
        self.id, self.text, self.label = id, text, label
        self.sets = sorted({t.kept for t in trials.values()}, key=sorted)
        self.data = self.df.filter(F.col(text).isNotNull())
        every = [t.params for t in trials.values()]
        self.lo, self.hi = min(p.ngram_min for p in every), max(p.ngram_max for p in every)
        self.grams = written(document_frequency_by(self.data, label, text, self.lo, self.hi), "class-grams")
        least = min(p.min_df if isinstance(p.min_df, int) else 1 for p in every)
        total = self.grams.groupBy("gram").agg(F.sum("df").alias("df")).filter(F.col("df") >= least)
        wide = Vocabulary(total.withColumn("idf", F.lit(1.0)), 0, self.lo, self.hi)
        self.vocabulary, self.size = numbered(wide)
        self.n = {r[0]: r[1] for r in self.data.groupBy(label).agg(F.count("*")).collect()}
        self._read: dict = {}

    def _splits(self, kept: frozenset, params: Params) -> DataFrame:
        """(id, fold, fit): which part of the rows of these classes a row is held out in, and the same for rows that
        forests are fitted on, -1 for others."""
        rows = self.data.filter(F.col(self.label).isin(sorted(kept))).select(self.id, self.label)
        if self.folds:
            split = stratified_kfold(rows, self.label, self.id, self.folds)
            share = (self.folds - 1) / self.folds
        else:
            split = shuffled_split(rows, self.id, seed=params.seed)
            split = split.withColumn("fold", (F.col("split") == "test").cast("int")).drop("split")
            share = 0.8
        n = sum(self.n.get(c, 0) for c in kept) * share
        fit = F.col("fold")
        if params.fit_rows is not None and n > params.fit_rows:
            split = stratified_split(split, self.label, self.id, params.fit_rows / n, params.seed)
            held_out = F.lit(False) if self.folds else F.col("fold") == 1
            fit = F.when((F.col("split") == "train") | held_out, F.col("fold")).otherwise(-1)
        return split.select(self.id, F.col("fold").cast("int").alias("fold"), fit.cast("int").alias("fit"))

    def vectors(self, params: Params) -> DataFrame:
        parts = [self._splits(kept, params).withColumn("_set", F.lit(s)) for s, kept in enumerate(self.sets)]
        of = lambda s, c: F.coalesce(F.max(F.when(F.col("_set") == s, F.col(c))), F.lit(-1))
        ways = [of(s, c) for c in ("fold", "fit") for s in range(len(self.sets))]
        folds = reduce(DataFrame.unionByName, parts).groupBy(self.id).agg(F.array(*ways).alias("folds"))
        rows = self.data.select(self.id, self.label).join(folds, self.id)
        tf = term_frequency(self.data.select(self.id, self.text), self.id, self.text, self.lo, self.hi)
        known = lookup_join(tf, self.vocabulary.grams.select("gram", "index", "df"), ["gram"], weight="df")
        return place_vectors(rows, sparse_rows(known, self.id, "tf", self.size), self.id, self.label, self.names, F.col("folds"))

    def set_of(self, trial: _Trial) -> int:
        return self.sets.index(trial.kept)

    def frequencies(self, kept: frozenset) -> DataFrame:
        own = self.grams.filter(F.col(self.label).isin(sorted(kept)))
        return own.groupBy("gram").agg(F.sum("df").alias("df"))

    def weights(self, trial: _Trial) -> np.ndarray:
        """Read from arrays of the superset's size, whose bytes are checked before."""
        if "grams" not in self._read:
            whole = F.col("gram").startswith(" ") & F.col("gram").endswith(" ") & (F.length("gram") > 2)
            table = self.vocabulary.grams.select("index", F.length("gram").alias("n"), whole.alias("whole")).toArrow()
            self._read["grams"] = [table.column(c).to_numpy() for c in ("index", "n", "whole")]
        if trial.kept not in self._read:
            found = lookup_join(self.frequencies(trial.kept), self.vocabulary.grams.select("gram", "index"), ["gram"])
            table = found.select("index", "df").toArrow()
            counts = np.zeros(self.size, np.int64)
            counts[table.column("index").to_numpy()] = table.column("df").to_numpy()
            self._read[trial.kept] = counts
        index, length, whole = self._read["grams"]
        p = trial.params
        allowed = ((length >= p.ngram_min) & (length <= p.ngram_max)) | ((length < p.ngram_min) & whole)
        n = sum(self.n.get(c, 0) for c in trial.kept)
        return weights_of(index.astype(np.int64), self._read[trial.kept][index], allowed, n, p, self.size)

    def model(self, trial: _Trial) -> TextModel:
        p, n = trial.params, sum(self.n.get(c, 0) for c in trial.kept)
        own = grams_in_range(self.frequencies(trial.kept), p.ngram_min, p.ngram_max)
        kept = inverse_document_frequency(prune_vocabulary(own, n, p.min_df, p.max_df), n)
        numbered_ = lookup_join(kept, self.vocabulary.grams.select("gram", "index"), ["gram"])
        return TextModel(
            Vocabulary(written(numbered_, "vocabulary"), n, p.ngram_min, p.ngram_max), self.size, trial.forests[0], self.names
        )


def run_trials(
    df: DataFrame, trials: DataFrame, defaults: Params, folds: int | None = None, policy: Bandit | None = None,
    parallelism: int | None = None, id: str = "row_id", text: str = "tweet", label: str = "target",
    limit: int = BROADCAST_BYTES,
) -> Search:
    """Fits and measures every trial, over `folds` stratified folds or, without folds, on a held-out fifth.

    The text is cut and joined once, for all trials: rows become counts over one superset vocabulary, a trial is a mask
    and weights on it, and the trees of all trials and folds grow in the same rounds. More trials than `parallelism`, or
    whose weights together exceed `limit` bytes, grow in batches; a single trial's weights beyond it are an error. Classes are counted before
    rows without text are left out. A trial that leaves no class, no vocabulary or no test row has no score, and a
    `reason`. With a policy, weak trials are stopped; they keep the scores of their last report.
    """
    spark = df.sparkSession
    labelled = df.select(id, text, label)
    class_sizes = {str(r[0]): r[1] for r in labelled.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*")).collect()}
    found = {}
    for row in trials.collect():
        params = defaults.with_trial(row.asDict())
        kept = frozenset(c for c, n in class_sizes.items() if n >= params.min_class_frequency)
        reason = None if 1 <= params.ngram_min <= params.ngram_max else "the range of n-grams is empty"
        found[row["trial_id"]] = _Trial(params, kept, reason=reason if kept else "no class is left")
    able = {i: t for i, t in found.items() if t.reason is None}
    reports: list[tuple] = []
    shared = None
    if able:
        shared = _Shared(labelled, able, sorted(class_sizes), folds, id, text, label)
        if shared.size * 8 > limit:
            raise ValueError(f"{shared.size} grams are too many for a search; raise min_df or the limit")
        for trial in able.values():
            trial.weights = shared.weights(trial)
            if not trial.weights.any():
                trial.reason = "no vocabulary is left"
        vectors = shared.vectors(defaults)
        step = max(1, min(limit // (shared.size * 8), parallelism or len(able)))
        live = [i for i, t in able.items() if t.reason is None]
        n_reports = policy.reports if policy else 1
        for report in range(1, n_reports + 1):
            for first in range(0, len(live), step):
                _grow_and_score(vectors, shared, {i: able[i] for i in live[first : first + step]}, report / n_reports)
            reports += [(i, report, able[i].scores["accuracy"]) for i in live if able[i].scores]
            if policy and report < n_reports and report % policy.interval == 0 and reports:
                table = spark.createDataFrame(reports, "run_id bigint, step bigint, metric double")
                surviving = {r["run_id"] for r in surviving_runs(table, policy.interval, policy.slack).collect()}
                for i in live:
                    able[i].stopped = i not in surviving
                live = [i for i in live if i in surviving]
    rows = []
    for i, t in found.items():
        s = t.scores or {}
        n_classes = len([c for c in t.kept if shared.n.get(c)]) if shared else 0
        missing = None if t.scores else t.reason or "no test row is left"
        rows.append((i, *(s.get(c) for c in SCORES), n_classes, t.grown, t.stopped, missing))
    schema = f"trial_id bigint, {', '.join(f'{c} double' for c in SCORES)}, n_classes bigint, trees int, stopped boolean, reason string"
    results = trials.join(F.broadcast(spark.createDataFrame(rows, schema)), "trial_id")

    def model_of(trial_id: int) -> TextModel:
        if folds:
            raise ValueError("a trial measured over folds has no single model")
        return shared.model(found[trial_id])

    return Search(results, spark.createDataFrame(reports, "run_id bigint, step bigint, metric double"), model_of)


def _grow_and_score(vectors: DataFrame, shared: _Shared, trials: dict[int, _Trial], share: float) -> None:
    """Grows each trial's forests up to a share of its trees and measures them."""
    held_out = range(shared.folds) if shared.folds else [1]
    plans, upto = [], {}
    for i, t in trials.items():
        upto[i] = math.ceil(t.params.n_estimators * share)
        for f in held_out:
            own = plan(t.params, shared.size, weights=t.weights, split=len(shared.sets) + shared.set_of(t), fold=f)
            plans.append(replace(own, trees=upto[i] - t.grown, first=t.grown))
    every = sum(shared.n.values())
    rows = max(1, min(every, 2 * max(t.params.fit_rows or every for t in trials.values())))
    owner = [i for i in trials for _ in held_out]
    n_classes = len(shared.names)
    counts = np.zeros((len(plans), n_classes, n_classes))

    def measure(run: list[int], forests: list) -> None:
        tried = [replace(plans[p], split=shared.set_of(trials[owner[p]])) for p in run]
        for row in forest.confusions(vectors, tried, forests).collect():
            counts[run[row["plan"]], row["label"], row["predicted"]] = row["n"]

    if shared.folds and share == 1 and not any(t.forests for t in trials.values()):
        for run in forest.fold_runs(plans, every):  # no forest is read again
            measure(run, forest.grow(vectors, [plans[p] for p in run], n_classes, rows))
    else:
        grown = iter(forest.grow(vectors, plans, n_classes, rows))
        for t in trials.values():
            new = [next(grown) for _ in held_out]
            t.forests = [forest.joined([a, b]) for a, b in zip(t.forests, new, strict=True)] if t.forests else new
        measure(list(range(len(plans))), [f for t in trials.values() for f in t.forests])
    for i, t in trials.items():
        t.grown = upto[i]
        own = [c for c, j in zip(counts, owner, strict=True) if j == i and c.sum()]
        if own:
            parts = [scores_of(c) for c in own]
            t.scores = {k: sum(p[k] for p in parts) / len(parts) for k in SCORES}


def evaluate_trials(
    df: DataFrame, trials: DataFrame, defaults: Params, folds: int | None = None, policy: Bandit | None = None,
    id: str = "row_id", text: str = "tweet", label: str = "target",
) -> DataFrame:
    """The trials with their scores, the trees they were grown to, whether they were stopped, and why one has no score."""
    return run_trials(df, trials, defaults, folds, policy, None, id, text, label).results


def trial_metrics(results: DataFrame) -> DataFrame:
    """All metrics of evaluated trials as rows (run_id, step, name, value); columns that results lack are left out."""
    named = {name: c for name, c in METRIC_NAMES.items() if c in results.columns}
    values = results.filter("accuracy is not null").select(
        F.concat(F.lit("trial-"), F.col("trial_id")).alias("run_id"), F.lit(0).cast("bigint").alias("step"),
        *[F.col(c).cast("double").alias(name) for name, c in named.items()],
    )
    return values.unpivot(["run_id", "step"], list(named), "name", "value")


def _kernel(x: Column, value: Column, width: Column) -> Column:
    """A triangle of area 1 around a value, mirrored at the ends of the range."""
    one = lambda v: F.greatest(F.lit(0.0), 1.0 - F.abs(x - v) / width)
    return (one(value) + one(2 * F.col("low") - value) + one(2 * F.col("high") - value)) / width


def suggest_trials(
    history: DataFrame, trials: DataFrame, space: dict, metric: str = "accuracy", id: str = "trial_id", seed: int = 42,
    candidates: int = 24, gamma: float = 0.25,
) -> DataFrame:
    """Settings for new trials from those already measured, by a tree-structured Parzen estimator.

    The best ceil(gamma * n) of n measured trials, at most 25, are the good ones. Per parameter, the density of the good
    and of all other values is an even prior over the parameter's range, which counts as one value, and a triangle
    around every value, mirrored at the range's ends; it reaches the range's hundredth to each side, or more where there
    are fewer than 99 values: the range by their number and the prior.
    Candidates are drawn from the good density; the one with the highest ratio of good to other density is taken, of
    equal ones the first drawn. Values without a metric do not count; without any, the prior decides.
    """
    named = {PARAMETER_NAMES.get(n, n): bounds for n, bounds in space.items()}
    known = history.filter(F.col(metric).isNotNull() & ~F.isnan(F.col(metric).cast("double")))
    known = written(known.select(id, F.col(metric).alias("_metric"), *named), "history")
    n_good = min(25, math.ceil(gamma * known.count()))
    good = known.orderBy(F.desc("_metric"), F.asc(id)).limit(n_good).select(id, F.lit(True).alias("good"))
    marked = known.join(F.broadcast(good), id, "left").withColumn("good", F.coalesce("good", F.lit(False)))
    middle = lambda name, kind: F.col(name).cast("double") + (0.5 if kind == "int" else 0.0)
    values = [F.struct(F.lit(n).alias("param"), middle(n, kind).alias("value")) for n, (kind, _, _) in named.items()]
    seen = written(marked.select("good", F.explode(F.array(*values)).alias("v")).select("good", "v.*"), "values")
    bounds = [
        F.struct(F.lit(n).alias("param"), F.lit(kind == "int").alias("whole"), F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high"))
        for n, (kind, low, high) in named.items()
    ]
    total = seen.groupBy("param").agg(
        F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_other"),
        F.sort_array(F.collect_list(F.when(F.col("good"), F.col("value")))).alias("goods"),  # 25 at most
    )
    asked = trials.select(F.col(id).alias("_id"), F.explode(F.array(*bounds)).alias("b")).select("_id", "b.*").join(F.broadcast(total), "param", "left")
    asked = asked.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_good", "n_other")})
    width = lambda n: (F.col("high") - F.col("low")) / F.least(1.0 + F.col(n), F.lit(100.0))
    drawn = asked.withColumn("candidate", F.explode(F.sequence(F.lit(0), F.lit(candidates - 1))))
    name = F.concat_ws(":", F.col("_id").cast("string"), F.col("candidate").cast("string"), F.col("param"))
    part = lambda what: _draw(name, what, seed) / F.lit(2.0**32)
    place = F.floor(part("value") * (F.col("n_good") + 1)).cast("int")
    around = F.get("goods", place - 1) + width("n_good") * (part("left") + part("right") - 1.0)
    even = F.col("low") + part("left") * (F.col("high") - F.col("low"))
    x = F.when(place > 0, around).otherwise(even)
    mirrored = F.when(x < F.col("low"), 2 * F.col("low") - x).when(x > F.col("high"), 2 * F.col("high") - x).otherwise(x)
    inside = F.least(mirrored, F.col("high") - F.when(F.col("whole"), 0.5).otherwise(0.0))
    drawn = drawn.withColumn("x", F.when(F.col("whole"), F.floor(inside) + 0.5).otherwise(inside)).drop("goods")
    near = drawn.join(seen, "param", "left")
    prior = 1.0 / (F.col("high") - F.col("low"))
    height = lambda own, n: F.coalesce(F.sum(F.when(own, _kernel(F.col("x"), F.col("value"), width(n)))), F.lit(0.0))
    keys = ["_id", "param", "candidate", "x", "low", "high", "n_good", "n_other"]
    dense = near.groupBy(*keys).agg(height(F.col("good"), "n_good").alias("l"), height(~F.col("good"), "n_other").alias("g"))
    ratio = ((F.col("l") + prior) / (F.col("n_good") + 1)) / ((F.col("g") + prior) / (F.col("n_other") + 1))
    best = dense.groupBy("_id", "param").agg(F.max_by("x", F.struct(F.round(ratio, 9), -F.col("candidate"))).alias("x"))
    picked = {}
    for n, (kind, _, _) in named.items():
        value = F.max(F.when(F.col("param") == n, F.col("x")))
        picked[n] = (F.floor(value).cast("int") if kind == "int" else value).alias(n)
    return trials.join(best.groupBy("_id").agg(*picked.values()), F.col(id) == F.col("_id")).drop("_id")
