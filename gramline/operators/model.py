"""Random forests on n-gram TF-IDF, from raw text to class probabilities.

A model is a written vocabulary table, a table of nodes and the class names. Grams are numbered where they lie, and rows
are fitted and scored as sparse vectors: no table of rows x vocabulary exists. The vocabulary and its weights are fitted
on all rows, and so is the forest unless `Params.fit_rows` is given: that bounds the labelled rows it sees, drawn per
class by hash.

Scoring is one pass without a shuffle or a written table where vocabulary and forest are small enough to be broadcast,
which is measured; beyond that, rows find their grams by a join, and a larger forest goes to the tasks part by part.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramline.functions import words
from gramline.operators import forest
from gramline.operators.features import Vocabulary, fit_vocabulary, fold_vocabularies, tfidf_transform
from gramline.operators.relational import filter_min_class_frequency
from gramline.operators.splits import stratified_kfold, stratified_split
from gramline.plans.lookup import BROADCAST_BYTES
from gramline.plans.storage import written

MAX_TREE_DEPTH = forest.MAX_TREE_DEPTH
_GRAM_BYTES = 20  # of a broadcast vocabulary: hash, place, weight


@dataclass(frozen=True)
class Params:
    """Settings of one fit. `max_depth` None means as deep as possible, `fit_rows` None that the forest sees all rows and not
    at most about so many."""

    ngram_min: int
    ngram_max: int
    n_estimators: int
    min_df: int = 5
    max_df: float = 0.6
    min_class_frequency: int = 50
    max_depth: int | None = None
    min_samples_split: int = 2
    seed: int = 42
    fit_rows: int | None = None

    def with_trial(self, trial: dict) -> Params:
        return replace(self, **{k: v for k, v in trial.items() if k in self.__dataclass_fields__})


# The settings of the two flows.
FLOW_A = Params(ngram_min=3, ngram_max=7, n_estimators=100)
FLOW_B = Params(ngram_min=4, ngram_max=7, n_estimators=90)


FIT_ROWS_PER_TASK = 2_000
_VECTOR = T.StructType([T.StructField("v", VectorUDT())])


@dataclass(frozen=True)
class TextModel:
    """A fitted model: vocabulary with an `index` per gram, its size, the forest, and the class of every label number."""

    vocabulary: Vocabulary
    size: int
    forest: forest.Forest
    classes: list[str]

    def save(self, path: str) -> None:
        """Replaces what is at `path`."""
        grams, v = self.vocabulary.grams, self.vocabulary
        grams.write.mode("overwrite").parquet(f"{path}/vocabulary")
        forest.node_table(grams.sparkSession, self.forest).write.mode("overwrite").parquet(f"{path}/nodes")
        about = [(v.n, v.lo, v.hi, self.size, self.classes)]
        shape = "n bigint, lo int, hi int, size bigint, classes array<string>"
        grams.sparkSession.createDataFrame(about, shape).coalesce(1).write.mode("overwrite").parquet(f"{path}/about")

    @staticmethod
    def load(path: str) -> TextModel:
        spark = SparkSession.active()
        about = spark.read.parquet(f"{path}/about").first()
        vocabulary = Vocabulary(spark.read.parquet(f"{path}/vocabulary"), about["n"], about["lo"], about["hi"])
        nodes = spark.read.parquet(f"{path}/nodes")
        return TextModel(vocabulary, about["size"], forest.from_table(nodes, about["size"], len(about["classes"])), about["classes"])

    def nodes(self) -> DataFrame:
        """The forest as a table; `index` is a gram's place in the vocabulary."""
        return forest.node_table(self.vocabulary.grams.sparkSession, self.forest)


def numbered(vocabulary: Vocabulary) -> tuple[Vocabulary, int]:
    """The vocabulary with `index`, each gram's place in ascending order, and its size. Nothing is sorted as a whole:
    ranges of grams are numbered on their own, and the sizes of the ranges, one row each, give where they start."""
    place = F.monotonically_increasing_id()
    ranges = vocabulary.grams.repartitionByRange("gram").sortWithinPartitions("gram").withColumn("_place", place)
    ranges = written(
        ranges.withColumn("_range", F.shiftright("_place", 33)).withColumn("_place", F.col("_place") % (1 << 33)), "ranges"
    )
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    grams = ranges.join(F.broadcast(starts), "_range").withColumn("index", (F.col("_start") + F.col("_place")).cast("int"))
    grams = written(grams.drop("_range", "_place", "_start"), "vocabulary")
    size = grams.count()
    if not size:
        raise ValueError("the vocabulary has no grams: change min_df or max_df")
    return Vocabulary(grams, vocabulary.n, vocabulary.lo, vocabulary.hi), size


def _vector(size: int, indices: Column, values: Column) -> Column:
    """A sparse vector of two arrays. JSON is how SQL makes one without Python; numbers keep all their digits."""
    parts = F.struct(F.lit(0).alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values"))
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), _VECTOR)["v"]


def shuffled(vectors: DataFrame) -> DataFrame:
    """Vectors for a join by a shuffle. Spark's estimate of their size follows the text's compressed size, and may have
    hundreds of megabytes collected on the driver and broadcast."""
    return vectors.hint("merge")


def features_of(vocabulary: Vocabulary, size: int, df: DataFrame, id: str, text: str) -> DataFrame:
    """(id, features) of the rows that have known grams: their TF-IDF as sparse vectors over a numbered vocabulary."""
    weights = tfidf_transform(vocabulary, df.select(id, text), id, text, keep=("index",))
    entries = weights.groupBy(id).agg(F.sort_array(F.collect_list(F.struct("index", "tfidf"))).alias("_entries"))
    return entries.select(id, _vector(size, F.col("_entries.index"), F.col("_entries.tfidf")).alias("features"))


def with_features(vocabulary: Vocabulary, size: int, df: DataFrame, id: str, text: str) -> DataFrame:
    """`df` with `features`; a row without known grams, or without text, has an empty vector. Ids are unique."""
    none = F.array().cast("array<int>"), F.array().cast("array<double>")
    found = df.join(shuffled(features_of(vocabulary, size, df, id, text)), id, "left")
    return found.withColumn("features", F.coalesce("features", _vector(size, *none)))


def plan(params: Params, size: int, **given) -> forest.Plan:
    depth = min(params.max_depth or MAX_TREE_DEPTH, MAX_TREE_DEPTH)
    return forest.Plan(params.n_estimators, params.seed, size, depth, params.min_samples_split, **given)


def fit_sample(train: DataFrame, params: Params, id: str, text: str, label: str) -> DataFrame:
    """The labelled rows. With `fit_rows` at most about so many, every class in its share, the same ones on any cluster."""
    rows = train.filter(F.col(label).isNotNull()).select(id, text, label)
    n = rows.count() if params.fit_rows else 0
    if not params.fit_rows or n <= params.fit_rows:
        return rows
    drawn = stratified_split(rows, label, id, params.fit_rows / n, params.seed)
    return drawn.filter("split = 'train'").drop("split")


def class_names(rows: DataFrame, label: str) -> list[str]:
    """The classes in ascending order; their number is taken to be small, as a class map per scored row is."""
    return [r[0] for r in rows.select(F.col(label).cast("string")).distinct().orderBy(label).collect()]


def class_number(label: str, names: list[str]) -> Column:
    return (F.array_position(F.array(*[F.lit(c) for c in names]), F.col(label).cast("string")) - 1).cast("int")


def sparse_rows(weights: DataFrame, id: str, value: str, size: int) -> DataFrame:
    """(id, positions, values) of a table (id, index, value), positions ascending."""
    entry = F.struct(forest.position(F.col("index"), size).alias("p"), F.col(value).cast("double").alias("v"))
    rows = weights.groupBy(id).agg(F.sort_array(F.collect_list(entry)).alias("_e"))
    return rows.select(id, F.col("_e.p").alias("positions"), F.col("_e.v").alias("values"))


def place_vectors(rows: DataFrame, sparse: DataFrame, id: str, label: str, names: list[str], folds: Column) -> DataFrame:
    """A written table as the forest takes it, of rows with an id, a label and what `folds` needs; rows without a gram
    have no entries."""
    none = F.array().cast("array<int>"), F.array().cast("array<double>")
    found = rows.join(shuffled(sparse), id, "left").select(
        F.xxhash64(F.col(id)).alias("key"), class_number(label, names).alias("label"), folds.alias("folds"),
        F.coalesce("positions", none[0]).alias("positions"), F.coalesce("values", none[1]).alias("values"),
    )
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // FIT_ROWS_PER_TASK))
    return written(found.repartition(tasks, "key"), "vectors")


def vectorise(
    vocabulary: Vocabulary, size: int, df: DataFrame, id: str, text: str, label: str, fold: Column | None = None
) -> tuple[DataFrame, list[str]]:
    """The labelled rows as the forest takes them, and the class names. Label numbers follow the names in ascending
    order. `fold` numbers what may be held out, below 0 for rows that have no part."""
    fold = F.lit(0) if fold is None else fold
    rows = written(df.filter(F.col(label).isNotNull()).select(id, text, label, fold.cast("int").alias("_fold")), "fit-rows")
    weights = tfidf_transform(vocabulary, rows.select(id, text), id, text, keep=("index",))
    names = class_names(rows, label)
    return place_vectors(rows, sparse_rows(weights, id, "tfidf", size), id, label, names, F.array("_fold")), names


def fit_text_model(
    train: DataFrame, params: Params, id: str = "row_id", text: str = "tweet", label: str = "target", scope=None
) -> TextModel:
    """Fits vocabulary and forest and returns them as one model.

    The vocabulary is fitted on `scope`, by default the training rows; give all rows to let it see the test rows too.
    """
    vocabulary = fit_vocabulary(
        train if scope is None else scope, text, params.ngram_min, params.ngram_max, params.min_df, params.max_df
    )
    return fit_on_vocabulary(vocabulary, train, params, id, text, label)


def fit_on_vocabulary(
    vocabulary: Vocabulary, train: DataFrame, params: Params, id: str = "row_id", text: str = "tweet",
    label: str = "target",
) -> TextModel:
    vocabulary, size = numbered(vocabulary)
    vectors, names = vectorise(vocabulary, size, fit_sample(train, params, id, text, label), id, text, label)
    (grown,) = forest.grow(vectors, [plan(params, size)], len(names), vectors.count())
    return TextModel(vocabulary, size, grown, names)


def classes(model: TextModel) -> list[str]:
    return model.classes


def broadcast_vocabulary(model: TextModel, limit: int = BROADCAST_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(hashes ascending, their positions, weights by position), or None if that is more than `limit` bytes or two grams
    share a hash. A gram that is not in the vocabulary is taken for one that is with a chance of its size by 2^64."""
    if model.size * _GRAM_BYTES > limit:
        return None
    place = forest.position(F.col("index"), model.size)
    table = model.vocabulary.grams.select(F.xxhash64("gram").alias("hash"), place.alias("position"), "idf").toArrow()
    hash, position, idf = (table.column(c).to_numpy() for c in ("hash", "position", "idf"))
    order = np.argsort(hash)
    if (np.diff(hash[order]) == 0).any():
        return None
    weights = np.zeros(model.size)
    weights[position] = idf
    return hash[order], position[order].astype(np.int64), weights


def is_mapped(model: TextModel, limit: int = BROADCAST_BYTES) -> bool:
    """Whether rows are scored in one pass over their texts."""
    return model.size * _GRAM_BYTES <= limit and len(model.forest.nodes.tree) <= forest.NODES


def _with_probability(df: DataFrame, run, *dropped: str) -> DataFrame:
    kept = [f for f in df.schema.fields if f.name not in dropped]
    schema = T.StructType([*kept, T.StructField("_probability", T.ArrayType(T.DoubleType()))])
    names = [f.name for f in kept]

    def scored(batches):
        for batch in batches:
            own = [batch.column(batch.schema.get_field_index(n)) for n in names]
            total = run(batch)
            flat = pa.array(total.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(total) + 1, dtype=np.int32) * total.shape[1]), flat)
            yield pa.RecordBatch.from_arrays([*own, lists], [*names, "_probability"])

    return df.mapInArrow(scored, schema)


def _scored_by_map(model: TextModel, df: DataFrame, text: str, packed: tuple) -> DataFrame:
    """Texts to probabilities in one pass: grams are cut and hashed by Spark, and found, weighed and led down the trees
    batch by batch."""
    v, n_classes, size = model.vocabulary, len(model.classes), model.size
    shared = df.sparkSession.sparkContext.broadcast((packed, forest.parts(model.forest)))
    hashes = F.transform(words.char_wb_ngrams(F.coalesce(text, F.lit("")), v.lo, v.hi), lambda g: F.xxhash64(g))

    def run(batch) -> np.ndarray:
        column = batch.column(batch.schema.get_field_index("_grams"))
        counts = np.diff(column.offsets.to_numpy()).astype(np.int64)
        ends = np.cumsum(counts)
        total, first = [np.zeros((0, n_classes))], 0
        while first < batch.num_rows:  # a run of rows with about a SLICE of grams, or one row
            before = ends[first] - counts[first]
            last = max(first + 1, int(np.searchsorted(ends, before + forest.SLICE, "right")))
            total.append(of(column.slice(first, last - first), counts[first:last]))
            first = last
        return np.concatenate(total)

    def of(column: pa.Array, counts: np.ndarray) -> np.ndarray:
        (known, position, weights), parts = shared.value
        n = len(counts)
        row, hash = np.repeat(np.arange(n), counts), column.flatten().to_numpy(zero_copy_only=False)
        found = np.minimum(np.searchsorted(known, hash), max(0, len(known) - 1))
        hit = known[found] == hash if len(known) else np.zeros(len(hash), bool)
        code, tf = np.unique(row[hit] * size + position[found[hit]], return_counts=True)
        counts = np.bincount(code // size, minlength=n)
        none = np.zeros((n, 1), np.int64)
        own = forest.Plan(0, 0, size, weights=weights)
        rows = forest.Rows(own, none[:, 0], none[:, 0], none, counts, code % size, tf.astype(np.float64))
        every = np.arange(n)
        total = sum((forest.class_weights(f, nodes, 0, rows, every) for f, nodes in parts), np.zeros((n, n_classes)))
        return forest.normalised(total)

    return _with_probability(df.withColumn("_grams", hashes), run, "_grams")


def _scored_by_join(model: TextModel, df: DataFrame, text: str) -> DataFrame:
    """Rows are numbered and written, so that their vectors find them again; parts of the forest follow one another."""
    rows = written(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    weights = tfidf_transform(model.vocabulary, rows.select("_row", text), "_row", text, keep=("index",))
    none = F.array().cast("array<int>"), F.array().cast("array<double>")
    found = rows.join(shuffled(sparse_rows(weights, "_row", "tfidf", model.size)), "_row", "left").drop("_row")
    found = found.withColumns({"positions": F.coalesce("positions", none[0]), "values": F.coalesce("values", none[1])})
    n_classes, own = len(model.classes), forest.Plan(0, 0, model.size)
    found = found.withColumn("_probability", F.array(*[F.lit(0.0)] * n_classes))
    for part in forest.parts(model.forest):
        shared = df.sparkSession.sparkContext.broadcast(part)

        def run(batch, shared=shared) -> np.ndarray:
            f, nodes = shared.value
            lists = [batch.column(batch.schema.get_field_index(c)) for c in ("positions", "values", "_probability")]
            counts = np.diff(lists[0].offsets.to_numpy()).astype(np.int64)
            position, value, before = (c.flatten().to_numpy(zero_copy_only=False) for c in lists)
            none = np.zeros((batch.num_rows, 1), np.int64)
            rows = forest.Rows(own, none[:, 0], none[:, 0], none, counts, position.astype(np.int64), value)
            return before.reshape(-1, n_classes) + forest.class_weights(f, nodes, 0, rows, np.arange(batch.num_rows))

        found = written(_with_probability(found, run, "_probability"), "partly-scored")
    whole = F.aggregate("_probability", F.lit(0.0), lambda a, x: a + x)
    even = F.lit(1.0 / n_classes)
    return found.drop("positions", "values").withColumn("_whole", whole).withColumn(
        "_probability", F.transform("_probability", lambda p: F.when(F.col("_whole") > 0, p / F.col("_whole")).otherwise(even))
    ).drop("_whole")


def _scored(model: TextModel, df: DataFrame, text: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """`df` with `_probability`, in the order of the classes."""
    packed = broadcast_vocabulary(model, limit) if is_mapped(model, limit) else None
    return _scored_by_join(model, df, text) if packed is None else _scored_by_map(model, df, text, packed)


def predict(model: TextModel, df: DataFrame, text: str = "tweet", limit: int = BROADCAST_BYTES) -> DataFrame:
    """Adds `predicted`, the class with the highest mean probability over the trees, of equal ones the first."""
    names = F.array(*[F.lit(c) for c in model.classes])
    best = F.array_position("_probability", F.array_max("_probability")).cast("int") - 1
    return _scored(model, df, text, limit).withColumn("predicted", F.get(names, best)).drop("_probability")


def predict_proba(model: TextModel, df: DataFrame, text: str = "tweet", limit: int = BROADCAST_BYTES) -> DataFrame:
    """Adds `scores`, a map class -> probability."""
    names = F.array(*[F.lit(c) for c in model.classes])
    return _scored(model, df, text, limit).withColumn("scores", F.map_from_arrays(names, F.col("_probability"))).drop("_probability")


def fold_accuracies(
    df: DataFrame, params: Params, vocabulary: Vocabulary | None, k: int = 5, id: str = "row_id", text: str = "tweet",
    label: str = "target",
) -> list[tuple[int, float]]:
    """(fold, accuracy) of a forest fitted on the other folds, null for an empty one. With one vocabulary for all folds,
    vectors are made once; without one, each fold's is that of its other folds. Forests that are large together grow and
    are measured fold by fold, so that the driver holds one of them.

    Every row is tried; each fold's forest is fitted on all others, or with `fit_rows` on at most about so many of them.
    """
    folded = written(stratified_kfold(df.select(id, text, label), label, id, k), "folds")
    others = folded.filter("fold IS NOT NULL").count() * (k - 1) // k
    bounded = params.fit_rows is not None and others > params.fit_rows
    drawn = F.lit(True)
    if bounded:
        folded = stratified_split(folded, label, id, params.fit_rows / others, params.seed)
        drawn = F.col("split") == "train"
    if vocabulary is None:
        lo, hi = params.ngram_min, params.ngram_max
        table = written(fold_vocabularies(folded, text, lo, hi, params.min_df, params.max_df, k), "fold-vocabularies")
        own = [table.filter(F.col("fold") == f) for f in range(k)]
        sizes = [(own[f].agg(F.max("n")).first()[0] or 0) for f in range(k)]
        parts = [(Vocabulary(own[f].select("gram", "df", "idf"), sizes[f], lo, hi), [f]) for f in range(k)]
    else:
        parts = [(vocabulary, list(range(k)))]
    total, hits = np.zeros(k), np.zeros(k)
    for grams, folds in parts:
        grams, size = numbered(grams)
        fit = vectorise(grams, size, folded, id, text, label, F.when(drawn, F.col("fold")).otherwise(-1))
        tried = fit if not bounded else vectorise(grams, size, folded, id, text, label, F.col("fold"))
        (vectors, names), (every, _) = fit, tried
        plans = [plan(params, size, fold=f) for f in folds]
        fitted = params.fit_rows if bounded else others
        for run in forest.fold_runs(plans, fitted):
            own = [plans[i] for i in run]
            forests = forest.grow(vectors, own, len(names), fitted * 2)
            for row in forest.confusions(every, own, forests).collect():
                f = folds[run[row["plan"]]]
                total[f] += row["n"]
                hits[f] += row["n"] * (row["label"] == row["predicted"])
    return [(f, float(hits[f] / total[f]) if total[f] else None) for f in range(k)]


def cross_val_accuracy(
    df: DataFrame, params: Params, k: int = 5, id: str = "row_id", text: str = "tweet", label: str = "target",
    fit_scope: str = "all",
) -> DataFrame:
    """(accuracy): the mean over stratified folds of the rows of frequent classes. The vocabulary is fitted once on all of
    these rows (`fit_scope` "all"), or for each fold on its training rows alone ("train"), which leaks nothing."""
    if fit_scope not in ("all", "train"):
        raise ValueError(f"fit_scope {fit_scope!r} is neither 'all' nor 'train'")
    kept = filter_min_class_frequency(df, label, params.min_class_frequency)
    vocabulary = None
    if fit_scope == "all":
        vocabulary = fit_vocabulary(kept, text, params.ngram_min, params.ngram_max, params.min_df, params.max_df)
    folds = fold_accuracies(kept, params, vocabulary, k, id, text, label)
    return df.sparkSession.createDataFrame(folds, "fold int, accuracy double").agg(F.avg("accuracy").alias("accuracy"))
