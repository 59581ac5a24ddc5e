"""Forests on sparse rows: splits, drawing, tables of nodes, scoring; searches on them."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gramline.operators import forest, model, search
from gramline.plans.storage import written

SIZE, CLASSES = 300, 3


def _rows(n=160, seed=1):
    rng = np.random.default_rng(seed)
    for i in range(n):
        label = int(rng.integers(0, CLASSES))
        positions = np.unique(np.r_[rng.integers(0, SIZE, 20), (label * 80 + rng.integers(0, 30, 6)) % SIZE])
        values = rng.random(len(positions)) + 0.05
        values /= np.sqrt((values**2).sum())
        yield i * 7919, label, [i % 4], positions.tolist(), values.tolist()


@pytest.fixture(scope="module")
def vectors(spark):
    return written(spark.createDataFrame(list(_rows()), forest.VECTORS).repartition(4), "forest-rows")


@pytest.fixture(scope="module")
def plan():
    return forest.Plan(4, 42, SIZE, fold=0)


@pytest.fixture(scope="module")
def grown(vectors, plan):
    return forest.grow(vectors, [plan], CLASSES, 160)[0]


def _best(rows, weights, labels, bins, features):
    """The best (gain, -feature, -bin) over all features by looking at every threshold."""
    best = None
    for f in features:
        for b in sorted({bins[r][f] for r in rows if f in bins[r]}):
            right = [r for r in rows if bins[r].get(f, 10**9) <= b]
            sides = [[0] * CLASSES, [0] * CLASSES]
            for r in rows:
                sides[r in set(right)][labels[r]] += weights[r]
            if all(map(sum, sides)):
                found = (sum(sum(x * x for x in s) / sum(s) for s in sides), -f, -b)
                best = found if best is None or found > best else best
    return best


def test_splits_are_the_best_of_what_a_node_has_drawn(grown, plan):
    """Every split of every tree, found again by a plain search over the node's own window."""
    table = list(_rows())
    bins = [dict(zip(p, forest.bins_of(np.array(v)).tolist())) for _, _, _, p, v in table]
    labels = [r[1] for r in table]
    keys = np.array([r[0] for r in table])
    nodes, checked = grown.nodes, 0
    for tree in range(plan.trees):
        own = np.flatnonzero(nodes.tree == tree)
        draw = forest._hashed(np.array([tree])[:, None], keys[None, :], plan.seed)[0]
        times = np.searchsorted(forest._POISSON, (draw >> np.uint64(11)).astype(float) * 2.0**-53)
        at = {int(own[0]): [r for r in range(len(table)) if times[r] and table[r][2][0] != plan.fold]}
        for node in own:
            rows = at[int(node)]
            if nodes.left[node] < 0:
                held = slice(grown.first[node], grown.first[node + 1])
                counts = np.bincount([labels[r] for r in rows], [times[r] for r in rows], CLASSES)
                assert dict(zip(grown.classes[held], grown.weights[held])) == {c: n for c, n in enumerate(counts) if n}
                continue
            start = int(forest._hashed(nodes.hash[node], plan.window) % np.uint64(SIZE))
            chosen = (int(nodes.position[node]), int(nodes.bin[node]))
            if (chosen[0] - start) % SIZE < plan.window:
                window = [(start + d) % SIZE for d in range(plan.window)]
                gain, f, b = _best(rows, times, labels, [{(p - start) % SIZE: v for p, v in r.items()} for r in bins], range(plan.window))
                assert ((start - f) % SIZE, -b) == chosen and chosen[0] in window
                checked += 1
            children = [int(own[0] + nodes.left[node]) + s for s in (0, 1)]
            goes_right = lambda r: bins[r].get(chosen[0], 10**9) <= chosen[1]  # noqa: B023, E731
            at[children[0]], at[children[1]] = [r for r in rows if not goes_right(r)], [r for r in rows if goes_right(r)]
            assert all(at[c] for c in children)
    assert checked > 20


def test_same_rows_and_seed_give_the_same_trees(spark, vectors, plan, grown, monkeypatch):
    monkeypatch.setattr(forest, "NODES", 400)  # trees in several groups
    monkeypatch.setattr(forest, "SLICE", 100)
    monkeypatch.setattr(forest, "PAIRS", 50)
    again = forest.grow(vectors.repartition(7), [forest.Plan(1, 9, SIZE), plan], CLASSES, 160)[1]
    for name in ("tree", "position", "bin", "left"):
        assert (getattr(again.nodes, name) == getattr(grown.nodes, name)).all()
    assert (again.first == grown.first).all() and (again.weights == grown.weights).all()


def test_trees_grown_in_tasks_are_those_grown_by_rounds(spark, vectors, monkeypatch):
    """Weighted, held-out, deep and continued plans, in one part or several; windows that find nothing widen."""
    some = np.where(np.arange(SIZE) % 3 == 0, 0.0, 1.0 + np.arange(SIZE) % 5)
    plans = [
        forest.Plan(9, 3, SIZE, fold=0), forest.Plan(2, 1, SIZE, depth=3, weights=some), forest.Plan(1, 5, SIZE, min_split=9, first=4),
        forest.Plan(0, 5, SIZE), forest.Plan(2, 5, SIZE, fold=1, weights=np.eye(1, SIZE, 3)[0]),
    ]
    in_tasks = forest.grow(vectors, plans, CLASSES, 160)
    monkeypatch.setattr(forest, "SAMPLE", 0)
    by_rounds = forest.grow(vectors, plans, CLASSES, 160)
    for a, b in zip(in_tasks, by_rounds, strict=True):
        for c in ("tree", "hash", "depth", "start", "position", "bin", "left"):
            assert (getattr(a.nodes, c) == getattr(b.nodes, c)).all()
        assert all((getattr(a, c) == getattr(b, c)).all() for c in ("first", "classes", "weights"))


def test_a_node_reaches_its_task_as_one_row_per_code(spark, monkeypatch):
    """However many rows report it; nodes that go on over many batches come out whole."""
    codes = [(int(forest.class_code(k)), 40) for k in range(2)] + [(forest.entry_code(d, d % 2, 5, 0), 9 + d) for d in range(30)]
    reports = [(node, code, 1, 1) for node in range(3) for code, n in codes for _ in range(n)]
    table = spark.createDataFrame(reports, forest.OPEN)
    found, chosen = sorted(map(tuple, forest.best_splits(table).collect())), forest._chosen

    def small(batches):
        for batch in batches:
            assert batch.num_rows <= 3 * len(codes)
            yield from (batch.slice(i, 7) for i in range(0, batch.num_rows, 7))

    monkeypatch.setattr(forest, "_chosen", lambda batches: chosen(small(batches)))
    assert sorted(map(tuple, forest.best_splits(table.repartition(5)).collect())) == found
    columns = [np.array(c) for c in zip(*[(n, c, w, w) for n in range(3) for c, w in codes], strict=True)]
    assert [r[:3] for r in found] == list(zip(*(c.tolist() for c in forest.choose(*columns)[:3]), strict=True))


def test_a_sample_finds_entries_as_flat_rows_do():
    rng = np.random.default_rng(7)
    counts = np.array([0, 5, 1, 0, 30, 17, 0])
    positions = np.concatenate([np.sort(rng.choice(SIZE, n, replace=False)) for n in counts])
    plan, n = forest.Plan(1, 1, SIZE), len(counts)
    values, fold = rng.uniform(0.1, 1, len(positions)), np.zeros((n, 1), np.int64)
    flat = forest.Rows(plan, np.arange(n), np.zeros(n), fold, counts, positions, values)
    held = forest.Sample(plan, np.arange(n), np.zeros(n), counts, positions.astype(np.int32), flat.bins.astype(np.int16))
    row, wanted = np.divmod(np.arange(n * (SIZE + 1)), SIZE + 1)
    assert (flat.seek(row, wanted) == held.seek(row, wanted)).all()


def test_instalments_are_the_whole_forest(vectors, plan, grown):
    first = forest.grow(vectors, [forest.Plan(3, 42, SIZE, fold=0)], CLASSES, 160)[0]
    rest = forest.grow(vectors, [forest.Plan(1, 42, SIZE, fold=0, first=3)], CLASSES, 160)[0]
    both = forest.joined([first, rest])
    assert (both.nodes.position == grown.nodes.position).all() and (both.weights == grown.weights).all()


def test_limits(vectors):
    deep, few = forest.Plan(2, 1, SIZE, depth=2), forest.Plan(2, 1, SIZE, min_split=40)
    a, b = forest.grow(vectors, [deep, few], CLASSES, 160)
    assert a.nodes.depth.max() <= 2
    whole = forest.grow(vectors, [forest.Plan(2, 1, SIZE)], CLASSES, 160)[0]
    assert (np.diff(b.first)[b.nodes.left < 0] > 0).all() and len(b.nodes.tree) < len(whole.nodes.tree)


def test_no_rows_and_pure_rows(spark):
    none = written(spark.createDataFrame([], forest.VECTORS), "none")
    (empty,) = forest.grow(none, [forest.Plan(2, 1, SIZE)], CLASSES, 0)
    assert (empty.nodes.left < 0).all() and not len(empty.classes)
    pure = written(spark.createDataFrame([(i, 1, [0], [i], [1.0]) for i in range(9)] + [(10, 1, [0], [], [])], forest.VECTORS), "pure")
    (one,) = forest.grow(pure, [forest.Plan(3, 1, SIZE)], CLASSES, 10)
    assert (one.nodes.left < 0).all() and set(one.classes) == {1}


def test_table_of_nodes(spark, grown):
    back = forest.from_table(forest.node_table(spark, grown).repartition(3), SIZE, CLASSES)
    for name in ("tree", "position", "bin", "left"):
        assert (getattr(back.nodes, name) == getattr(grown.nodes, name)).all()
    assert (back.first == grown.first).all() and (back.classes == grown.classes).all()


TEXTS = [
    (i, f"the {(['cat', 'dog', 'bird', 'zebra'] if i % 2 else ['hammer', 'wrench', 'drill', 'saw'])[i // 2 % 4]} number {i % 7}", "animal" if i % 2 else "tool")
    for i in range(60)
]
SMALL = model.Params(ngram_min=2, ngram_max=3, n_estimators=5, min_df=2, max_df=0.9, max_depth=4, min_class_frequency=5)


@pytest.fixture(scope="module")
def texts(spark):
    return written(spark.createDataFrame(TEXTS, "row_id bigint, tweet string, target string"), "texts")


@pytest.fixture(scope="module")
def fitted(texts):
    return model.fit_text_model(texts, SMALL)


ODD = [(1, "the cat number 3"), (2, ""), (3, None), (4, "qqqq unseen"), (5, "Hammer HAMMER saw"), (6, "zebra " * 2000)]


def test_probabilities_by_sql_on_the_saved_tables(spark, fitted, tmp_path):
    """DuckDB leads the vectors of the saved vocabulary down the saved nodes."""
    fitted.save(str(tmp_path / "m"))
    df = spark.createDataFrame(ODD, "row_id bigint, tweet string")
    weights = model.tfidf_transform(fitted.vocabulary, df, "row_id", "tweet", keep=("index",))
    weights.select("row_id", "index", "tfidf").write.parquet(str(tmp_path / "w"))
    found = duckdb.sql(f"""
        WITH RECURSIVE nodes AS (SELECT * FROM '{tmp_path}/m/nodes/*.parquet'), w AS (SELECT * FROM '{tmp_path}/w/*.parquet'),
        ids(row_id) AS (VALUES {", ".join(f"({i})" for i, _ in ODD)}),
        walk AS (
            SELECT row_id, tree, 0 AS node FROM ids, (SELECT DISTINCT tree FROM nodes)
            UNION ALL
            SELECT k.row_id, k.tree, CASE WHEN coalesce(w.tfidf, 0) > n.threshold THEN n.right ELSE n.left END
            FROM walk k JOIN nodes n ON n.tree = k.tree AND n.node = k.node AND n.left IS NOT NULL
            LEFT JOIN w ON w.row_id = k.row_id AND w.index = n.index
        ),
        leaves AS (SELECT k.row_id, k.tree, unnest(n.classes) AS class, unnest(n.weights) AS weight, list_sum(n.weights) AS total
                   FROM walk k JOIN nodes n ON n.tree = k.tree AND n.node = k.node WHERE n.left IS NULL)
        SELECT row_id, class, sum(weight / total) / 5 FROM leaves GROUP BY row_id, class""").fetchall()
    expected = {(i, fitted.classes[c]): p for i, c, p in found}
    for limit in (model.BROADCAST_BYTES, 0):
        for row in model.predict_proba(fitted, df, limit=limit).collect():
            for name, p in row["scores"].items():
                assert p == pytest.approx(expected.get((row["row_id"], name), 0.0), abs=1e-12)


def test_both_ways_of_scoring_agree(spark, fitted, texts, monkeypatch):
    mapped = model.predict_proba(fitted, texts)
    assert "MapInArrow" in mapped._jdf.queryExecution().toString() and "Exchange" not in mapped._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(forest, "NODES", 20)  # a forest of several parts
    assert len(forest.parts(fitted.forest)) > 1
    key = lambda df: sorted((r["row_id"], *(round(v, 12) for v in r["scores"].values())) for r in df.collect())
    assert key(model.predict_proba(fitted, texts, limit=0)) == key(mapped)


def test_own_columns_stay(spark, fitted):
    own = {c: F.lit("own") for c in ("features", "row_id", "positions", "values", "probability")}
    for row in model.predict(fitted, spark.createDataFrame(ODD[:2], "id bigint, tweet string").withColumns(own)).collect():
        assert all(row[c] == "own" for c in own) and row["predicted"] in fitted.classes


# Searches


def test_shared_vectors_give_each_trial_its_own_vocabulary(spark, texts):
    """A trial's weights on the superset equal the vocabulary fitted for it alone."""
    settings = [("a", 2, 0.9, 2, 3), ("b", 5, 0.3, 3, 4), ("c", 2, 0.5, 3, 3)]
    for _, min_df, max_df, lo, hi in settings:
        params = model.Params(ngram_min=lo, ngram_max=hi, n_estimators=1, min_df=min_df, max_df=max_df, min_class_frequency=1)
        trial = search._Trial(params, frozenset(["animal", "tool"]))
        wide = search._Trial(model.Params(2, 5, 1, 2, 0.9), frozenset(["animal"]))
        shared = search._Shared(texts, {0: trial, 1: wide}, ["animal", "tool"], None, "row_id", "tweet", "target")
        weights = shared.weights(trial)
        alone = model.fit_vocabulary(texts, "tweet", lo, hi, min_df, max_df).grams
        joined = alone.join(shared.vocabulary.grams.select("gram", "index"), "gram", "left").collect()
        expected = np.zeros(shared.size)
        for r in joined:
            expected[r["index"] * forest.stride(shared.size) % shared.size] = r["idf"]
        assert np.allclose(weights, expected, atol=1e-12)


def test_bandit_stops_weak_trials_and_the_best_keeps_its_model(spark, texts):
    trials = spark.createDataFrame([(0, 2, 6), (1, 31, 6), (2, 2, 1), (3, 2, 5)], "trial_id bigint, min_df int, n_estimators int")
    odd = trials.withColumn("max_df", F.when(F.col("trial_id") == 3, 0.0001).otherwise(0.95))
    found = search.run_trials(texts, odd, SMALL, policy=search.Bandit(interval=1, slack=0.0, reports=3))
    rows = {r["trial_id"]: r for r in found.results.collect()}
    assert rows[3]["accuracy"] is None and rows[3]["reason"] and not rows[0]["stopped"] and rows[0]["trees"] == 6
    reports = found.reports.collect()
    for r in rows.values():
        if r["stopped"]:
            assert r["trees"] <= r["n_estimators"] and max(p["step"] for p in reports if p["run_id"] == r["trial_id"]) < 3
    fitted = found.model(0)
    split = search.shuffled_split(texts, "row_id").filter("split = 'test'")
    hits = model.predict(fitted, split).agg(F.avg((F.col("predicted") == F.col("target")).cast("int"))).first()[0]
    assert hits == pytest.approx(rows[0]["accuracy"])
    assert {"precision", "recall", "f1", "n_classes"} <= set(found.results.columns)


def test_suggestions_beat_random_draws(spark):
    """After forty random trials, suggested ones lie much nearer to the best settings than random ones do."""
    space = {"x": ("uniform", 0.0, 1.0), "k": ("int", 0, 50)}
    value = -F.abs(F.col("x") - 0.3) - F.abs(F.col("k") - 40) / 50
    ids = lambda a, b: spark.range(a, b).withColumnRenamed("id", "trial_id")
    random = search.draw_parameters(ids(0, 60), "trial_id", space).withColumn("accuracy", value)
    seen = written(random.filter("trial_id < 40"), "seen")
    found = written(search.suggest_trials(seen, ids(40, 60), space).withColumn("accuracy", value), "found")
    assert found.filter("x < 0 OR x > 1 OR k < 0 OR k >= 50").isEmpty() and found.count() == 20
    mean = lambda df: df.filter("trial_id >= 40").agg(F.avg("accuracy")).first()[0]
    assert mean(found) > mean(random) / 2
    nothing = search.suggest_trials(seen.limit(0), ids(0, 3), space)
    assert nothing.filter("x >= 0 AND x <= 1 AND k >= 0 AND k < 50").count() == 3


def test_scope_deletes_what_was_written_in_it(spark):
    from gramline.plans import storage

    with storage.scope(spark):
        inside, outside = storage.written(spark.range(3), "inside"), storage.kept(spark.range(4), "outside")
        assert inside.count() == 3
    assert outside.count() == 4
    with pytest.raises(Exception, match="not exist|FAILED_READ_FILE|No such file"):
        inside.count()


def test_streams_leave_no_tables(spark, fitted, tmp_path, monkeypatch):
    """Both ways of answering a stream give the batch's answers, and leave nothing but them behind."""
    import os

    from gramline.operators import scoring
    from gramline.plans import storage
    from gramline.streaming import scoring as streaming

    bodies = [f'{{"data": ["{t}"]}}' for _, t, _ in TEXTS[:12]] + ["junk", '{"data": []}']
    for part in range(7):
        spark.createDataFrame([(b,) for b in bodies[2 * part : 2 * part + 2]], "body string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    scratch = os.path.dirname(storage.scratch_path(spark, "x"))
    left = lambda: sorted(os.listdir(scratch)) if os.path.exists(scratch) else []
    before = left()
    answers = {}
    for mapped in (True, False):
        monkeypatch.setattr(streaming, "is_mapped", lambda m: mapped)  # noqa: B023
        if not mapped:
            real = scoring.predict_proba
            monkeypatch.setattr(scoring, "predict_proba", lambda m, d, t: real(m, d, t, limit=0))  # noqa: B023
        arriving = spark.readStream.schema("body string").option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
        out, checkpoint = str(tmp_path / f"out{mapped}"), str(tmp_path / f"cp{mapped}")
        for _ in range(2):  # a restart answers nothing again
            streaming.score_stream(fitted, arriving, out, checkpoint, available_now=True).awaitTermination()
        answers[mapped] = sorted((r["body"], r["response"]) for r in streaming.read_responses(spark, out).collect())
        assert left() == before and len(answers[mapped]) == len(bodies)
    assert [b for b, _ in answers[True]] == [b for b, _ in answers[False]]
    for (_, a), (_, b) in zip(answers[True], answers[False], strict=True):
        import json

        assert json.loads(a) == pytest.approx(json.loads(b))


def test_trees_grown_by_column_are_those_grown_by_rounds(spark, vectors, monkeypatch):
    """Windows that reach behind or widen, rows that nothing tells apart, rows without entries."""
    some = np.where(np.arange(SIZE) % 3 == 0, 0.0, 1.0 + np.arange(SIZE) % 5)
    plans = [
        forest.Plan(9, 3, SIZE, fold=0), forest.Plan(2, 1, SIZE, depth=3, weights=some), forest.Plan(1, 5, SIZE, min_split=9, first=4),
        forest.Plan(0, 5, SIZE), forest.Plan(2, 5, SIZE, fold=1, weights=np.eye(1, SIZE, 3)[0]), forest.Plan(3, 8, SIZE, given_window=1),
    ]
    # Rows that come twice under other labels, and rows that differ in few entries.
    rows = [(k, c, f, p[:2] if i % 7 == 0 else p, v[:2] if i % 7 == 0 else v) for i, (k, c, f, p, v) in enumerate(_rows())]
    twice = [(r[0] + 1, (r[1] + 1) % CLASSES, *r[2:]) for r in rows[:40]]
    odd = written(spark.createDataFrame(rows + twice + [(5, 0, [2], [], [])], forest.VECTORS).repartition(5), "odd")
    same = lambda a, b: all(
        (getattr(a.nodes, c) == getattr(b.nodes, c)).all() for c in ("tree", "hash", "depth", "start", "position", "bin", "left")
    ) and all((getattr(a, c) == getattr(b, c)).all() for c in ("first", "classes", "weights"))
    for table in (vectors, odd):
        with monkeypatch.context() as m:
            m.setattr(forest, "SAMPLE", 0)
            by_rounds = forest.grow(table, plans, CLASSES, 160)
        with monkeypatch.context() as m:
            m.setattr(forest, "FEW", -1)
            assert all(map(same, forest.grow(table, plans, CLASSES, 160), by_rounds))


@pytest.mark.parametrize("classes,wide,small", [(16, False, 32), (1, True, 0), (16, True, None)])
def test_trees_grown_by_column_are_those_grown_by_row(monkeypatch, classes, wide, small):
    """Few classes or many, rows in two bytes or four, with nodes of few rows looking through their rows or not."""
    monkeypatch.setattr(forest, "SMALL", small or 0)
    monkeypatch.setattr(forest, "SAMPLE", 0 if small is None else forest.SAMPLE)
    monkeypatch.setattr(forest, "CLASSES", classes)
    monkeypatch.setattr(forest, "entry_bytes", lambda rows: 6 if wide else 4)
    table = [r if i % 5 else (*r[:3], r[3][:2], r[4][:2]) for i, r in enumerate(_rows())]
    row = np.repeat(np.arange(len(table)), [len(r[3]) for r in table])
    position, values = (np.concatenate([r[i] for r in table]) for i in (3, 4))
    c = forest.Columns(SIZE, *(np.array([r[i] for r in table]) for i in (0, 1, 0)), len(row))
    assert c.row.dtype == (np.int32 if wide else np.uint16)
    c.add(position, row, forest.bins_of(values))
    c.close()
    for plan in (forest.Plan(5, 3, SIZE), forest.Plan(2, 5, SIZE, min_split=9, given_window=2), forest.Plan(2, 5, SIZE, given_window=SIZE)):
        numbers = np.arange(plan.trees)
        a, b = (forest.joined(list(way(c, plan, numbers, CLASSES))) for way in (forest._grown_by_row, forest._grown_by_column))
        assert all((getattr(a.nodes, n) == getattr(b.nodes, n)).all() for n in ("tree", "hash", "depth", "start", "position", "bin", "left"))
        assert all((getattr(a, n) == getattr(b, n)).all() for n in ("first", "classes", "weights"))


def test_a_task_receives_columns_in_any_batches():
    """Runs of positions that go on over batches, and rows without entries."""
    rng = np.random.default_rng(3)
    n, size = 50, 40
    hit = rng.random((n, size)) < 0.3
    hit[4] = False
    bins = rng.integers(0, 30, (n, size))
    rows = []
    for number, (low, high) in enumerate(((0, 20), (20, 50))):
        own = np.arange(low, high)
        rows.append(forest._packed_runs(0, 0, number, np.array([-1]), np.array([0, len(own)]), (own * 3, "i8"), (own % 2, "i4"), (own, "u8")))
        for block in range(size):
            r = np.flatnonzero(hit[low:high, block])
            rows.append(forest._packed_runs(0, 0, number, np.array([block]), np.array([0, len(r)]), (r, "i4"), (r * 0, "u2"), (bins[low:high, block][r], "i2")))
    table = forest.pa.Table.from_batches(rows).sort_by([("block", "ascending"), ("slice", "ascending")]).drop_columns("high").combine_chunks()
    for length in (1, 7, 1000):
        part, c = forest._received(table.to_batches(length), lambda p: (size, int(hit.sum())))
        assert part == 0 and (c.key == np.arange(n) * 3).all() and c.filled == hit.sum()
        for at in range(size):
            own = slice(c.start[at], c.start[at + 1])
            assert sorted(zip(c.bins[own].tolist(), c.row[own].tolist())) == sorted((int(bins[r, at]), int(r)) for r in np.flatnonzero(hit[:, at]))
            assert (np.diff(c.bins[own]) >= 0).all()
