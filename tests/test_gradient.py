"""Networks, support vectors and boosting of several classes against direct computation."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from gaugeloom.operators import boosting, gradient, models
from gaugeloom.operators.split import validation_tail


def samples(spark, x, y, parts=4):
    rows = [([float(v) for v in a], [float(b)], i) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "X array<double>, y array<double>, idx int").repartition(parts, "idx")


def packed(df):
    return df.select(array_to_vector("X").alias("features"), F.col("y")[0].alias("label"))


@pytest.mark.parametrize("objective", [gradient.Dense((3, 5, 4, 1)), gradient.Dense((3, 4, 3), 3), gradient.SupportVector(3, 0.3, 0.1), gradient.SupportVector(3, 0.3, 0.1, "rbf", 7)])
def test_gradients_are_those_of_the_losses(objective):
    draw = np.random.default_rng(2)
    x, y = draw.normal(size=(20, 3)), draw.integers(0, 3, 20).astype(float)
    w = objective.start(1) + draw.normal(0, 0.1, objective.size)
    loss, slope = objective.batch(w, x, y)
    assert loss == pytest.approx(objective.losses(w, x, y).sum())
    total = lambda v: objective.batch(v, x, y)[0] + objective.penalty(v)[0]
    slope = slope + objective.penalty(w)[1]
    for i in range(objective.size):
        step = np.zeros(objective.size)
        step[i] = 1e-6
        assert (total(w + step) - total(w - step)) / 2e-6 == pytest.approx(slope[i], abs=1e-4)


def test_a_network_fits_a_curve_that_a_line_cannot(spark):
    draw = np.random.default_rng(0)
    x = draw.uniform(-2, 2, (600, 2))
    y = 30 + 10 * x[:, 0] ** 2 - 5 * np.abs(x[:, 1])
    df = samples(spark, x, y)
    network = models.train(df, "dnn", n_epochs=40)
    line = models.train(df, "linear", n_epochs=40)

    def left(model):
        return models.predict(model, df).agg(F.avg((F.col("predicted") - F.col("y")[0]) ** 2)).first()[0] / y.var()

    assert left(network) < 0.05 < 0.5 < left(line)
    history = models.training_history(spark, network).orderBy("epoch").collect()
    assert [r.epoch for r in history] == list(range(1, len(history) + 1)) and history[0].val_loss is None
    assert history[-1].loss == pytest.approx(left(network) * y.var(), rel=1e-6)
    assert all(a.loss >= b.loss for a, b in zip(history, history[1:]))


def test_a_fit_does_not_depend_on_the_partitions(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(200, 2))
    y = x[:, 0] * x[:, 1]
    fits = [models.train(samples(spark, x, y, n), "dnn", n_epochs=8).weights for n in (1, 7)]
    assert np.allclose(*fits, rtol=1e-6, atol=1e-9)


def test_network_stops_early_and_keeps_the_best(spark, tmp_path):
    """Noise is learned by heart on the first three quarters, so the held-out loss soon rises."""
    draw = np.random.default_rng(4)
    x, y = draw.normal(size=(160, 4)), draw.normal(size=160)
    df = samples(spark, x, y)
    model = models.train(df, "dnn", n_epochs=60, early_stopping=True, patience=4, order=["idx"])
    epochs = [r[0] for r in model.history]
    assert models.FIRST_EPOCHS + 4 < len(epochs) < models.FIRST_EPOCHS + 60
    watched = [r[2] for r in model.history[models.FIRST_EPOCHS :]]
    assert watched.index(min(watched)) == len(watched) - 1 - 4
    held = models.predict(model, df.where("idx >= 120"))
    found = held.agg(F.avg((F.col("predicted") - F.col("y")[0]) ** 2)).first()[0]
    assert found == pytest.approx(min(watched), rel=1e-9)
    models.save_model(spark, model, str(tmp_path / "network"))
    again = models.load_model(spark, str(tmp_path / "network"), models.model_kind(model))
    rows = models.predict(model, df).select("idx", "predicted")
    assert models.predict(again, df).select("idx", "predicted").exceptAll(rows).count() == 0


def test_network_of_classes_stops_early(spark):
    draw = np.random.default_rng(5)
    y = draw.integers(0, 3, 300)
    x = draw.normal(size=(300, 2)) + np.array([[0, 0], [3, 0], [0, 3]])[y]
    df = samples(spark, x, y)
    model = models.train(df, "dnn", True, n_epochs=50, early_stopping=True, patience=3, order=["idx"])
    assert len(model.history) < models.FIRST_EPOCHS + 50
    assert models.predict(model, df).where("predicted = y[0]").count() > 0.85 * 300


def exact_support_vector(x, y, epsilon, ridge):
    """The minimum of the squared loss beyond epsilon, by solving on the rows beyond until these stay the same."""
    z = np.column_stack([x, np.ones(len(x))])
    penalty = ridge * len(x) * np.diag([*[1.0] * x.shape[1], 0.0])
    w = np.linalg.solve(z.T @ z + penalty + 1e-12 * np.eye(z.shape[1]), z.T @ y)
    for _ in range(500):
        away = z @ w - y
        beyond = np.abs(away) > epsilon
        wanted = y[beyond] + epsilon * np.sign(away[beyond])
        new = np.linalg.solve(z[beyond].T @ z[beyond] + penalty, z[beyond].T @ wanted)
        if np.allclose(new, w, atol=1e-13):
            break
        w = w + 0.5 * (new - w)
    return w


def test_support_vectors_equal_an_exact_solver(spark):
    draw = np.random.default_rng(6)
    x = draw.normal(size=(120, 2)) * [1, 10] + [5, 0]
    y = 3 * x[:, 0] - 0.2 * x[:, 1] + draw.standard_t(3, size=120)
    model = models.train(samples(spark, x, y), "svm", n_epochs=200, kernel="linear", epsilon=0.5, cost=0.2)
    scaled, target = (x - x.mean(0)) / x.std(0, ddof=1), (y - y.mean()) / y.std()
    wanted = exact_support_vector(scaled, target, 0.5 / y.std(), 1 / (2 * 0.2 * 120))
    assert np.allclose(model.weights, wanted, atol=1e-5)
    inside = np.abs(models.predict(model, samples(spark, x, y)).toPandas().pipe(lambda t: t.predicted - t.y.str[0])) <= 0.5
    assert 0.1 < inside.mean() < 0.9


def test_support_vectors_of_a_kernel(spark):
    draw = np.random.default_rng(7)
    x = draw.uniform(-3, 3, (500, 1))
    y = np.sin(2 * x[:, 0])
    df = samples(spark, x, y)
    curve = models.train(df, "svm", n_epochs=40, epsilon=0.05, cost=10.0)
    line = models.train(df, "svm", n_epochs=50, kernel="linear")
    error = [models.predict(m, df).agg(F.avg((F.col("predicted") - F.col("y")[0]) ** 2)).first()[0] for m in (curve, line)]
    assert error[0] < 0.02 and error[1] > 0.3
    with pytest.raises(ValueError):
        models.train(df, "svm", kernel="cubic")


def test_trees_are_read_whole(spark):
    draw = np.random.default_rng(8)
    x, y = draw.normal(size=(300, 3)), draw.normal(size=300)
    df = packed(samples(spark, x, y))
    for depth in (0, 1, 5):
        fitted = DecisionTreeRegressor(maxDepth=depth).fit(df)
        tree = boosting.read_tree(fitted.toDebugString)
        rows = fitted.transform(df).collect()
        found = tree.values(np.array([r.features.toArray() for r in rows]))
        assert found.tolist() == [r.prediction for r in rows]


def test_softmax_boosting_stops_and_keeps_the_best(spark, tmp_path):
    draw = np.random.default_rng(9)
    y = draw.integers(0, 3, 240)
    x = draw.normal(size=(240, 2)) + np.array([[0, 0], [1.5, 0], [0, 1.5]])[y]
    df = packed(samples(spark, x, y)).withColumn("validation", F.monotonically_increasing_id() % 4 == 0)
    data = df.cache()
    model = boosting.fit_softmax_boosting(data, 3, 12, first=2, patience=2, keep_best=True, rate=1.0)
    losses = [r[2] for r in model.history]
    assert len(losses) < 12 and len(model.rounds) == losses.index(min(losses[2:])) + 1
    assert len(losses) == len(model.rounds) + 2
    assert all(a[1] > b[1] for a, b in zip(model.history, model.history[1:]))

    rows = data.collect()
    x, y = np.array([r.features.toArray() for r in rows]), np.array([int(r.label) for r in rows])
    held = np.array([r.validation for r in rows])
    margins = np.log(np.bincount(y[~held]) / (~held).sum()) + np.zeros((len(x), 3))
    for step, (_, train_loss, held_loss) in zip(model.rounds, model.history):
        values = np.clip(np.stack([boosting.Tree(**t).values(x) for t in step], 1), -4, 4)
        margins += 2 / 3 * (values - values.mean(1, keepdims=True))
        p = np.exp(margins) / np.exp(margins).sum(1, keepdims=True)
        each = -np.log(p[np.arange(len(y)), y])
        assert each[~held].mean() == pytest.approx(train_loss) and each[held].mean() == pytest.approx(held_loss)
    models.save_model(spark, model, str(tmp_path / "boosting"))
    again = models.load_model(spark, str(tmp_path / "boosting"), models.model_kind(model))
    found = models.predict(again, samples(spark, x, y)).orderBy("idx").collect()
    assert [r.predicted for r in found] == margins.argmax(1).tolist()


def test_first_trees_are_newton_steps(spark):
    """With a tree of one leaf a round moves all margins by the same Newton step, towards the classes' shares."""
    rows = [([0.0], [float(c)], i) for i, c in enumerate([0] * 10 + [1] * 30 + [2] * 60)]
    df = packed(spark.createDataFrame(rows, "X array<double>, y array<double>, idx int"))
    model = boosting.fit_softmax_boosting(df, 3, 1, depth=0)
    assert all(abs(t["value"][0]) < 1e-6 for t in model.rounds[0])
    assert np.allclose(np.exp(model.start), [0.1, 0.3, 0.6])


def test_network_sensor_from_raw_rows_to_inference(spark, tmp_path):
    """A network with early stopping through the whole plan: split, scaling, windows, fit, save, load, score."""
    from test_models import milling

    from gaugeloom.plans import sensor as plans

    params = {
        "clean": {"target": "position"},
        "featurize": {"features": ["command", "vibration"]},
        "split": {"train_split": 0.6, "calibrate_split": 0.2},
        "scale": {"input": "standard", "output": "minmax"},
        "sequentialize": {"window_size": 5},
        "train": {"learning_method": "dnn", "n_epochs": 30, "patience": 5},
    }
    df = milling(spark)
    made, scores = plans.create_sensor(df, params, ["s"], ["t"], by_series=False)
    assert made.metrics["r2"] > 0.8 and models.FIRST_EPOCHS < len(made.model.history) <= models.FIRST_EPOCHS + 30
    assert scores.where("lower_bound > predicted OR predicted > upper_bound").count() == 0
    assets = plans.save_sensor(spark, made, str(tmp_path / "sensor"))
    model = models.load_model(spark, assets["model"], assets["kind"])
    assert model == made.model
    found = plans.infer(made, df.drop("position"), ["s"], ["t"])
    truth = df.join(found.withColumnRenamed("idx", "t"), ["s", "t"])
    assert truth.agg(F.corr("position", "predicted")).first()[0] > 0.9


def test_random_cosines_are_cosines():
    draw = np.random.default_rng(10)
    machine = gradient.SupportVector(5, 0.1, 0.1, "rbf", 37)
    x = draw.normal(0, 20, (gradient.COSINE_ROWS * 2 + 3, 5))
    wanted = np.sqrt(2 / 37) * np.cos(x @ machine.turns + machine.shift)
    found = np.vstack([z.copy() for _, z in machine._mapped(x)])
    assert np.abs(found - wanted).max() < 1e-13


def test_samples_are_staged_as_blocks(spark, monkeypatch):
    """A scan meets whole blocks, not one row a sample; held-out samples are in them."""
    monkeypatch.setattr(gradient, "BLOCK_VALUES", 50)
    draw = np.random.default_rng(11)
    x, y = draw.normal(size=(60, 3)), draw.normal(size=60)
    data = packed(samples(spark, x, y, 1)).withColumn("validation", F.monotonically_increasing_id() % 3 == 0)
    held = np.array([r.validation for r in data.collect()])
    truth = np.array([[*r.features.toArray(), r.label] for r in data.collect()])
    blocks, (centre, scale, y_centre, y_scale), n, _ = gradient._prepared(data, True)
    assert n == (~held).sum() and blocks.count() == 6
    network = gradient.Dense((3, 4, 1))
    w = network.start(0)
    loss, slope, watched = gradient._scan(blocks, network, w, 3)
    a, b = (truth[:, :3] - centre) / scale, (truth[:, 3] - y_centre) / y_scale
    wanted = network.batch(w, a[~held], b[~held])
    assert loss == pytest.approx(wanted[0] / n) and np.allclose(slope, wanted[1] / n)
    assert watched == pytest.approx(network.losses(w, a[held], b[held]).mean())


def counted(spark, rows=80):
    """Samples of noise and how often one of them was made."""
    made = spark.sparkContext.accumulator(0)
    count = F.udf(lambda v: (made.add(1), v)[1], "int").asNondeterministic()
    draw = np.random.default_rng(12)
    return samples(spark, draw.normal(size=(rows, 2)), draw.normal(size=rows)).withColumn("idx", count("idx")), made


def test_windows_are_made_once_for_a_fit(spark):
    df, made = counted(spark)
    models.train(df, "dnn", n_epochs=1, early_stopping=True, order=["idx"])
    assert made.value == 80


def test_the_held_out_tail_is_found_in_one_pass(spark):
    df, made = counted(spark)
    validation_tail(df, 0.25, [], ["idx"])
    assert made.value == 80


def test_tree_samples_are_dealt_by_their_values(spark, monkeypatch):
    monkeypatch.setattr(models, "TASK_VALUES", 100)
    draw = np.random.default_rng(13)
    df = packed(samples(spark, draw.normal(size=(200, 2)), draw.normal(size=200), 1))
    assert models._spread(df).rdd.getNumPartitions() == 4
    monkeypatch.setattr(models, "TASK_VALUES", 400)
    assert models._spread(df) is df


def _blocks_of_tasks(df, block):
    """Numbers of samples of the tasks, and all blocks that tasks cut their samples into."""
    parts = [[r.label for r in rows] for rows in df.rdd.glom().collect()]
    return [len(p) for p in parts], sorted(p[i : i + block] for p in parts for i in range(0, len(p), block))


@pytest.mark.parametrize("sizes", [[5000, 700, 1, 2100, 900, 640, 300, 128, 4000, 1300], [6000]])
def test_samples_scanned_many_times_are_dealt_evenly(spark, monkeypatch, sizes):
    """Ten tasks on eight cores, or one: each core gets as much, in the blocks that the network meets otherwise."""
    df, at = None, 0
    for size in sizes:
        part = spark.range(at, at + size, 1, 1).selectExpr("array_repeat(id, 2) AS features", "double(id) AS label")
        df, at = part if df is None else df.union(part), at + size
    assert models._even(df, 64) is df  # too few
    monkeypatch.setattr(models, "EVEN_SAMPLES", 1)
    even = models._even(df, 64)
    assert even.columns == df.columns
    (_, expected), (counts, found) = _blocks_of_tasks(df, 64), _blocks_of_tasks(even, 64)
    assert found == expected
    assert len(counts) % 8 == 0 and max(counts) - min(counts) < 3 * 64
    assert models._even(even, 64) is even


def test_dealing_leaves_the_network_as_it_is(spark, monkeypatch):
    rows = spark.range(0, 3000, 1, 3).where("id < 2100").selectExpr("array(sin(id), cos(id / 3), id / 3000) AS X")
    rows = rows.selectExpr("X", "array(double(X[0] + X[2] > 0.5)) AS y")
    before = models.train(rows, "dnn", True, n_epochs=10)
    dealt, even = [], models._even
    monkeypatch.setattr(models, "EVEN_SAMPLES", 1)
    monkeypatch.setattr(models, "_even", lambda *x: dealt.append(even(*x)) or dealt[-1])
    after = models.train(rows, "dnn", True, n_epochs=10)
    assert dealt[0].rdd.getNumPartitions() == 8
    assert np.allclose(before.weights.toArray(), after.weights.toArray(), rtol=1e-6)


def test_blocks_are_read_and_handed_over_in_bounded_lots(spark, monkeypatch):
    """A block is one large row: by rows alone a task would hold thousands of them."""
    import glob

    import pyarrow as pa
    import pyarrow.parquet as pq

    from gaugeloom.session import small_batches

    monkeypatch.setattr(gradient, "HELD_BYTES", 300_000)
    df = spark.range(0, 120_000, 1, 1).select(array_to_vector(F.array(*map(F.rand, range(3)))).alias("features"), F.rand(9).alias("label"))
    blocks, *_ = gradient._prepared(df, True)
    files = [pq.ParquetFile(f) for path in blocks.inputFiles() for f in glob.glob(path.removeprefix("file://"))]
    groups = [f.metadata.row_group(i) for f in files for i in range(f.num_row_groups)]
    assert len(groups) > 2 and max(g.total_byte_size for g in groups) < 2_000_000

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["n"])

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    with small_batches(spark, gradient.HELD_BYTES):
        found = [r.n for r in blocks.coalesce(1).mapInArrow(sizes, "n long").collect()]
    assert len(found) > 3 and max(found) < 3 * 300_000
    assert spark.conf.get(name) == before


def test_targets_of_boosting_are_made_once_a_round(spark, monkeypatch):
    """Each fit scans its rows several times; what it reads must be plain columns of a stage table."""
    plans = []

    class Watched(DecisionTreeRegressor):
        def fit(self, df):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString().lower())
            return super().fit(df)

    draw = np.random.default_rng(3)
    x = draw.normal(size=(200, 2))
    df = packed(samples(spark, x, (x[:, 0] > 0).astype(int) + (x[:, 1] > 0)))
    monkeypatch.setattr(boosting, "DecisionTreeRegressor", Watched)
    model = boosting.fit_softmax_boosting(df, 3, 2, rate=1.0)
    assert len(plans) == 6 and not any("exp" in p.replace("exprid", "") or "python" in p or "arrow" in p for p in plans)
    assert model.history[1][1] < model.history[0][1]
