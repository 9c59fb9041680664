"""Models behave sensibly; evaluation numbers are exact."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.catalog import models as catalog
from tarmac.models import evaluate, features, logistic, network, newton
from tarmac.sources import sample


@pytest.fixture(scope="module")
def flights(spark, sf_dir):
    return sample.flights(spark, sf_dir, "dep_delay", "taxi_out", "arr_delay", "distance").cache()


def base_error(rows):
    p = rows.agg(F.avg("label")).first()[0]
    return math.sqrt(p * (1 - p))


def test_regression_beats_the_base_rate_and_is_monotone(spark, flights):
    model = logistic.fit(flights)
    scored = logistic.evaluated(model, flights)
    assert evaluate.probabilistic(scored).first()["rmse"] < base_error(scored)
    swept = [r["probability"] for r in logistic.sweep(model, spark).where("varied = 'dep_delay'").orderBy("dep_delay").collect()]
    assert swept == sorted(swept, reverse=True)


def test_threshold_decides_the_class(flights):
    scored = logistic.evaluated(logistic.fit(flights), flights)
    assert scored.where((F.col("probability") > 0.7) != (F.col("prediction") == 1)).count() == 0


def test_ablation_names_every_feature(flights):
    rows = {r["dropped"]: r for r in logistic.ablation(flights, flights).collect()}
    assert set(rows) == {"none", *features.BASE_FEATURES}
    assert rows["dep_delay"]["rmse_all"] > rows["none"]["rmse_all"]


def test_evaluation_counts(spark):
    rows = spark.createDataFrame(
        [(1.0, 0.9, 1.0), (0.0, 0.8, 1.0), (0.0, 0.1, 0.0), (1.0, 0.2, 0.0), (0.0, 0.3, 0.0)],
        "label double, probability double, prediction double")
    r = evaluate.probabilistic(rows).first()
    assert (r["total_cancel"], r["total_nocancel"]) == (3, 2)
    assert (r["correct_cancel"], r["correct_nocancel"]) == (2 / 3, 0.5)
    assert r["accuracy"] == 0.6
    assert abs(r["rmse"] - math.sqrt((0.01 + 0.64 + 0.01 + 0.64 + 0.09) / 5)) < 1e-12
    c = evaluate.categorical(rows).first()
    assert (c["total_cancel"], c["correct_cancel"]) == (3, 2 / 3)
    assert evaluate.near_threshold(rows).first()["total_cancel"] == 0


def test_unknown_carrier_is_all_zero(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    rows = spark.createDataFrame([("AS",), ("AA",), ("??",)], "carrier string")
    out = Pipeline(stages=features.column_stages()[:2]).fit(rows).transform(rows)
    hot = [r["h"] for r in out.select(vector_to_array("carrier_hot").alias("h")).collect()]
    assert [sum(h) for h in hot] == [1.0, 1.0, 0.0]
    assert hot[0][0] == 1.0 and hot[1][13] == 1.0


def test_hashed_widths_need_no_pass(spark, sf_dir):
    rows = catalog.training.training_rows(sample.event_log(spark, sf_dir).where("event = 'arrived'"))
    rows = rows.fillna(0.0)
    data = features.with_hashed(rows, 32, 3)
    out = features.fit_columns(data, location=True).transform(data)
    assert out.select("features").first()["features"].size == network.input_width(32, 3)


def test_trials_cover_the_search_space():
    trials = network.trial_settings()
    assert len(trials) == 15
    assert {t["layout"] for t in trials} == set(network.LAYOUTS)
    assert {t["location"] for t in trials} == set(range(5, 11))
    assert (trials[0]["block_size"], trials[-1]["block_size"]) == (16, 512)


def test_common_newton_steps_equal_single_fits(spark):
    """Labels that no plane parts, with unknown values; every set against a fit of its own."""
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(20, 15, 4000), rng.normal(15, 6, 4000), rng.gamma(2, 500, 4000)])
    y = (rng.random(4000) < 1 / (1 + np.exp(x[:, 0] / 12 + x[:, 1] / 20 - 2 - x[:, 2] / 2000))).astype(float)
    rows = [(float(b), *(float(v) if rng.random() > 0.02 else None for v in a)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "label double, a double, b double, c double").cache()
    sets = [["a", "b", "c"], ["b", "c"], ["a", "c"], ["a"]]
    for names, got in zip(sets, newton.fit_all(df, sets)):
        known = np.array([[1.0, *(dict(zip("abc", r[1:]))[f] for f in names)] for r in rows if all(dict(zip("abc", r[1:]))[f] is not None for f in names)])
        label = np.array([r[0] for r in rows if all(dict(zip("abc", r[1:]))[f] is not None for f in names)])
        beta = np.zeros(len(names) + 1)
        for _ in range(40):
            p = 1 / (1 + np.exp(-known @ beta))
            beta += np.linalg.solve(known.T * (p * (1 - p)) @ known, known.T @ (label - p))
        assert np.allclose([got.intercept, *got.coefficients], beta, rtol=1e-6, atol=1e-9)
    scored = newton.scored(df, newton.fit_all(df, sets))
    assert scored.where("fit = 3").count() == sum(r[1] is not None for r in rows)


def test_newton_on_labels_that_can_be_parted(spark):
    df = spark.createDataFrame([(float(i < 40), float(i)) for i in range(100)], "label double, a double")
    fit = newton.fit_all(df, [["a"], []])
    p = {r.a: r.probability for r in newton.scored(df, fit[:1]).collect()}
    assert p[39.0] > 0.99 > 0.01 > p[40.0]
    assert abs(fit[1].intercept - math.log(0.4 / 0.6)) < 1e-8


def _network_rows(spark, n, blank=()):
    rng = np.random.default_rng(3)
    carriers, codes = ["AS", "AA", "??"], ["ATL", "ORD", "DFW", "SEA"]
    rows = []
    for i in range(n):
        late, origin = float(rng.normal(10, 20)), codes[i % 4]
        on_time = float(late < (25 if origin == "ATL" else 5))
        rows.append((on_time, None if i in blank else late, 12.0, 800.0, 3.0, 4.0, carriers[i % 3], 30.0, -90.0, 40.0, -80.0, origin, codes[(i // 4) % 4]))
    names = "ontime dep_delay taxiout distance avg_dep_delay avg_arr_delay carrier dep_lat dep_lon arr_lat arr_lon origin dest".split()
    kinds = {"carrier": "string", "origin": "string", "dest": "string"}
    return spark.createDataFrame(rows, ", ".join(f"{c} {kinds.get(c, 'double')}" for c in names))


def test_networks_take_every_row_and_learn_from_categories(spark, monkeypatch):
    """Several parts: each pass has all rows, and the one place with another limit is found."""
    seen, advance = [], network._advance
    monkeypatch.setattr(network, "PART_ROWS", 2000)
    monkeypatch.setattr(network, "_advance", lambda nets, parts, total: advance(nets, _noted(seen, parts), total))
    rows = _network_rows(spark, 6000)
    net = network.fit(rows, layout="16-4", airport_buckets=50, block_size=16)
    passes = len(net.losses)
    assert len(seen) > passes > 2 and sum(seen) == 6000 * passes
    scored = network.predict(net, rows)
    assert evaluate.probabilistic(scored, 0.5).first()["accuracy"] > 0.95
    assert scored.count() == 6000 and set(rows.columns) < set(scored.columns)


def _noted(seen, parts):
    for r in parts:
        seen.append(r["n"])
        yield r


def test_a_fit_is_the_same_however_rows_lie(spark):
    rows = _network_rows(spark, 3000)
    one, two = (network.fit(r, layout="8", airport_buckets=20, max_iter=3) for r in (rows.coalesce(1), rows.repartition(7)))
    assert one.losses == two.losses


def test_slopes_of_a_network_are_those_of_its_loss(monkeypatch):
    """One step of each kind of weight against differences of the loss."""
    monkeypatch.setattr(network, "RATE", 1.0)
    monkeypatch.setattr(network, "FIRST_SQUARES", 1e4)
    net = network.Network("5-3", 2, 10, 8, np.zeros(9), np.ones(9))
    net.start(1)
    rng = np.random.default_rng(2)
    real = rng.normal(size=(8, 9))
    numbers = {"carrier_no": np.arange(8) - 1, "origin_ix": np.arange(8) % 2, "dest_ix": np.arange(8) % 3, "dep_loc_2": np.arange(8) % 4, "arr_loc_2": np.zeros(8, int), "dep_arr_2": np.arange(8)}
    y = (real[:, 0] > 0).astype(np.float32)
    x, at = net.inputs(real, numbers)

    def loss(weights):
        other = network.Network("5-3", 2, 10, 8, net.mean, net.spread, [w.astype(np.float64) for w in weights])
        odds = other.forward(x.astype(np.float64), at, other.layers(other.weights[1]))[-1][:, 0]
        return float((np.logaddexp(0, odds) - y * odds).mean())

    before = [w.copy() for w in net.weights]
    assert abs(net.learn(x, at, y, 8) / 8 - loss(before)) < 1e-5
    for k in (0, 1):
        want = np.zeros(before[k].size)
        for i in range(before[k].size):
            near = [w.astype(np.float64) for w in before]
            near[k].ravel()[i] += 1e-6
            up = loss(near)
            near[k].ravel()[i] -= 2e-6
            want[i] = (up - loss(near)) / 2e-6
        # A step is the slope over the root of 1e4; the row of no category stays.
        if k == 0:
            want.reshape(before[0].shape)[-1] = 0
        assert np.allclose((before[k] - net.weights[k]).ravel() * 100, want, atol=1e-3), k
    assert not net.weights[0][-1].any()


def test_an_unknown_input_is_an_error(spark):
    with pytest.raises(Exception, match="unknown"):
        network.fit(_network_rows(spark, 60, blank={7}), layout="4", airport_buckets=20, max_iter=1)


def test_a_search_evaluates_every_setting(spark):
    rows = _network_rows(spark, 1500)
    settings = [{"layout": "8", "location": 5, "block_size": 32}, {"layout": "8-4", "location": 6, "block_size": 64}, {"layout": "4", "location": 5, "block_size": 16}]
    found = network.search(rows, rows, settings, airport_buckets=20, max_iter=2).collect()
    assert {(r["layout"], r["location"], r["block_size"]) for r in found} == {tuple(s.values()) for s in settings}
    assert [r["rmse"] for r in found] == sorted(r["rmse"] for r in found)
    single = network.fit(rows, "8-4", 6, 20, 2, 64)
    want = evaluate.probabilistic(network.predict(single, rows)).first()
    got = next(r for r in found if r["layout"] == "8-4")
    assert abs(got["rmse"] - want["rmse"]) < 1e-6 and got["accuracy"] == want["accuracy"]


def test_the_grid_is_searched_whole(spark, sf_dir, monkeypatch):
    asked = []
    monkeypatch.setattr(network, "search", lambda train, test, settings: asked.extend(settings) or train)
    catalog.tuning_grid(spark, sf_dir)
    assert asked == network.trial_settings()
