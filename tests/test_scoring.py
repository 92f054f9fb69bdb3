"""Scoring: state per sensor, any cut of the input, model files, faulty outputs."""

import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from onnx_model import lstm_model
from stridelake.operators import scoring
from stridelake.operators.scoring import LstmScorer, ModelParams, OnnxScorer, score_runs, score_samples

PARAMS = ModelParams(hidden_dim=4)
LSTM = LstmScorer.seeded(PARAMS)
EXACT = LstmScorer.seeded(PARAMS, dtype="float64")


def samples(n=300, seed=0):
    rng = random.Random(seed)
    return [(i, rng.choice(["hot"] * 6 + ["a", "b", "c"]), rng.uniform(0, 3), None if rng.random() < .1 else rng.uniform(0, 9))
            for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, "seq long, sensor_id string, accl_mag double, gyro_mag double").repartition(3)


def alone(scorer, data):
    """Every sensor's samples one at a time, with the state handed on."""
    state, out = {}, {}
    for seq, k, a, g in data:
        h, c = state.get(k, (np.zeros(PARAMS.state_shape), np.zeros(PARAMS.state_shape)))
        x = np.array([[[a, g or 0.0]]], dtype=np.float32)
        v, m, h, c = scorer.score(x, h, c)
        state[k] = (h, c)
        out[seq] = 0.0 if m[0, 0] < 0.5 else float(v[0, 0])
    return out


@pytest.mark.parametrize("rows", [10, 60, 10_000])
def test_lstm_in_chunks(spark, rows):
    data = samples()
    got = score_samples(frame(spark, data), lambda: EXACT, ["seq"], rows=rows).collect()
    want = alone(EXACT, data)
    assert len(got) == len(data)
    assert all(abs(r.predicted_velocity - want[r.seq]) < 1e-12 for r in got)
    assert any(want.values()) and not all(want.values())


def test_small_arrow_batches(spark):
    data = samples(200, 1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r.seq: r.predicted_velocity for r in score_samples(frame(spark, data), lambda: EXACT, ["seq"], rows=20).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = alone(EXACT, data)
    assert all(abs(got[s] - want[s]) < 1e-12 for s in want)


def test_model_file_agrees_with_numpy(spark, tmp_path):
    (tmp_path / "lstm.onnx").write_bytes(lstm_model(LSTM))
    (tmp_path / "params.json").write_text(json.dumps({
        "model_lstm_hidden_dim": 4, "model_lstm_num_layers": 1, "model_lstm_bidirectional": False,
        "feature_cols": ["accl_mag", "gyro_mag"]}))
    load = scoring.onnx_from_files(spark, str(tmp_path / "lstm.onnx"), str(tmp_path / "params.json"))
    data = samples(120, 2)
    got = {r.seq: r.predicted_velocity for r in score_samples(frame(spark, data), load, ["seq"], rows=15).collect()}
    want = alone(LSTM, data)
    assert all(abs(got[s] - want[s]) < 1e-5 for s in want)


def test_stateless_model_and_wrong_lengths():
    free = OnnxScorer(lstm_model(LSTM, stateful=False), PARAMS)
    assert not free.stateful and OnnxScorer(lstm_model(LSTM), PARAMS).stateful
    rows = pd.DataFrame({"accl_mag": [1.0, 2.0, 3.0], "gyro_mag": [0.5, None, 1.0]})
    velocity, movement, scored, ends = score_runs(free, rows, [(0, 3, None)])
    zero = np.zeros(PARAMS.state_shape)
    expected = LSTM.score(scoring.feature_matrix(rows, PARAMS.feature_cols)[None], zero, zero)
    assert np.allclose(velocity, expected[0][0], atol=1e-5) and ends == [None]
    cut = OnnxScorer(lstm_model(LSTM, cut=True), PARAMS)
    velocity, movement, scored, ends = score_runs(cut, rows, [(0, 3, None)])
    assert not scored.any() and np.isnan(velocity).all() and np.isnan(movement).all()
    assert np.allclose(np.frombuffer(ends[0], np.float32)[:4], expected[2].ravel(), atol=1e-5)


def test_side_by_side_equals_alone():
    rng = np.random.default_rng(1)
    rows = pd.DataFrame({"accl_mag": rng.random(40), "gyro_mag": rng.random(40)})
    runs = [(0, 3, None), (3, 20, None), (20, 20, b""), (20, 21, None), (21, 40, None)]
    velocity, movement, scored, ends = score_runs(EXACT, rows, runs)
    for (lo, hi, _), end in zip(runs, ends):
        if hi > lo:
            zero = np.zeros(PARAMS.state_shape)
            v, m, h, c = EXACT.score(scoring.feature_matrix(rows, PARAMS.feature_cols)[None, lo:hi], zero, zero)
            assert np.allclose(velocity[lo:hi], v[0], atol=1e-13) and np.allclose(movement[lo:hi], m[0], atol=1e-13)
            assert np.allclose(np.frombuffer(end), np.concatenate([h.ravel(), c.ravel()]), atol=1e-13)


def test_unknown_features_are_zero():
    matrix = scoring.feature_matrix(pd.DataFrame({"a": [1.0, None]}), ["missing", "a"])
    assert matrix.dtype == np.float32 and matrix.tolist() == [[0.0, 1.0], [0.0, 0.0]]


def test_nan_of_a_model_is_not_null(spark):
    class Broken:
        params, stateful, state_dtype = ModelParams(hidden_dim=4), False, np.dtype("float32")

        def score(self, features, h, c):
            out = np.full(features.shape[:2], np.nan, np.float32)
            return out, np.ones_like(out), h, c

    got = score_samples(frame(spark, samples(9)), Broken, ["seq"])
    assert got.filter("isnan(predicted_velocity)").count() == 9


def test_mask_and_linear(spark):
    df = spark.createDataFrame([(0.49, 3.0), (0.5, 3.0)], "p double, v double")
    from stridelake.functions.motion import masked_velocity
    assert [r[0] for r in df.select(masked_velocity(F.col("v"), F.col("p"))).collect()] == [0.0, 3.0]
    assert df.select(scoring.linear_score({"v": 2.0}, 1.0)).first()[0] == 7.0


@pytest.mark.parametrize("stateful", [True, False])
def test_scores_do_not_depend_on_batches_or_chunks(spark, stateful):
    class WholeSequence:
        """Every sample gets the sum of all it was shown, so results tell what was cut where."""
        params, stateful, state_dtype = ModelParams(hidden_dim=4), False, np.dtype("float32")

        def score(self, features, h, c):
            total = np.broadcast_to(features[:, :, 0].sum(axis=1, keepdims=True), features.shape[:2])
            return total, np.ones(features.shape[:2]), h, c

    data = spark.range(120).selectExpr(
        "concat('s', id % 2) AS sensor_id", "id div 12 AS record", "id AS pos", "double(id % 7) AS accl_mag", "double(id % 3) AS gyro_mag")
    name, found = "spark.sql.execution.arrow.maxRecordsPerBatch", set()
    before = spark.conf.get(name)
    try:
        for batch in (7, 10_000):
            spark.conf.set(name, str(batch))
            for rows in (10, 1_000_000):
                order = ["pos"] if stateful else ["record", "pos"]
                scored = score_samples(data, (lambda: EXACT) if stateful else WholeSequence, order, rows=rows)
                found.add(tuple(sorted((r.pos, round(r.predicted_velocity, 9)) for r in scored.collect())))
    finally:
        spark.conf.set(name, before)
    assert len(found) == 1
    if not stateful:
        sums = {}
        for i in range(120):
            sums[i % 2, i // 12] = sums.get((i % 2, i // 12), 0) + i % 7
        assert dict(next(iter(found))) == {i: float(sums[i % 2, i // 12]) for i in range(120)}
