"""Scoring of sample sequences with a model whose state lives per sensor."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stridelake.functions.motion import masked_velocity
from stridelake.operators.ordered_state import fold_in_order
from stridelake.settings import CHUNK_ROWS, FEATURE_COLUMNS

# Names of a model's inputs and outputs.
MODEL_INPUTS = ("sequence_features", "h_0", "c_0")
MODEL_OUTPUTS = ("velocity_pred", "movement_prob", "h_n", "c_n")


@dataclass(frozen=True)
class ModelParams:
    hidden_dim: int
    num_layers: int = 1
    bidirectional: bool = False
    feature_cols: tuple[str, ...] = FEATURE_COLUMNS

    @classmethod
    def from_json(cls, text: str) -> ModelParams:
        # Key names of the parameter file.
        doc = json.loads(text)
        return cls(int(doc["model_lstm_hidden_dim"]), int(doc["model_lstm_num_layers"]),
                   bool(doc["model_lstm_bidirectional"]), tuple(doc["feature_cols"]))

    @property
    def state_shape(self) -> tuple[int, int, int]:
        return self.num_layers * (2 if self.bidirectional else 1), 1, self.hidden_dim


class Scorer(Protocol):
    """Scores one sequence [1, T, F]; gives velocities [1, T], probabilities [1, T] and the next h and c."""

    params: ModelParams
    stateful: bool
    state_dtype: np.dtype

    def score(self, features: np.ndarray, h: np.ndarray, c: np.ndarray): ...


@dataclass
class LstmScorer:
    """A one-direction LSTM with two linear heads. Weights: (w_in, w_hidden, bias) per layer, gates i, f, g, o."""

    params: ModelParams
    layers: Sequence[tuple[np.ndarray, np.ndarray, np.ndarray]]
    velocity_head: tuple[np.ndarray, float]
    movement_head: tuple[np.ndarray, float]
    dtype: np.dtype = np.dtype("float32")
    stateful: bool = True

    @property
    def state_dtype(self) -> np.dtype:
        return self.dtype

    @classmethod
    def seeded(cls, params: ModelParams, seed: int = 7, dtype: str = "float32") -> LstmScorer:
        rng, size = np.random.default_rng(seed), params.hidden_dim
        def draw(*shape):
            return np.round(rng.uniform(-0.6, 0.6, shape), 3).astype(dtype)
        widths = [len(params.feature_cols)] + [size] * (params.num_layers - 1)
        layers = [(draw(4 * size, w), draw(4 * size, size), draw(4 * size)) for w in widths]
        return cls(params, layers, (draw(size), float(draw(1)[0])), (draw(size), float(draw(1)[0])), np.dtype(dtype))

    def score(self, features, h, c):
        return self.score_side_by_side(features, h, c)

    def score_side_by_side(self, features, h, c, lengths=None):
        """The same for B sequences at once, [B, T, F], each of its own length."""
        x = features.astype(self.dtype)
        lengths = np.full(x.shape[0], x.shape[1]) if lengths is None else lengths
        h, c = h.astype(self.dtype).copy(), c.astype(self.dtype).copy()
        one = self.dtype.type(1)
        def sigmoid(v):
            return one / (one + np.exp(-v))
        for level, (w_in, w_hidden, bias) in enumerate(self.layers):
            out = np.empty((*x.shape[:2], self.params.hidden_dim), dtype=self.dtype)
            driven = x @ w_in.T + bias
            for t in range(x.shape[1]):
                live = lengths > t
                gates = driven[live, t] + h[level, live] @ w_hidden.T
                i, f, g, o = np.split(gates, 4, axis=1)
                c[level, live] = sigmoid(f) * c[level, live] + sigmoid(i) * np.tanh(g)
                h[level, live] = sigmoid(o) * np.tanh(c[level, live])
                out[:, t] = h[level]
            x = out
        velocity = x @ self.velocity_head[0] + self.dtype.type(self.velocity_head[1])
        movement = sigmoid(x @ self.movement_head[0] + self.dtype.type(self.movement_head[1]))
        return velocity, movement, h, c


class OnnxScorer:
    """A model file for ONNX Runtime; it keeps state if it has the input h_0."""

    state_dtype = np.dtype("float32")

    def __init__(self, model: bytes, params: ModelParams):
        import onnxruntime

        options = onnxruntime.SessionOptions()
        options.intra_op_num_threads = 1
        self.params = params
        self.session = onnxruntime.InferenceSession(model, options, providers=["CPUExecutionProvider"])
        self.stateful = MODEL_INPUTS[1] in [i.name for i in self.session.get_inputs()]

    def score(self, features, h, c):
        given = {MODEL_INPUTS[0]: features.astype(np.float32)}
        wanted = list(MODEL_OUTPUTS[:2])
        if self.stateful:
            given |= {MODEL_INPUTS[1]: h.astype(np.float32), MODEL_INPUTS[2]: c.astype(np.float32)}
            wanted = list(MODEL_OUTPUTS)
        results = self.session.run(wanted, given)
        return (*results, h, c) if not self.stateful else tuple(results)


SCORE_FIELDS = (
    T.StructField("_velocity", T.DoubleType()), T.StructField("_movement", T.DoubleType()),
    T.StructField("_scored", T.BooleanType()))

_loaded: dict = {}


def onnx_from_files(spark, model_path: str, params_path: str) -> Callable[[], Scorer]:
    """Ship the files to the executors; each Python worker loads them once."""
    for path in (model_path, params_path):
        spark.sparkContext.addFile(path)
    names = model_path.rsplit("/", 1)[-1], params_path.rsplit("/", 1)[-1]
    return lambda: _load_onnx(names)


def _load_onnx(names: tuple[str, str]) -> OnnxScorer:
    if names not in _loaded:
        with open(SparkFiles.get(names[0]), "rb") as model, open(SparkFiles.get(names[1])) as params:
            _loaded[names] = OnnxScorer(model.read(), ModelParams.from_json(params.read()))
    return _loaded[names]


def pack_state(h: np.ndarray, c: np.ndarray) -> bytes:
    return np.concatenate([h.ravel(), c.ravel()]).tobytes()


def unpack_state(state: bytes | None, scorer: Scorer) -> tuple[np.ndarray, np.ndarray]:
    shape = scorer.params.state_shape
    if not state:
        return np.zeros(shape, scorer.state_dtype), np.zeros(shape, scorer.state_dtype)
    h, c = np.frombuffer(state, dtype=scorer.state_dtype).reshape(2, *shape)
    return h, c


def feature_matrix(rows: pd.DataFrame, columns: Sequence[str]) -> np.ndarray:
    """[T, F] in single precision; missing values and unknown names are 0."""
    matrix = [rows[c].fillna(0.0).to_numpy(np.float32) if c in rows else np.zeros(len(rows), np.float32) for c in columns]
    return np.stack(matrix, axis=1) if matrix else np.zeros((len(rows), 0), np.float32)


def score_runs(scorer: Scorer, rows: pd.DataFrame, runs: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """Velocities, movement probabilities, which rows got them, and end states of many sequences."""
    features = feature_matrix(rows, scorer.params.feature_cols)
    velocity = np.full(len(rows), np.nan)
    movement = np.full(len(rows), np.nan)
    scored = np.zeros(len(rows), bool)
    starts = [unpack_state(state, scorer) for _, _, state in runs]
    lengths = np.array([hi - lo for lo, hi, _ in runs])
    if hasattr(scorer, "score_side_by_side"):
        # Pad to the longest sequence; sequences of like length keep the padding small.
        ends = [pack_state(h, c) for h, c in starts]
        by_length = [i for i in np.argsort(-lengths, kind="stable") if lengths[i]]
        for batch in _like_lengths(by_length, lengths):
            longest = lengths[batch[0]]
            x = np.zeros((len(batch), longest, features.shape[1]), np.float32)
            for b, i in enumerate(batch):
                x[b, :lengths[i]] = features[runs[i][0]:runs[i][1]]
            h = np.concatenate([starts[i][0] for i in batch], axis=1)
            c = np.concatenate([starts[i][1] for i in batch], axis=1)
            v, m, h, c = scorer.score_side_by_side(x, h, c, lengths[batch])
            for b, i in enumerate(batch):
                lo, hi, _ = runs[i]
                velocity[lo:hi], movement[lo:hi], scored[lo:hi] = v[b, :hi - lo], m[b, :hi - lo], True
                ends[i] = pack_state(h[:, b:b + 1], c[:, b:b + 1])
        return velocity, movement, scored, ends
    ends = []
    for (lo, hi, state), (h, c) in zip(runs, starts):
        if hi > lo:
            v, m, h, c = scorer.score(features[None, lo:hi], h, c)
            # Outputs of another length are not assigned, but the state moves on.
            if len(v) and np.shape(v)[1] == hi - lo and len(m) and np.shape(m)[1] == hi - lo:
                velocity[lo:hi], movement[lo:hi], scored[lo:hi] = v[0], m[0], True
        ends.append(pack_state(h, c) if scorer.stateful else None)
    return velocity, movement, scored, ends


def _like_lengths(by_length: list[int], lengths: np.ndarray):
    """Groups of sequences, longest first, in which none is under half the longest."""
    group: list[int] = []
    for i in by_length:
        if group and lengths[i] * 2 < lengths[group[0]]:
            yield np.array(group)
            group = []
        group.append(i)
    if group:
        yield np.array(group)


def score_records(
    samples: DataFrame, make_scorer: Callable[[], Scorer], order: Sequence[str], record: Sequence[str],
    key: str = "sensor_id",
) -> DataFrame:
    """Score every record of a sensor on its own, with a model that keeps no state.

    A record is the samples with equal `record` columns, which a packet bounds. What a model sees does not
    depend on how rows lie in batches or tasks.
    """
    inputs = samples.drop("predicted_velocity")
    known = [c for c in make_scorer().params.feature_cols]
    listed = F.array_sort(F.collect_list(F.struct(*order, F.struct(*inputs.columns).alias("_row"))))
    grouped = inputs.groupBy(key, *record).agg(listed.alias("_rows"))
    def values(name: str) -> Column:
        return F.transform("_rows", lambda s: (s["_row"][name] if name in inputs.columns else F.lit(0.0)).cast("double"))

    lists = [values(name) for name in known]

    @F.pandas_udf("velocity array<double>, movement array<double>, scored boolean")
    def scored_record(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for columns in parts:
            out = []
            for values in zip(*columns):
                rows = pd.DataFrame({c: np.asarray(v, float) for c, v in zip(known, values)})
                velocity, movement, scored, _ = score_runs(scorer, rows, [(0, len(rows), None)])
                out.append((velocity, movement, bool(scored.all())))
            yield pd.DataFrame(out, columns=["velocity", "movement", "scored"])

    found = grouped.withColumn("_found", scored_record(*lists))
    one = F.transform("_rows", lambda s, i: F.struct(
        s["_row"].alias("row"), F.get(F.col("_found.velocity"), i).alias("_velocity"),
        F.get(F.col("_found.movement"), i).alias("_movement"), F.col("_found.scored").alias("_scored")))
    return with_masked_velocity(found.select(F.inline(one)).select("row.*", "_velocity", "_movement", "_scored"))


def score_samples(
    samples: DataFrame, make_scorer: Callable[[], Scorer], order: Sequence[str], key: str = "sensor_id",
    rows: int = CHUNK_ROWS, record: Sequence[str] | None = None,
) -> DataFrame:
    """Add predicted_velocity, masked by the movement probability, to every sample row.

    The state of a model runs along each sensor's samples and is not reset between sessions. A model without state
    is given one record at a time: rows with equal `record` columns, by default all of `order` but the last.
    """
    if not make_scorer().stateful:
        return score_records(samples, make_scorer, order, record or list(order[:-1]) or list(order), key)
    inputs = samples.drop("predicted_velocity")
    names = inputs.columns
    schema = T.StructType([*inputs.schema.fields, *SCORE_FIELDS])

    def make_step():
        scorer = make_scorer()
        def step(batch, runs):
            velocity, movement, scored, ends = score_runs(scorer, batch, runs)
            return batch[names].assign(_velocity=velocity, _movement=movement, _scored=scored), ends
        return step

    scored = fold_in_order(inputs, key, order, make_step, schema, rows)
    return with_masked_velocity(scored)


def with_masked_velocity(scored: DataFrame) -> DataFrame:
    """pandas hands a NaN back as null, so a scored row's null is a NaN of the model."""
    velocity, movement = [F.coalesce(c, F.lit(float("nan"))) for c in ("_velocity", "_movement")]
    masked = F.when(F.col("_scored"), masked_velocity(velocity, movement))
    return scored.withColumn("predicted_velocity", masked).drop("_velocity", "_movement", "_scored")


def linear_score(features: dict[str, float], bias: float = 0.0) -> Column:
    """A model without state, as a column expression."""
    total = F.lit(bias)
    for name, weight in features.items():
        total = total + F.coalesce(F.col(name), F.lit(0.0)) * F.lit(weight)
    return total


def regroup_records(scored: DataFrame, record: Sequence[str], position: str, fields: Sequence[str]) -> DataFrame:
    """Put scored samples back into their records, in order; a record's samples are bounded by its packet."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(position).alias("_p"), F.struct(*fields).alias("s"))))
    return scored.groupBy(*record).agg(F.transform(listed, lambda m: m["s"]).alias("samples"))
