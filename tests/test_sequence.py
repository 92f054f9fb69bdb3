"""Scans in chunks give what one pass over a key gives, for any chunk size and any skew."""

import random

import pytest

from stridelake.operators import aggregates, features, sequence, sessions
from stridelake.operators.sessions import assign_sessions


def history(seed=1, n=400):
    """Arrival, sensor (one holds half of all rows), a time that may be missing or go back, velocity."""
    rng, rows, clock = random.Random(seed), [], 0
    for arrival in range(n):
        clock += rng.choice([1, 5, 10, 11, -7, 300])
        sensor = "hot" if rng.random() < 0.5 else f"s{rng.randrange(12)}"
        velocity = rng.choice([None, float("nan"), -2.5, 0.0, 1.5, 14.0, rng.random()])
        rows.append((arrival * 3 + rng.randrange(3), sensor, None if rng.random() < 0.1 else clock, velocity))
    return rows


SCHEMA = "seq long, sensor_id string, kafka_timestamp long, predicted_velocity double"
GAP = 10


def walk(rows):
    """Session ids in plain Python."""
    last, part, out = {}, {}, {}
    for seq, sensor, ts, _ in sorted(rows):
        if ts is None:
            out[seq] = ("", False)
            continue
        new = sensor not in last or ts - last[sensor] > GAP
        if new:
            part[sensor] = ts
        last[sensor] = ts
        out[seq] = (f"{sensor}_{part[sensor]}", new)
    return out


@pytest.mark.parametrize("rows", [1, 7, 64, 10_000])
def test_sessions(spark, rows):
    data = history()
    found = assign_sessions(spark.createDataFrame(data, SCHEMA), "seq", GAP, rows)
    got = {r.seq: (r.sensor_session_id, r.is_new_session) for r in found.collect()}
    assert got == walk(data)


def test_exact_gap_stays_in_the_session(spark):
    data = [(1, "a", 100, 1.0), (2, "a", 110, 1.0), (3, "a", 121, 1.0)]
    found = assign_sessions(spark.createDataFrame(data, SCHEMA), "seq", GAP, 1)
    assert sorted(r.sensor_session_id for r in found.collect()) == ["a_100", "a_100", "a_121"]
    windows = sessions.event_time_sessions(spark.createDataFrame(data, SCHEMA), GAP)
    assert sorted((r.session_start_us, r.session_last_us) for r in windows.collect()) == [(100, 110), (121, 121)]


@pytest.mark.parametrize("rows", [1, 9, 10_000])
def test_running_and_final_totals(spark, rows):
    data = [(s, k, t, None if v != v else v) for s, k, t, v in history(3)]
    ids = walk(data)
    top, path, want = {}, {}, {}
    for seq, sensor, ts, v in sorted(data):
        sid = ids[seq][0]
        if not sid:
            continue
        if v is not None:
            top[sid] = max(top.get(sid, float("-inf")), v)
            path[sid] = path.get(sid, 0.0) + abs(v) * 0.005
        want[seq] = (top.get(sid, float("-inf")), round(path.get(sid, 0.0), 9))
    found = assign_sessions(spark.createDataFrame(data, SCHEMA), "seq", GAP, rows)
    running = aggregates.running_session_totals(found, "seq", rows=rows).collect()
    assert {r.seq: (r.session_max_velocity, round(r.session_total_distance, 9)) for r in running} == want
    placed = assign_sessions(spark.createDataFrame(data, SCHEMA), "seq", GAP, rows, keep_chunk=True)
    running = aggregates.running_session_totals(placed, "seq", rows=rows).collect()
    assert {r.seq: (r.session_max_velocity, round(r.session_total_distance, 9)) for r in running} == want
    final = aggregates.session_totals(found.filter("sensor_session_id <> ''")).collect()
    assert {r.sensor_session_id: (r.session_max_velocity, round(r.session_total_distance, 9)) for r in final} == {
        s: (top[s], round(path[s], 9)) for s in top}


def test_nan_never_wins_but_counts_for_distance(spark):
    data = [(1, "a", 1, float("nan")), (2, "a", 2, 3.0), (3, "b", 1, float("nan")), (4, "c", 1, None)]
    found = assign_sessions(spark.createDataFrame(data, SCHEMA), "seq", GAP)
    got = {r.sensor_id: r for r in aggregates.session_totals(found).collect()}
    assert got["a"].session_max_velocity == 3.0 and got["a"].session_total_distance != got["a"].session_total_distance
    assert got["b"].session_max_velocity == float("-inf")
    assert "c" not in got


def test_interval_totals_only_where_new_velocities_came(spark):
    data = [(1, "a", 0, 1.0), (2, "a", 1500, 2.0), (3, "a", 4100, None), (4, "a", 6100, -4.0)]
    found = assign_sessions(spark.createDataFrame(data, SCHEMA), "seq", 10_000)
    got = aggregates.interval_session_totals(found, interval_ms=2).orderBy("aggregation_timestamp_ms").collect()
    assert [(r.session_max_velocity, r.aggregation_timestamp_ms) for r in got] == [(2.0, 2), (2.0, 8)]
    assert [round(r.session_total_distance, 9) for r in got] == [0.015, 0.035]


@pytest.mark.parametrize("rows", [1, 5, 10_000])
def test_row_numbers_and_previous_values(spark, rows):
    data = history(5)
    df = spark.createDataFrame([(s, k, s * 2) for s, k, _, _ in data], "seq long, sensor_id string, v long")
    by_key = {}
    for s, k, _, _ in sorted(data):
        by_key.setdefault(k, []).append(s)
    numbered = sequence.with_row_number(df, "sensor_id", ["seq"], "n", rows, total="of").collect()
    assert {r.seq: (r.n, r.of) for r in numbered} == {
        s: (i + 1, len(seqs)) for seqs in by_key.values() for i, s in enumerate(seqs)}
    before = sequence.with_previous(df, "sensor_id", "seq", "v", "prev", rows).collect()
    assert {r.seq: r.prev for r in before} == {
        s: (seqs[i - 1] * 2 if i else None) for seqs in by_key.values() for i, s in enumerate(seqs)}


def test_last_rows_with_a_large_limit(spark):
    df = spark.createDataFrame([(i, "a" if i % 4 else "b") for i in range(80)], "seq long, sensor_id string")
    want = sorted(r.seq for r in sequence.last_rows(df, "sensor_id", ["seq"], 7).collect())
    before = spark.conf.get(sequence.EARLY_LIMIT, None)
    spark.conf.set(sequence.EARLY_LIMIT, "5")
    try:
        assert sorted(r.seq for r in sequence.last_rows(df, "sensor_id", ["seq"], 7).collect()) == want
    finally:
        spark.conf.unset(sequence.EARLY_LIMIT) if before is None else spark.conf.set(sequence.EARLY_LIMIT, before)


@pytest.mark.parametrize("rows", [3, 8, 10_000])
def test_message_windows(spark, rows):
    rng = random.Random(2)
    data = [(i, rng.choice("aab"), None if rng.random() < .1 else [i + j / 10 for j in range(rng.randrange(3))])
            for i in range(120)]
    df = spark.createDataFrame(data, "seq long, sensor_id string, samples array<double>")
    last4, buffered, store, past = {}, {}, {}, {}
    for seq, k, samples in data:
        past.setdefault(k, []).append(samples or [])
        joined = sum(past[k][-4:], [])
        if joined:
            last4[seq] = joined
        joined = sum(store.get(k, []), []) + (samples or [])
        if joined:
            buffered[seq] = joined
        if samples:
            store[k] = (store.get(k, []) + [samples])[-3:]
    got = features.sliding_messages(df, "seq", 4, rows=rows).collect()
    assert {r.seq: list(r.window_samples) for r in got} == last4
    got = features.buffered_messages(df, "seq", 3, rows=rows).collect()
    assert {r.seq: list(r.window_samples) for r in got} == buffered


@pytest.mark.parametrize("rows", [1, 10, 10_000])
def test_rolling_features(spark, rows):
    rng = random.Random(4)
    data = [(i, rng.choice("aaab"), float(rng.randrange(50)), float(rng.randrange(9))) for i in range(150)]
    df = spark.createDataFrame(data, "seq long, sensor_id string, accl_mag double, gyro_mag double")
    want, past = {}, {}
    for seq, k, a, g in data:
        p = past.setdefault(k, [])
        p.append((abs(a - p[-1][2]) if p else 0.0, g * g, a))
        want[seq] = (sum(x[0] for x in p[-12:]), sum(x[1] for x in p[-12:]))
    got = features.rolling_features(df, ["seq"], 12, rows=rows).collect()
    assert {r.seq: (r.accl_sum_of_changes, r.gyro_mag_energy) for r in got} == want


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 0.129, 0.131, 12.99, 13.0, 40.0, None, float("nan"))], "predicted_velocity double")
    assert {r.bin: r.samples for r in aggregates.velocity_histogram(df).collect()} == {0: 3, 1: 1, 99: 3}


def test_delivery(spark):
    df = spark.createDataFrame([("a", 0), ("a", 3_200_000), ("b", 0)], "sensor_id string, kafka_timestamp long")
    got = {r.sensor_id: (r.expected_packets, r.completeness) for r in aggregates.delivery_by_sensor(df).collect()}
    assert got == {"a": (10, 0.2), "b": (0, None)}
    assert aggregates.delivery_in_total(df).first().expected_packets == 20
    assert aggregates.delivery_in_total(df, target=6).first().completeness == 0.25
