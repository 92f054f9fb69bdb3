"""Values the results depend on, and the options of a job."""

from __future__ import annotations

from dataclasses import dataclass, field

# Sampling, sessions, model and histogram.
SAMPLING_RATE_HZ = 200.0
SAMPLING_PERIOD_S = 0.005
SAMPLE_STEP_US = 5_000
MICROS_PER_SECOND = 1_000_000
SESSION_GAP_US = 600_000_000
AGGREGATION_INTERVAL_MS = 2_000
INFERENCE_FLUSH_MS = 1_000
MOVEMENT_THRESHOLD = 0.5
STD_FLOOR = 1e-6
HISTOGRAM_MAX_VELOCITY = 13.0
HISTOGRAM_BINS = 100
FEATURE_WINDOW = 132
SAMPLES_PER_PACKET = 64
PREVIOUS_MESSAGES = 3
PACKET_INTERVAL_S = 0.32
FEATURE_COLUMNS = ("accl_mag", "gyro_mag")

# Binary packet layout, scales and buffer limit.
PACKET_COMMAND = 0x7C
PACKET_DATA_TYPE = 0x1E
PACKET_HEADER_BYTES = 4
PACKET_PAYLOAD_HEAD_BYTES = 14
PACKET_SAMPLE_BYTES = 20
PACKET_CRC_BYTES = 2
ACC_SCALE = 0.488 / 1000
GYRO_SCALE = 140.0 / 1000
MAG_SCALE = 1.0 / 1711.0
MAX_BUFFER_BYTES = 1024 * 1024

# Serving.
FLUSH_LAST_MESSAGES = 10
FLUSH_INTERVAL_MS = 100
BATCH_SIZE = 100
MAX_CHART_POINTS = 100
WORKLOAD_KEYS = ("sum_workload", "last_workload", "workload")
RECORD_TYPE = "transformed-data"

# Rows of one key that a single task may hold when a key's history is scanned in order.
CHUNK_ROWS = 1_000_000


@dataclass(frozen=True)
class JobOptions:
    """Options of the motion job; topics left as None switch that output off."""

    kafka_servers: str = "localhost:9092"
    input_topic: str = "imu-data-all"
    output_topic: str | None = "sensor-data-transformed"
    session_topic: str | None = "new_session_topic"
    aggregate_topic: str | None = "sensor-data-aggregated"
    parquet_path: str | None = None
    session_gap_us: int = SESSION_GAP_US
    max_out_of_orderness: str = "1 second"
    record_trigger: str = "1 second"
    aggregate_trigger: str = "2 seconds"
    max_offsets_per_trigger: int = 5_000_000
    kafka_producer: dict = field(default_factory=lambda: {"kafka.linger.ms": "100", "kafka.batch.size": "65536"})
