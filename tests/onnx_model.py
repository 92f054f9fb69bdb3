"""A small model file for ONNX Runtime, written field by field, with the weights of an LstmScorer."""

import numpy as np


def varint(n):
    out = b""
    while True:
        n, low = n >> 7, n & 0x7F
        out += bytes([low | (0x80 if n else 0)])
        if not n:
            return out


def number(field, value):
    return varint(field << 3) + varint(value)


def block(field, value):
    value = value.encode() if isinstance(value, str) else value
    return varint(field << 3 | 2) + varint(len(value)) + value


def tensor(name, array):
    kind = 7 if array.dtype == np.int64 else 1
    data = array.tobytes() if kind == 7 else array.astype(np.float32).tobytes()
    return b"".join(number(1, d) for d in array.shape) + number(2, kind) + block(8, name) + block(9, data)


def value_info(name, *dims):
    shape = b"".join(block(1, number(1, d) if isinstance(d, int) else block(2, d)) for d in dims)
    return block(1, name) + block(2, block(1, number(1, 1) + block(2, shape)))


def node(op, inputs, outputs, *attributes):
    return (b"".join(block(1, i) for i in inputs) + b"".join(block(2, o) for o in outputs)
            + block(4, op) + b"".join(block(5, a) for a in attributes))


def int_attribute(name, value):
    return block(1, name) + number(3, value) + number(20, 2)


def ints_attribute(name, values):
    return block(1, name) + b"".join(number(8, v) for v in values) + number(20, 7)


def lstm_model(scorer, stateful=True, cut=False):
    """`cut` leaves out the last output of the sequence, so that lengths differ."""
    w_in, w_hidden, bias = scorer.layers[0]
    size, width = scorer.params.hidden_dim, w_in.shape[1]
    order = np.concatenate([np.arange(g * size, (g + 1) * size) for g in (0, 3, 1, 2)])
    constants = {
        "W": w_in[order][None], "R": w_hidden[order][None],
        "B": np.concatenate([bias[order], np.zeros(4 * size)])[None],
        "WV": scorer.velocity_head[0][:, None], "BV": np.array([scorer.velocity_head[1]]),
        "WM": scorer.movement_head[0][:, None], "BM": np.array([scorer.movement_head[1]]),
        "seq": np.array([1, -1, size], dtype=np.int64), "row": np.array([1, -1], dtype=np.int64),
        "from": np.array([0], dtype=np.int64), "to": np.array([-1], dtype=np.int64), "axis": np.array([1], dtype=np.int64),
    }
    states = ["h_0", "c_0"] if stateful else ["", ""]
    nodes = [
        node("Transpose", ["sequence_features"], ["x"], ints_attribute("perm", [1, 0, 2])),
        node("LSTM", ["x", "W", "R", "B", "", *states], ["y", "h_n", "c_n"], int_attribute("hidden_size", size)),
        node("Reshape", ["y", "seq"], ["hidden"]),
        node("MatMul", ["hidden", "WV"], ["v0"]), node("Add", ["v0", "BV"], ["v1"]),
        node("Reshape", ["v1", "row"], ["v2" if cut else "velocity_pred"]),
        node("MatMul", ["hidden", "WM"], ["m0"]), node("Add", ["m0", "BM"], ["m1"]),
        node("Reshape", ["m1", "row"], ["m2"]), node("Sigmoid", ["m2"], ["movement_prob"]),
    ]
    if cut:
        nodes.append(node("Slice", ["v2", "from", "to", "axis"], ["velocity_pred"]))
    inputs = [value_info("sequence_features", 1, "T", width)]
    outputs = [value_info("velocity_pred", 1, "TV"), value_info("movement_prob", 1, "TM")]
    if stateful:
        inputs += [value_info(n, 1, 1, size) for n in ("h_0", "c_0")]
        outputs += [value_info(n, 1, 1, size) for n in ("h_n", "c_n")]
    graph = (b"".join(block(1, n) for n in nodes) + block(2, "g")
             + b"".join(block(5, tensor(k, np.asarray(v))) for k, v in constants.items())
             + b"".join(block(11, i) for i in inputs) + b"".join(block(12, o) for o in outputs))
    return number(1, 8) + block(7, graph) + block(8, block(1, "") + number(2, 13))
