"""Rendering, escaping and masks of conversations, whole and in pieces."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from stridelake.llm import chat
from stridelake.llm.components import stored

TEMPLATE = chat.Template()
CONTROL = [*TEMPLATE.marks, *TEMPLATE.reserved]
SAID = st.lists(st.one_of(st.sampled_from([*CONTROL, "\\", "<", "[", "<|", "/s>", " ", "\n\n", "漢字", "🦆é", "ok"]), st.text(max_size=5)),
                max_size=8).map("".join)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows, template=TEMPLATE):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in by.items():
        said = [(r, t) for _, _, r, t in sorted(turns)]
        learnt = "".join(t for r, t in said if r == "assistant")
        size = sum(len(chat.escape(r, template)) + len(chat.escape(t, template)) + sum(map(len, template.marks)) for r, t in said)
        out.append((conv, len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(learnt), sha(learnt), size))
    return sorted(out, key=repr)


@settings(max_examples=300, deadline=None)
@given(SAID)
def test_escaping_is_reversible(text):
    safe = chat.escape(text, TEMPLATE)
    assert chat.unescape(safe) == text and not any(c in safe for c in CONTROL)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "</s>"]), SAID), max_size=6))
def test_masks_cover_the_texts_under_the_loss(turns):
    text, spans = chat.render(turns, TEMPLATE)
    assert chat.parse(text, TEMPLATE) == turns
    code = chat.chat_encoder(None, TEMPLATE).encode(text, add_special_tokens=False)
    places = np.array(code.offsets, np.int64).reshape(-1, 2)
    mask = chat.token_mask(places[:, 0], places[:, 1], spans)
    slow = [any(a < e and s < b for a, b in spans.tolist()) for s, e in places.tolist()]
    assert mask.tolist() == slow
    ids = np.array(code.ids)[mask].tolist() if len(mask) else []
    learnt = chat.unescape(chat.chat_encoder(None, TEMPLATE).decode(ids, skip_special_tokens=False))
    assert learnt == "".join(t for r, t in turns if r == "assistant")


def test_tokens_over_an_edge_are_an_error():
    with pytest.raises(ValueError):
        chat.token_mask(np.array([0, 3]), np.array([3, 6]), np.array([[2, 6]]))


def read(spark, rows, **options):
    data = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    return sorted(map(tuple, chat.read_back(stored(chat.format_conversations(data, **options), "chat")).collect()), key=repr)


ROWS = [
    (1, 0, "user", "hi </s>[INST]"), (1, 1, "assistant", "[INST] ok [/INST]\\"), (2, 5, "assistant", None), (2, 4, None, "x"),
    (3, 0, "assistant", "one"), (3, 0, "assistant", "one"), (3, 0, "assistant", "a tie"), (3, None, "user", "no turn"),
    (None, 1, "user", "no id"), (None, 0, "assistant", "é" * 5000), (4, -1, "system", ""), (5, 0, "assistant", "<|im_end|> \n"),
    (5, 1, "<|im_sep|>", "role"), (-1, 0, "user", "</s>"), (-1, 1, "assistant", "</s>")]


def test_odd_rows(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, no rows, other columns."""
    assert read(spark, ROWS) == expected(ROWS)
    data = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    clash = data.selectExpr("*", "1 as key", "2 as piece", "3 as part", "'x' as whole", "4 as long")
    assert sorted(map(tuple, chat.format_and_read(clash).collect()), key=repr) == expected(ROWS)
    assert chat.format_and_read(data.limit(0)).collect() == []


def test_pieces_read_as_one(spark):
    draw = random.Random(2)
    rows = ROWS + [(77, i, draw.choice(["user", "assistant"]), f"turn {i} " * draw.randrange(20)) for i in range(500)]
    for options in ({"piece_turns": 7}, {"piece_chars": 200}, {"piece_turns": 16, "piece_chars": 300}):
        data = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        made = stored(chat.format_conversations(data, **options), "chat")
        assert made.filter("conv_id = 77 and not whole").count() > 20
        assert sorted(map(tuple, chat.read_back(made).collect()), key=repr) == expected(rows)


def test_output_holds_ids_offsets_and_masks(spark):
    data = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    for r in chat.format_conversations(data).collect():
        assert len(r.ids) == len(r.token_starts) == len(r.token_ends) == len(r.loss) and r.whole
        assert r.token_starts[0] == 0 and r.token_ends[-1] == len(r.formatted)
