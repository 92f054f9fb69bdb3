"""Conversations as training text: rendered, encoded once with offsets, with a loss mask aligned to the offsets.

A conversation is rendered by a template: marks around role and text of every turn. The marks, and every other reserved
string, are broken up by a backslash where they stand in a role or text, and backslashes are doubled, so what was said
can neither open nor close a turn, and is got back exactly. The marks are special tokens of the encoder, so no token
reaches from a mark into a text. The rendered text is encoded once; the spans of the turns under the loss and the
spans of the tokens are both in order, so a binary search gives the tokens of each span.

Rows are sorted by turn and stream through a task, which renders one conversation at a time. A conversation of more
than PIECE_TURNS rows is dealt by turn number to several tasks, and one of more than PIECE_CHARS characters is cut
between turns; its pieces are numbered, and follow each other as if they were one. A digest of a whole conversation
reads its pieces in order, with constant memory.

Null texts and roles are empty. Null turns come after all others, equal ones are ordered by role and text; repeated
rows are turns of their own. Rows without a conversation are one conversation, with a null id. A conversation without a
turn under the loss has an empty mask. An empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stridelake.llm.components import stored
from stridelake.llm.tokens import default_vocabulary

PIECE_TURNS = 1024
PIECE_CHARS = 4 << 20
# Rendered characters that are encoded in one call.
BATCH_CHARS = 1 << 20


@dataclass(frozen=True)
class Template:
    """Marks before the role, between role and text, and after the text; other strings that no text may hold."""

    # Marks of turns, and control strings of common templates.
    opens: str = "<|im_start|>"
    says: str = "<|im_sep|>"
    ends: str = "<|im_end|>"
    reserved: tuple[str, ...] = ("<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    loss_roles: tuple[str, ...] = ("assistant",)

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.opens, self.says, self.ends


ESCAPED = re.compile(r"\\(.)", re.DOTALL)


@cache
def _control(template: Template) -> re.Pattern:
    """The first character of any control string."""
    strings = sorted({*template.marks, *template.reserved}, key=len, reverse=True)
    return re.compile("|".join(f"{re.escape(s[0])}(?={re.escape(s[1:])})" for s in strings))


def escape(text: str, template: Template) -> str:
    return _control(template).sub(lambda m: m.group() + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def render(turns: Sequence[tuple[str, str]], template: Template) -> tuple[str, np.ndarray]:
    """The text of some turns (role and text), and the spans of the texts under the loss, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = f"{template.opens}{escape(role, template)}{template.says}"
        body = escape(text, template)
        if role in template.loss_roles and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, template.ends]
        at += len(head) + len(body) + len(template.ends)
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def parse(text: str, template: Template) -> list[tuple[str, str]]:
    """The turns that were rendered."""
    turns = []
    for part in text.split(template.ends)[:-1]:
        head, body = part.removeprefix(template.opens).split(template.says)
        turns.append((unescape(head), unescape(body)))
    return turns


@cache
def chat_encoder(path: str | None, template: Template):
    """The tokenizer with the marks as special tokens, and with offsets that keep white space."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer, processors
    tokenizer = Tokenizer.from_file(path or default_vocabulary())
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    tokenizer.add_special_tokens(list(template.marks))
    return tokenizer


def token_mask(starts: np.ndarray, ends: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which tokens lie in the spans. Both are in order, so each span is two binary searches."""
    mask = np.zeros(len(starts) + 1, np.int64)
    if len(spans):
        first = np.searchsorted(ends, spans[:, 0], side="right")
        last = np.searchsorted(starts, spans[:, 1], side="left")
        if (starts[first] != spans[:, 0]).any() or (ends[last - 1] != spans[:, 1]).any():
            raise ValueError("a token reaches over the edge of a turn")
        np.add.at(mask, first, 1)
        np.add.at(mask, last, -1)
    return np.cumsum(mask[:-1]) > 0


def format_conversations(
    conversations: DataFrame, template: Template = Template(), vocabulary: str | None = None, key: str = "conv_id",
    turn: str = "turn", role: str = "role", text: str = "text", piece_turns: int = PIECE_TURNS, piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """A row per conversation, or per piece of a long one.

    Columns: key, piece and part (0 and 0 unless it was cut), whole (not cut), formatted, ids, token_starts, token_ends
    (places in formatted), loss (one flag per token), n_turns.
    """
    rows = conversations.select(
        F.col(key).alias("key"), F.col(turn).cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))])
    long = rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > piece_turns).select(
        F.col("key").alias("_key"), F.lit(True).alias("long"))
    dealt = rows.join(long, rows["key"].eqNullSafe(F.col("_key")), "left").drop("_key")
    piece = F.when(F.col("long"), F.coalesce(F.expr(f"turn div {piece_turns}"), F.lit((1 << 63) - 1))).otherwise(F.lit(0).cast("long"))
    ordered = dealt.withColumn("long", F.coalesce("long", F.lit(False))).withColumn("piece", piece).repartition(
        "key", "piece").sortWithinPartitions("key", "piece", F.col("turn").asc_nulls_last(), "role", "text")
    key_type = rows.schema["key"].dataType.simpleString()
    schema = f"key {key_type}, piece long, part int, whole boolean, formatted string, ids array<int>, " \
        "token_starts array<int>, token_ends array<int>, loss array<boolean>, n_turns long"
    names = [part.split()[0] for part in schema.split(", ")]
    arrow_key = pa.int64() if key_type == "bigint" else pa.int32() if key_type == "int" else pa.string()

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = chat_encoder(vocabulary, template)
        done, size = [], 0  # rendered, not encoded yet
        current, turns, held, part = None, [], 0, 0

        def close(last: bool) -> None:
            nonlocal turns, held, part, size
            found, spans = render(turns, template)
            done.append((current[0], current[1], part, last and not part and not current[2], found, spans, len(turns)))
            size += len(found)
            turns, held, part = [], 0, part + 1

        def encoded() -> pa.RecordBatch:
            nonlocal done, size
            out = []
            for code in tokenizer.encode_batch([d[4] for d in done], add_special_tokens=False):
                places = np.array(code.offsets, np.int64).reshape(-1, 2)
                out.append((code.ids, places[:, 0], places[:, 1]))
            masks = [token_mask(starts, ends, d[5]) for d, (_, starts, ends) in zip(done, out)]
            kinds = [arrow_key, pa.int64(), pa.int32(), pa.bool_(), pa.string()]
            columns = [pa.array([d[i] for d in done], kind) for i, kind in enumerate(kinds)]
            columns += [pa.array([o[i] for o in out], pa.list_(pa.int32())) for i in range(3)]
            columns += [pa.array(masks, pa.list_(pa.bool_())), pa.array([d[6] for d in done], pa.int64())]
            done, size = [], 0
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            lists = [batch.column(c).to_pylist() for c in ("key", "piece", "long", "role", "text")]
            for k, number, is_long, who, said in zip(*lists):
                if (k, number, is_long) != current:
                    if turns:
                        close(True)
                    current, part = (k, number, is_long), 0
                elif held + len(said) > piece_chars and turns:
                    close(False)
                turns.append((who, said))
                held += len(said)
                if size > BATCH_CHARS:
                    yield encoded()
        if turns:
            close(True)
        if done:
            yield encoded()

    return ordered.select("key", "piece", "long", "role", "text").mapInArrow(formatted, schema).withColumnRenamed("key", key)


class Reading:
    """What is read back from the pieces of a conversation, in order."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, formatted: str, ids: np.ndarray, loss: np.ndarray, tokenizer, template: Template) -> None:
        for role, text in parse(formatted, template):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        learnt = unescape(tokenizer.decode(ids[loss].tolist(), skip_special_tokens=False)) if loss.any() else ""
        self.loss.update(learnt.encode())
        self.loss_chars += len(learnt)
        self.formatted_chars += len(formatted)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


def read_back(formatted: DataFrame, template: Template = Template(), vocabulary: str | None = None,
              key: str = "conv_id") -> DataFrame:
    """Per conversation: turns, their digest, and the text that the ids under the loss mask stand for.

    Whole conversations are read where they are; only cut ones are brought together, piece by piece.
    """
    key_type = formatted.schema[key].dataType.simpleString()
    schema = f"key {key_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [part.split()[0] for part in schema.split(", ")]
    arrow_key = pa.int64() if key_type == "bigint" else pa.int32() if key_type == "int" else pa.string()
    kinds = [arrow_key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = chat_encoder(vocabulary, template)
        current, reading = None, None
        for batch in batches:
            done = []
            for i, (k, whole) in enumerate(zip(batch.column("key").to_pylist(), batch.column("whole").to_pylist())):
                if reading and (whole or (k,) != current):
                    done.append((current[0], *reading.row()))
                    reading = None
                if not reading:
                    current, reading = (k,), Reading()
                ids, loss = (batch.column(c)[i].values for c in ("ids", "loss"))
                reading.add(batch.column("formatted")[i].as_py(), ids.to_numpy(), loss.to_numpy(zero_copy_only=False), tokenizer, template)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[j] for d in done], t) for j, t in enumerate(kinds)], names)
        if reading:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((current[0], *reading.row()), kinds)], names)

    rows = formatted.withColumnRenamed(key, "key").select("key", "piece", "part", "whole", "formatted", "ids", "loss")
    held = ["key", "whole", "formatted", "ids", "loss"]
    cut = rows.filter("not whole").repartition("key").sortWithinPartitions("key", "piece", "part")
    found = rows.filter("whole").select(*held).mapInArrow(read, schema).unionByName(cut.select(*held).mapInArrow(read, schema))
    return found.withColumnRenamed("key", key)


def format_and_read(conversations: DataFrame, template: Template = Template(), vocabulary: str | None = None) -> DataFrame:
    """The contract's columns, from the stored output."""
    return read_back(stored(format_conversations(conversations, template, vocabulary), "chat"), template, vocabulary)
