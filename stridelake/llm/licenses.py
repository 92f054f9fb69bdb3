"""Licence scans of whole texts: notices by Aho-Corasick, licence expressions by a shunting-yard parser.

A text is read as words of 0-9, a-z and bytes over 127 after A-Z is lower-cased. Notice phrases are found where
their words stand consecutively. `SPDX-License-Identifier:` tags are followed by an expression of identifiers
with AND, OR, WITH and brackets; WITH binds closest, then AND, then OR. A tag's labels are the identifiers of its
expression in lower case, `a with b` for an exception. An expression that cannot be read gives no label.

Null texts count as empty and have no words. Long texts are scanned whole; rows are kept one to one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from stridelake.llm.names import free_name
from stridelake.llm.packed import LOWER, WORD_BYTES, raw_texts

# The base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Further notices of this operator.
MORE_PHRASES = {
    "bsd license": "bsd", "mozilla public license": "mpl", "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl", "eclipse public license": "epl", "isc license": "isc",
    "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc0 1 0 universal": "cc0", "creative commons attribution": "cc-by",
    "all rights reserved": "reserved", "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd"}
TAG_WORDS = "spdx license identifier"
TAG = b"spdx-license-identifier:"
PERMISSIVE = {"mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "cc0-1.0", "cc-by-4.0", "unlicense", "zlib"}
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"\(|\)|[a-z0-9.+:-]+")
FIELDS = {
    "n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long", "base_labels": "string",
    "labels": "string", "score": "double", "n_tags": "long", "permissive": "boolean"}


ARROW = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}


class BadExpression(ValueError):
    pass


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operands in order, an operator after its two operands."""
    output, waiting, operand_next = [], [], True
    for token in tokens:
        if token == "(":
            if not operand_next:
                raise BadExpression("operator expected")
            waiting.append(token)
        elif token == ")":
            if operand_next:
                raise BadExpression("identifier expected")
            while waiting and waiting[-1] != "(":
                output.append(waiting.pop())
            if not waiting:
                raise BadExpression("bracket is not open")
            waiting.pop()
        elif token in PRECEDENCE:
            if operand_next:
                raise BadExpression("identifier expected")
            while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= PRECEDENCE[token]:
                output.append(waiting.pop())
            waiting.append(token)
            operand_next = True
        else:
            if not operand_next:
                raise BadExpression("operator expected")
            output.append(token)
            operand_next = False
    if operand_next or "(" in waiting:
        raise BadExpression("expression ends early")
    return output + waiting[::-1]


def names(postfix: list[str]) -> set[str]:
    """The licences of an expression, those with an exception as `a with b`."""
    stack: list[set[str]] = []
    for token in postfix:
        if token not in PRECEDENCE:
            stack.append({token})
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            if len(left) != 1 or len(right) != 1:
                raise BadExpression("with needs one licence and one exception")
            stack.append({f"{left.pop()} with {right.pop()}"})
        else:
            stack.append(left | right)
    return stack.pop()


def holds(postfix: list[str], accepted: set[str]) -> bool:
    """Whether the expression can be met with the accepted licences; an exception only adds permissions."""
    stack: list[bool] = []
    for token in postfix:
        if token not in PRECEDENCE:
            stack.append(token in accepted)
            continue
        right, left = stack.pop(), stack.pop()
        stack.append(left and right if token == "and" else left or right if token == "or" else left)
    return stack.pop()


def read_expression(line: str) -> list[str]:
    """The expression at the start of the line, in postfix order; an error if it cannot be read."""
    tokens, at, operand_next, depth = [], 0, True, 0
    while True:
        while at < len(line) and line[at] in " \t":
            at += 1
        found = TOKEN.match(line, at)
        if not found:
            break
        token = found.group()
        is_operand = token not in PRECEDENCE and token not in "()"
        if (is_operand or token == "(") != operand_next or token == ")" and not depth:
            break
        depth += (token == "(") - (token == ")")
        operand_next = not (is_operand or token == ")")
        tokens.append(token.rstrip(".:") or token if is_operand else token)
        at = found.end()
    return to_postfix(tokens)


@cache
def automaton() -> ahocorasick.Automaton:
    """Every phrase with a space at both ends, so that it only fits whole words."""
    found = ahocorasick.Automaton()
    for phrase, label in {**MORE_PHRASES, **BASE_PHRASES, TAG_WORDS: ""}.items():
        kind = "base" if phrase in BASE_PHRASES else "tag" if phrase == TAG_WORDS else "more"
        found.add_word(f" {phrase} ", (kind, label, len(phrase) + 1))
    found.make_automaton()
    return found


def tag_labels(text: bytes) -> tuple[int, int, set[str], bool]:
    """Tags, readable tags, the licences in them, and whether permissive licences meet every readable one."""
    lowered = text.translate(LOWER)
    tags = readable = at = 0
    labels: set[str] = set()
    permissive = True
    while (at := lowered.find(TAG, at)) >= 0:
        at += len(TAG)
        end = lowered.find(b"\n", at)
        tags += 1
        try:
            postfix = read_expression(lowered[at:end if end >= 0 else len(lowered)].decode("latin-1"))
            found = names(postfix)
        except BadExpression:
            continue
        readable += 1
        labels |= found
        permissive &= holds(postfix, PERMISSIVE)
    return tags, readable, labels, permissive and readable > 0


def scan_text(text: bytes) -> tuple:
    words = text.translate(WORD_BYTES).split()
    spaced = f" {b' '.join(words).decode('latin-1')} "
    base, labels, starts, more, tagged = set(), set(), [], 0, False
    for end, (kind, label, back) in automaton().iter(spaced):
        if kind == "tag":
            tagged = True
            continue
        labels.add(label)
        if kind == "base":
            base.add(label)
            starts.append(spaced.count(" ", 0, end - back))
        else:
            more += 1
    tags, readable, named, permissive = tag_labels(text) if tagged else (0, 0, set(), False)
    notices = len(starts) + more
    score = 1.0 if readable else notices / (notices + 1.0)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels | named)), score, tags, permissive)


def scan(documents: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row with its words, places of base phrases, labels of notices and tags, and a score.

    The score is 1 with a readable tag, else n/(n+1) for n notices. `keep` names the columns that stay, all by
    default; those with the names of results are replaced.
    """
    source = free_name(documents, "scanned_text")
    kept = [c for c in (documents.columns if keep is None else keep) if c not in FIELDS]
    rows = documents.select(*[documents[c] for c in kept], documents[text].cast("string").alias(source))
    schema = StructType(rows.schema.fields[:-1])
    for name, kind in FIELDS.items():
        schema = schema.add(name, kind)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(zip(*(scan_text(t) for t in raw_texts(batch.column(source))))) or [[]] * len(FIELDS)
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(v, ARROW[t]) for v, t in zip(found, FIELDS.values())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *FIELDS])

    return rows.mapInArrow(scanned, schema)
