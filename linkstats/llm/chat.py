"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns as context, then that
reply, of which alone the text is trainable. A conversation whose last turn is not an
assistant's (or that has none) gets one more example without a target, so that every turn can
be read back from the last example.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles ``<``, any number of
backslashes and ``|`` get one backslash more, so no text holds ``<|``; unescaping takes one
away. Backslashes and newlines of roles are written ``\\\\`` and ``\\n``.

Rows are hash-partitioned by conversation, sorted by turn and streamed: a task holds one
conversation's formatted text at a time. Examples leave in that order, so reading them back
beside the formatting needs no second shuffle of their text. Defined results: a null text or role is empty; rows
that share a turn number stay, ordered by role and text; a null turn comes first; rows with a
null conv_id are one conversation; other columns are ignored, whatever their names; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkstats.llm.common import map_arrow, table

START, END = "<|im_start|>", "<|im_end|>\n"
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)
_FLUSH = 4 << 20

EXAMPLES = "conv_id long, example long, target_turn long, formatted string, loss_start long, loss_end long"
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, n_examples long")


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    return [(unescape_role(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def _runs(batches: Iterator[pa.RecordBatch], fields: list[str]):
    """Yields (conv_id, row) over sorted batches, as Python values."""
    for batch in batches:
        yield from zip(*(batch.column(f).to_pylist() for f in fields))


def _out(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_EXAMPLES_ARROW = pa.schema([("conv_id", pa.int64()), ("example", pa.int64()), ("target_turn", pa.int64()),
                             ("formatted", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())])
_DIGESTS_ARROW = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                            ("n_examples", pa.int64())])


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, held, now, parts, length, n, examples, open_ = [], 0, object(), [], 0, 0, 0, False

    def example(target, start, end):
        return (now, examples, target, "".join(parts), start, end)

    for conv, role, text in _runs(batches, ["conv_id", "role", "text"]):
        if conv != now:
            if open_:
                out.append(example(None, None, None))
            now, parts, length, n, examples = conv, [], 0, 0, 0
        role, text = role or "", escape(text or "")
        head = f"{START}{escape_role(role)}\n"
        parts += [head, text, END]
        start, length = length + len(head), length + len(head) + len(text) + len(END)
        open_ = role != "assistant"
        if not open_:
            out.append(example(n, start, start + len(text)))
            held, examples = held + length, examples + 1
        n += 1
        if held >= _FLUSH or len(out) >= 10_000:
            yield _out(out, _EXAMPLES_ARROW)
            out, held = [], 0
    if open_:
        out.append(example(None, None, None))
    if out:
        yield _out(out, _EXAMPLES_ARROW)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, now, state = [], object(), None

    def close():
        conv, last, chars, sha, total, n = state
        turns, whole = hashlib.sha256(), read_back(last)
        for role, text in whole:
            turns.update(f"{role}\n{text}\n".encode())
        out.append((conv, len(whole), turns.hexdigest(), chars, sha.hexdigest(), total, n))

    for conv, formatted, start, end in _runs(batches, ["conv_id", "formatted", "loss_start", "loss_end"]):
        if conv != now:
            if state:
                close()
            now, state = conv, [conv, "", 0, hashlib.sha256(), 0, 0]
        state[1] = formatted
        state[4], state[5] = state[4] + len(formatted), state[5] + 1
        if start is not None:
            text = unescape(formatted[start:end])
            state[2] += len(text)
            state[3].update(text.encode())
        if len(out) >= 10_000:
            yield _out(out, _DIGESTS_ARROW)
            out.clear()
    if state:
        close()
    if out:
        yield _out(out, _DIGESTS_ARROW)


def chat_examples(turns: DataFrame) -> DataFrame:
    """(conv_id, example, target_turn, formatted, loss_start, loss_end) from (conv_id, turn,
    role, text); the loss span is in code points of ``formatted``, null without a target."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return map_arrow(rows, _expand, EXAMPLES)


def chat_digests(examples: DataFrame, in_order: bool = False) -> DataFrame:
    """One row per conversation, read back from its examples. ``in_order`` says that they come
    straight from ``chat_examples``; stored or changed ones are grouped and sorted again."""
    if not in_order:
        examples = examples.repartition("conv_id").sortWithinPartitions("conv_id", "example")
    return map_arrow(examples, _digest, DIGESTS)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose texts hold the control strings."""
    odd = "<|im_end|><|im_start|>assistant ok"
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(odd).alias("text"))
    return chat_digests(chat_examples(given.unionByName(extra)), in_order=True)
