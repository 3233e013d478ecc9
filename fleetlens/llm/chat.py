"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, and only its text
trainable. A turn is written as

    ### role
    text
    </turn>

and in role and text a backslash stands before every backslash and control string (``###``, ``</turn>``),
so that a reader gets back exactly what was there.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import map_arrow, small_batches

ASSISTANT = "assistant"
FLUSH_CHARS = 4_000_000
_CONTROL = re.compile(r"\\|###|</turn>")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|n)")
_TURN = re.compile(r"### ((?:[^\\\n]|\\.)*)\n((?:[^\\<#]|\\\\|\\###|\\</turn>|<(?!/turn>)|#(?!##))*+)</turn>\n", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def format_turn(role: str, text: str) -> tuple[str, int]:
    """A written turn and the place of its text in it."""
    head = f"### {escape(role)}".replace("\n", "\\n") + "\n"
    return f"{head}{escape(text)}\n</turn>\n", len(head)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted example."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2][:-1])))
        at = m.end()
    return out


def expand(
    conversations: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per assistant turn: conversation, example, n_turns, text, loss_start, loss_end, last.

    ``text[loss_start:loss_end]`` (code points) is the trainable reply, the rest is context. Turns after the
    last assistant turn, or a conversation without one, give one more row with null loss bounds, so that
    ``last`` rows hold whole conversations. Null roles and texts count as empty; turns of equal number are
    ordered by role and text, null numbers come first; repeated rows are turns of their own; a null
    conversation is one conversation. A task holds one conversation's text and reads turns in order.
    """
    small_batches(conversations.sparkSession)
    rows = conversations.select(
        F.col(conversation).cast("bigint").alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    rows = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    names = [conversation, "example", "n_turns", "text", "loss_start", "loss_end", "last"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_())
    nothing = object()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = []
        size = 0
        now, prefix, turns, example, pending = nothing, "", 0, 0, False

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def finish() -> None:
            """The conversation's last row: the turns after the last reply, or the last reply."""
            if now is nothing:
                return
            if pending or not example:
                out.append([now, example, turns, prefix, None, None, True])
            else:
                out[-1][-1] = True

        for batch in batches:
            for conv, _, who, said in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != now or now is nothing:
                    finish()
                    now, prefix, turns, example, pending = conv, "", 0, 0, False
                written, start = format_turn(who, said)
                start += len(prefix)
                prefix, turns, pending = prefix + written, turns + 1, True
                if who == ASSISTANT:
                    # The last row stays, as the conversation may end with it.
                    if size > FLUSH_CHARS:
                        yield flush()
                        out, size = [], 0
                    end = len(prefix) - len("\n</turn>\n")
                    out.append([now, example, turns, prefix, start, end, False])
                    size += len(prefix)
                    example, pending = example + 1, False
        finish()
        if out:
            yield flush()

    schema = (
        f"`{conversation}` bigint, example bigint, n_turns bigint, text string, "
        "loss_start bigint, loss_end bigint, last boolean"
    )
    return rows.mapInArrow(run, schema)


def digests(examples: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Per conversation, read back from its examples: turns, loss text and sizes.

    formatted_chars is the sum over the conversation's rows.
    """
    rows = examples.select(conversation, "example", "text", "loss_start", "loss_end", "last")

    def back(batch: pa.RecordBatch) -> dict:
        out = {"conv": batch.column(0), "example": batch.column(1), "turns": [], "digest": [], "loss": [], "chars": []}
        for text, start, end, last in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
            out["loss"].append("" if start is None else unescape(text[start:end]))
            out["chars"].append(len(text))
            turns = parse(text) if last else None
            out["turns"].append(len(turns) if last else None)
            joined = "".join(f"{r}\n{t}\n" for r, t in turns) if last else ""
            out["digest"].append(hashlib.sha256(joined.encode()).hexdigest() if last else None)
        return out

    schema = "conv bigint, example bigint, turns bigint, digest string, loss string, chars bigint"
    read = map_arrow(rows, back, schema)
    losses = F.sort_array(F.collect_list(F.struct("example", "loss")))
    loss = F.concat_ws("", F.transform(losses, lambda x: x["loss"]))
    grouped = read.groupBy("conv").agg(
        F.max("turns").alias("n_turns"),
        F.max("digest").alias("turns_sha256"),
        loss.alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    )
    return grouped.select(
        F.col("conv").alias(conversation),
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
