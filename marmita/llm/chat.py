"""Chat formatting with offset-aligned loss masks.

A conversation is rendered with control tokens around each turn, encoded once with character offsets, and the sorted spans of
the assistant's texts meet the sorted spans of the tokens by binary search.  Control strings inside texts are escaped, and the
control tokens are atoms of the tokenizer, so no token reaches over the edge of a text.

A conversation of any length is rendered in segments of at most ``SEGMENT`` characters (or one turn), cut between turns, where the control tokens
make encoding the parts the same as encoding the whole.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, MIDDLE, END, NEWLINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|im_nl|>"
CONTROLS = [START, MIDDLE, END, NEWLINE]
SEGMENT = 200_000
LEARNED = "assistant"

ROWS = "conv_id long, turn long, role string, text string"
SEGMENTS = ("conv_id long, segment long, formatted string, input_ids array<int>, token_starts array<int>, token_ends array<int>, "
            "loss_mask array<byte>")


def escaped(text: str) -> str:
    """No ``<|`` is left: every ``<``, backslashes, ``|`` gets one more backslash, which ``unescaped`` takes away."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted turns, and the spans of the assistant's texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = START + escaped(role).replace("\n", NEWLINE) + MIDDLE
        body = escaped(text)
        if role == LEARNED and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END + "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text: the inverse of ``render``."""
    turns = []
    for block in formatted.split(START)[1:]:
        head, body = block.split(MIDDLE, 1)
        turns.append((unescaped(head.replace(NEWLINE, "\n")), unescaped(body[:-len(END) - 1])))
    return turns


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """1 for each token that lies in a span; token spans and text spans are sorted."""
    if not spans:
        return np.zeros(len(starts), np.int8)
    left, right = np.array(spans).T
    at = np.searchsorted(right, ends, "left")
    inside = np.minimum(at, len(left) - 1)
    return ((at < len(left)) & (left[inside] <= starts) & (ends > starts)).astype(np.int8)


def masked_texts(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> str:
    """The characters under the mask; tokens that share a character count it once."""
    covered = np.zeros(len(formatted) + 1, np.int32)
    chosen = mask.astype(bool)
    np.add.at(covered, starts[chosen], 1)
    np.add.at(covered, ends[chosen], -1)
    on = np.r_[False, np.cumsum(covered)[:-1] > 0, False]
    edges = np.flatnonzero(on[1:] != on[:-1])
    return "".join(unescaped(formatted[a:b]) for a, b in zip(edges[::2], edges[1::2], strict=True))


def tokenizer_with_controls(path: str):
    from tokenizers import AddedToken, Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=True)
    tokenizer.add_special_tokens([AddedToken(c, normalized=False) for c in CONTROLS])
    return tokenizer


def _format(tokenizer_json: str):
    def run(batches):
        tokenizer = None
        last, number, piece, size = None, 0, [], 0

        def segment():
            nonlocal tokenizer
            if tokenizer is None:
                import os

                os.environ["TOKENIZERS_PARALLELISM"] = "false"
                tokenizer = tokenizer_with_controls(tokenizer_json)
            formatted, spans = render(piece)
            encoded = tokenizer.encode(formatted, add_special_tokens=False)
            offsets = np.array(encoded.offsets, np.int32).reshape(-1, 2)
            starts, ends = offsets[:, 0], offsets[:, 1]
            return pa.RecordBatch.from_arrays(
                [pa.array([last], pa.int64()), pa.array([number], pa.int64()), pa.array([formatted]),
                 pa.array([encoded.ids], pa.list_(pa.int32())), pa.array([starts], pa.list_(pa.int32())),
                 pa.array([ends], pa.list_(pa.int32())), pa.array([loss_mask(starts, ends, spans)], pa.list_(pa.int8()))],
                ["conv_id", "segment", "formatted", "input_ids", "token_starts", "token_ends", "loss_mask"])

        begun = False
        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                role, text = role or "", text or ""
                if begun and (conv != last or size + len(text) > SEGMENT):
                    yield segment()
                    number, piece, size = (0 if conv != last else number + 1), [], 0
                last, begun = conv, True
                piece.append((role, text))
                size += len(text)
        if begun:
            yield segment()
    return run


def format_conversations(conversations: DataFrame, tokenizer_json: str) -> DataFrame:
    """(conv_id, segment, formatted, input_ids, token_starts, token_ends, loss_mask) from rows (conv_id, turn, role, text).

    Turns go by turn, null first, then by role and text where turns tie, so repeated rows are turns of their own.  Null roles and texts are empty.  A null
    conv_id is a conversation of its own.  Segments of a conversation number from 0.  No rows give no rows; other columns are ignored.
    The rows of a conversation stream through one task, in memory one segment at a time.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(_format(tokenizer_json), SEGMENTS))


def _read_back(batches):
    last, begun, state = None, False, None

    def row():
        n, turns, chars, loss, formatted = state
        return pa.RecordBatch.from_arrays(
            [pa.array([last], pa.int64()), pa.array([n], pa.int64()), pa.array([turns.hexdigest()]), pa.array([chars], pa.int64()),
             pa.array([loss.hexdigest()]), pa.array([formatted], pa.int64())],
            ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    for batch in batches:
        for i in range(batch.num_rows):
            conv = batch.column("conv_id")[i].as_py()
            if begun and conv != last:
                yield row()
                begun = False
            if not begun:
                last, begun, state = conv, True, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            formatted = batch.column("formatted")[i].as_py()
            starts, ends, mask = (batch.column(c)[i].values.to_numpy() for c in ("token_starts", "token_ends", "loss_mask"))
            for role, text in parse(formatted):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            loss = masked_texts(formatted, starts, ends, mask)
            state[2] += len(loss)
            state[3].update(loss.encode("utf-8", "surrogatepass"))
            state[4] += len(formatted)
    if begun:
        yield row()


def digests(segments: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) read back from formatted segments."""
    narrow = segments.select("conv_id", "segment", "formatted", "token_starts", "token_ends", "loss_mask")
    return (narrow.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
            .mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                    "formatted_chars long"))
