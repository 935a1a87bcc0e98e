"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with character offsets, and the token spans are intersected with the
turns' spans by binary search (both are sorted). The template's marks are added tokens of the tokenizer, so no other token
ever crosses a mark; control strings inside a text are escaped with a backslash-like sign and unescaped on reading back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewkit.session import ship_package

#: The template: a mark, the role, a mark, the text, a mark for every turn.
OPEN, MIDDLE, CLOSE = "<|turn|>", "<|says|>", "<|end|>"
MARKS = (OPEN, MIDDLE, CLOSE)
#: Strings that may not stand in a text unescaped: the marks and other formats' controls.
CONTROLS = (*MARKS, "<|endoftext|>", "<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: Put after the first character of a control string; doubled where a text has it itself.
ESCAPE = "␛"
LOSS_ROLE = "assistant"
#: Characters rendered, encoded and returned at once, about (a single longer conversation is one piece). A character
#: takes about 70 bytes while its tokens' spans are looked up, so an Arrow batch of whole conversations is too much.
CALL_CHARS = 500_000

_ESCAPED = re.compile("|".join([ESCAPE, *map(re.escape, CONTROLS)]))
_READ = re.compile(re.escape(OPEN) + "(.*?)" + re.escape(MIDDLE) + "(.*?)" + re.escape(CLOSE), re.S)


def escape(text: str) -> str:
    """No control string is left: each gets the escape sign after its first character, the sign itself is doubled."""
    return _ESCAPED.sub(lambda m: ESCAPE * 2 if m[0] == ESCAPE else m[0][0] + ESCAPE + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(ESCAPE + "(" + ESCAPE + "?)", r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, str]]]:
    """The conversation's text, and (begin, end, role) of every turn's escaped text in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role) + MIDDLE, escape(text)
        spans.append((at + len(head), at + len(head) + len(body), role))
        out += (head, body, CLOSE)
        at = spans[-1][1] + len(CLOSE)
    return "".join(out), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(r), unescape(t)) for r, t in _READ.findall(formatted)]


def loss_mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which tokens overlap a span: for each token the last span that begins before its end, by binary search.

    ``offsets`` and ``spans`` are sorted rows (begin, end); empty tokens and spans overlap nothing.
    """
    if not len(offsets) or not len(spans):
        return np.zeros(len(offsets), bool)
    at = np.searchsorted(spans[:, 0], offsets[:, 1], side="left") - 1
    return (at >= 0) & (np.minimum(offsets[:, 1], spans[at, 1]) > np.maximum(offsets[:, 0], spans[at, 0]))


def masked_spans(offsets: np.ndarray, mask: np.ndarray) -> list[list[int]]:
    """Character ranges under the mask, touching or overlapping tokens merged."""
    out: list[list[int]] = []
    for a, b in offsets[mask].tolist():
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """The byte-level tokenizer at ``path`` with the marks added; offsets keep leading spaces."""
    from tokenizers import AddedToken, Tokenizer, processors

    t = Tokenizer.from_file(path)
    t.post_processor = processors.ByteLevel(trim_offsets=False)
    t.add_special_tokens([AddedToken(m, normalized=False) for m in MARKS])
    return t


RESULT = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("formatted", pa.string()),
    ("n_tokens", pa.int64()), ("n_loss_tokens", pa.int64()), ("input_ids", pa.list_(pa.int32())),
    ("loss_mask", pa.list_(pa.bool_()))])


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _format(ids: list, conversations: list[list[tuple[str, str]]], path: str) -> pa.Table:
    rendered = [render(turns) for turns in conversations]
    encoded = tokenizer(path).encode_batch([text for text, _ in rendered], add_special_tokens=False)[::-1]
    out: dict[str, list] = {k: [] for k in RESULT.names}
    for conv, (text, spans) in zip(ids, rendered):
        e = encoded.pop()
        offsets, tokens = np.array(e.offsets, np.int64).reshape(-1, 2), np.array(e.ids, np.int32)
        del e
        wanted = np.array([(a, b) for a, b, role in spans if role == LOSS_ROLE and a < b], np.int64).reshape(-1, 2)
        mask = loss_mask(offsets, wanted)
        # Every digest is read back from the formatted text and the mask.
        turns = read_back(text)
        loss = unescape("".join(text[a:b] for a, b in masked_spans(offsets, mask)))
        row = (conv, len(turns), _sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), _sha(loss), len(text), text,
               len(tokens), int(mask.sum()), tokens, mask)
        for k, v in zip(RESULT.names, row):
            out[k].append(v)
    return pa.Table.from_pydict(out, schema=RESULT)


def _formatted(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Batches of (conv_id, turns), formatted some conversations at a time: what a task holds does not follow the batch's size."""
    for b in batches:
        ids, held, size = [], [], 0
        for conv, turns in zip(b.column(0), b.column(1)):
            ids.append(conv.as_py())
            held.append([(t["role"], t["text"]) for t in turns.as_py()])
            size += sum(len(role) + len(text) for role, text in held[-1])
            if size >= CALL_CHARS:
                yield from _format(ids, held, path).to_batches()
                ids, held, size = [], [], 0
        if held:
            yield from _format(ids, held, path).to_batches()


def format_chats(conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    """Every conversation as one training text, its tokens and its loss mask over the assistant's texts.

    ``conversations`` needs ``conv_id``, ``turn``, ``role`` and ``text``; turns are ordered by ``turn`` (nulls first; ties by
    role, then text). Returns one row per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, formatted, n_tokens, n_loss_tokens, input_ids, loss_mask.

    A null text or role is empty (an empty role is no assistant). Rows without conv_id form one conversation. Repeated
    rows are turns of their own; extra columns are ignored; an empty table gives an empty result. ``tokenizer_path`` is a
    byte-level tokenizer file that every executor has.

    Scale: one shuffle by conversation. A conversation is one training text and so is rendered in one task, which holds
    some conversations at a time.
    """
    ship_package(conversations.sparkSession)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    grouped = conversations.select(
        F.col("conv_id").cast("long"), F.struct(F.col("turn").cast("long").alias("turn"), text("role").alias("role"),
                                                text("text").alias("text")).alias("t"))
    grouped = grouped.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    return grouped.mapInArrow(
        lambda batches: _formatted(batches, tokenizer_path),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "formatted string, n_tokens long, n_loss_tokens long, input_ids array<int>, loss_mask array<boolean>")
