"""Chat formatting: one text per conversation, its tokens, and the mask of what to learn from.

A conversation is rendered whole, encoded once with offsets, and the spans of
its learned texts are met with the token spans by binary search.  A token that
lies partly inside a learned text is kept with the part inside, so the mask
gives those texts exactly, whatever the tokens are.

The template is ``<|turn|>role\\ntext<|end|>\\n`` per turn.  A backslash in a
text or role is doubled and a control string gets one behind its first
character, so no control string occurs but those of the template; in roles a
line feed gets one before it.  ``unescape`` drops each backslash and keeps
what it stands before.

Null texts and roles are empty.  Rows of one conversation go by turn (null
first), then role and text; repeated rows are turns like others.  Rows without
a conversation id form one conversation.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from wayfare.llm import flat

TURN, END = "<|turn|>", "<|end|>"

#: Strings that a text must not smuggle in: those of this template and of common models.  Fixed values.
CONTROL = (TURN, END, "<|endoftext|>", "<|startoftext|>", "<|im_start|>", "<|im_end|>", "<s>", "</s>", "<unk>", "<pad>",
           "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

#: Roles whose texts are learned.
LEARNED = ("assistant",)

#: Pattern of what an escape goes to.
RISKY = "|".join(["\\\\", *map(re.escape, sorted(CONTROL, key=len, reverse=True))])
_RISKY = re.compile(RISKY)
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(re.escape(TURN) + r"((?:[^\\\n]|\\.)*)\n(.*?)" + re.escape(END) + "\n", re.S)

PARTS = T.StructType([
    T.StructField("formatted", T.StringType(), False),
    T.StructField("token_ids", T.ArrayType(T.IntegerType(), False), False),
    T.StructField("token_learned", T.ArrayType(T.BooleanType(), False), False),
    T.StructField("learned_spans", T.ArrayType(T.IntegerType(), False), False),
])


def escape(text: str) -> str:
    """The text without any control string."""
    return _RISKY.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


#: Text that is rendered and encoded together, and what a turn counts besides its text.
PIECE_BYTES, TURN_BYTES = 1 << 16, 64


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and where the learned texts are in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = TURN + escape(role).replace("\n", "\\\n") + "\n"
        body = escape(text)
        at += len(head)
        if role in LEARNED and body:
            spans.append((at, at + len(body)))
        at += len(body) + len(END) + 1
        parts += [head, body, END, "\n"]
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts read back."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def meet(spans: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens (start and end, in order) overlap a span, and the parts of the spans that tokens cover, in order.

    Tokens of one character's bytes share its place; what they cover counts once.
    """
    learned = np.zeros(len(tokens), bool)
    if not len(spans) or not len(tokens):
        return learned, np.zeros((0, 2), np.int64)
    span = np.searchsorted(spans[:, 1], tokens[:, 0], "right")  # the first span that ends behind the token's start
    inside = np.minimum(span, len(spans) - 1)
    learned = (span < len(spans)) & (spans[inside, 0] < tokens[:, 1]) & (tokens[:, 0] < tokens[:, 1])
    # a token may reach over several short spans
    last = np.searchsorted(spans[:, 0], tokens[:, 1], "left") - 1
    count = np.where(learned, last - span + 1, 0)
    token = np.repeat(np.arange(len(tokens)), count)
    number = np.repeat(span, count) + (np.arange(len(token)) - np.repeat(np.cumsum(count) - count, count))
    start = np.maximum(tokens[token, 0], spans[number, 0])
    end = np.minimum(tokens[token, 1], spans[number, 1])
    before = np.maximum.accumulate(np.concatenate(([0], end)))[:-1]
    start = np.maximum(start, before)
    fresh = start < end
    return learned, np.stack([start[fresh], end[fresh]], axis=1)


def _joined(parts: np.ndarray) -> np.ndarray:
    """Parts that touch become one, but not across the border of two learned texts: there the template lies between."""
    if not len(parts):
        return parts
    opens = np.ones(len(parts), bool)
    opens[1:] = parts[1:, 0] != parts[:-1, 1]
    closes = np.append(opens[1:], True)
    return np.stack([parts[opens, 0], parts[closes, 1]], axis=1)


def format_conversations(
    conversations: DataFrame, tokenizer: str, *, key: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", out: str = "chat",
) -> DataFrame:
    """One row per conversation: its id and the struct ``out`` of text, token ids, token mask and learned spans.

    ``tokenizer`` is a file of the tokenizers library on the driver; tasks get
    its content.
    """
    with open(tokenizer, encoding="utf-8") as file:
        content = file.read()
    rows = conversations.select(
        F.col(key).alias("_key"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
                 F.coalesce(text, F.lit("")).alias("text")).alias("_turn"),
    )
    # One conversation is one training text; nothing smaller can be encoded or hashed as a whole.
    whole = rows.groupBy("_key").agg(F.array_sort(F.collect_list("_turn")).alias("_turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_str(content)
        encoder.encode_special_tokens = True
        for batch in batches:
            for part in _pieces(batch):
                rendered = [render([(t["role"], t["text"]) for t in turns]) for turns in part.column("_turns").to_pylist()]
                encoded = encoder.encode_batch([x for x, _ in rendered], add_special_tokens=False)
                ids, masks, kept = [], [], []
                for (_, spans), tokens in zip(rendered, encoded):
                    offsets = np.array(tokens.offsets, np.int64).reshape(-1, 2)
                    learned, parts = meet(np.array(spans, np.int64).reshape(-1, 2), offsets)
                    ids.append(np.array(tokens.ids, np.int32))
                    masks.append(learned)
                    kept.append(_joined(parts).ravel().astype(np.int32))
                columns = [pa.array([x for x, _ in rendered], pa.string()), *map(_lists, (ids, masks, kept))]
                yield pa.record_batch(
                    [part.column("_key"), pa.StructArray.from_arrays(columns, fields=list(_PARTS))], names=[key, out])

    schema = T.StructType([T.StructField(key, conversations.schema[key].dataType), T.StructField(out, PARTS, False)])
    return whole.mapInArrow(run, schema)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    """One list for each row of numbers."""
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    values = pa.array(np.concatenate(rows))
    kind = pa.list_(pa.field("element", values.type, False))
    return pa.ListArray.from_arrays(pa.array(offsets), values, type=kind)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows in pieces of so many characters and turns at most; one longer conversation is a piece of its own."""
    turns = batch.column("_turns")
    sizes = [pc.fill_null(pc.binary_length(turns.flatten().field(c)), 0).to_numpy(zero_copy_only=False) for c in ("role", "text")]
    total = np.concatenate(([0], np.cumsum(sizes[0] + sizes[1] + TURN_BYTES)))
    offsets = turns.offsets.to_numpy()
    ends = total[offsets[1:] - offsets[0]]
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + PIECE_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


_PARTS = pa.struct([
    pa.field("formatted", pa.string(), False),
    pa.field("token_ids", pa.list_(pa.field("element", pa.int32(), False)), False),
    pa.field("token_learned", pa.list_(pa.field("element", pa.bool_(), False)), False),
    pa.field("learned_spans", pa.list_(pa.field("element", pa.int32(), False)), False),
])


def read_back(formatted: DataFrame, key: str = "conv_id", chat: str = "chat") -> DataFrame:
    """What the formatted rows hold: number and digest of the turns, number and digest of what the mask keeps."""
    import hashlib

    field = formatted.schema[key]
    schema = T.StructType([
        field, T.StructField("n_turns", T.LongType(), False), T.StructField("turns_sha256", T.StringType(), False),
        T.StructField("loss_chars", T.LongType(), False), T.StructField("loss_sha256", T.StringType(), False),
        T.StructField("formatted_chars", T.LongType(), False), T.StructField("n_tokens", T.LongType(), False),
        T.StructField("n_learned_tokens", T.LongType(), False),
    ])

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(chat)
            whole = pa.record_batch(
                [batch.column(key), *(parts.field(c) for c in ("formatted", "learned_spans", "token_ids", "token_learned"))],
                names=["key", "formatted", "spans", "ids", "learned"])
            for rows in flat.chunks(iter([whole]), "formatted", PIECE_BYTES):
                out = []
                for one, spans in zip(rows.column("formatted").to_pylist(), rows.column("spans").to_pylist()):
                    turns = parse(one)
                    loss = "".join(unescape(one[a:b]) for a, b in zip(spans[::2], spans[1::2]))
                    out.append((len(turns), digest("".join(f"{role}\n{text}\n" for role, text in turns)), len(loss),
                                digest(loss), len(one)))
                learned = rows.column("learned")
                met = np.concatenate(([0], np.cumsum(learned.flatten().to_numpy(zero_copy_only=False))))
                at = learned.offsets.to_numpy()
                types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.record_batch(
                    [rows.column("key"), *(pa.array(c, t) for c, t in zip(zip(*out), types)),
                     pc.list_value_length(rows.column("ids")).cast(pa.int64()),
                     pa.array(np.diff(met[at - at[0]]).astype(np.int64))], names=schema.names)

    return formatted.mapInArrow(run, schema)
