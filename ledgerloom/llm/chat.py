"""Chat formatting at token level.

Role and text of every turn are escaped and encoded by themselves; three reserved ids beyond
the vocabulary are spliced in between, so no text can produce one:

    TURN role SEP text END          rendered as  ### role: text</turn>\\n

The loss mask covers exactly the text tokens of assistant turns.  It is derived from marks
at the text's first token (+1) and after its last (-1) by a prefix sum over the batch.
Control strings (``###``, ``</turn>`` and the escape character, a backslash) in roles and
texts get a backslash before them, which :func:`unescape` takes away again.

Turns are encoded where they are read.  Only then are they dealt by conversation and
sorted, and assembled as a stream: no conversation is held as a whole.

Null role and null text are empty.  Turns are sorted by turn, null first; rows that repeat a
turn by role, then by their tokens.  Rows with null conv_id form one conversation.  An empty
table gives an empty one.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: fixed value: how byte-level BPE vocabularies of this kind cut text before merging
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
MOST_VOCABULARY_BYTES = 64 << 20

MARKS = ("### ", ": ", "</turn>\n")  # as rendered: TURN, SEP, END
_CONTROL = re.compile(r"\\|###|</turn>")
_ESCAPED = re.compile(r"\\(\\|###|</turn>)")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


class Codec:
    """A byte-level BPE vocabulary; three ids beyond it are reserved."""

    _made: dict[int, Codec] = {}  # per process

    def __init__(self, vocabulary: bytes):
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.encoding = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.turn, self.sep, self.end = range(max(ranks.values()) + 1, max(ranks.values()) + 4)

    @classmethod
    def of(cls, vocabulary: bytes) -> Codec:
        key = hash(vocabulary)
        if key not in cls._made:
            cls._made[key] = cls(vocabulary)
        return cls._made[key]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(escape(t or "")) for t in texts]

    def decode(self, ids: list[int]) -> str:
        """The escaped text of ids without reserved ones."""
        return self.encoding.decode_bytes(ids).decode()


def _vocabulary(spark, path: str):
    """The file's bytes, read on the driver; a vocabulary has a fixed size, checked here."""
    with open(path, "rb") as f:
        data = f.read(MOST_VOCABULARY_BYTES + 1)
    if len(data) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} is too large for a vocabulary")
    return spark.sparkContext.broadcast(data)


def format_turns(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per turn: conv_id, turn_no (from 0), start (its first token's place in the
    conversation), input_ids, loss_mask."""
    data = _vocabulary(turns.sparkSession, vocabulary)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(data.value)
        for batch in batches:
            ids = [pa.array(codec.encode(batch.column(k).to_pylist()), pa.list_(pa.int32())) for k in (2, 3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *ids], ["conv_id", "turn", "role", "role_ids", "text_ids"])

    def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(data.value)
        conv, turn_no, start = (), 0, 0
        for batch in batches:
            if not len(batch):
                continue
            roles, texts = batch.column("role_ids"), batch.column("text_ids")
            n_role, n_text = (np.diff(c.offsets.to_numpy()) for c in (roles, texts))
            ends = np.cumsum(n_role + n_text + 3)
            begins = ends - (n_role + n_text + 3)
            ids = np.empty(ends[-1], np.int32)
            content = begins + n_role + 2
            ids[begins], ids[content - 1], ids[ends - 1] = codec.turn, codec.sep, codec.end
            for column, n, at in ((roles, n_role, begins + 1), (texts, n_text, content)):
                ids[np.repeat(at - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())] = column.flatten().to_numpy()
            marks = np.zeros(ends[-1] + 1, np.int64)
            learn = np.array([r == "assistant" for r in batch.column("role").to_pylist()])
            np.add.at(marks, content[learn], 1)
            np.add.at(marks, (content + n_text)[learn], -1)
            mask = np.cumsum(marks)[:-1].astype(np.int8)
            numbers, places = [], []
            for c, length in zip(batch.column("conv_id").to_pylist(), (ends - begins).tolist()):
                if (c,) != conv:
                    conv, turn_no, start = (c,), 0, 0
                numbers.append(turn_no)
                places.append(start)
                turn_no, start = turn_no + 1, start + length
            offsets = pa.array(np.r_[0, ends], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(numbers, pa.int64()), pa.array(places, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.ListArray.from_arrays(offsets, pa.array(mask))],
                ["conv_id", "turn_no", "start", "input_ids", "loss_mask"])

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit("")).alias("role"), "text")
    rows = rows.mapInArrow(encoded, "conv_id long, turn long, role string, role_ids array<int>, text_ids array<int>")
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text_ids")
            .mapInArrow(assembled, "conv_id long, turn_no long, start long, input_ids array<int>, loss_mask array<byte>"))


def read_back(formatted: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per conversation, from its ids and mask alone: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars."""
    data = _vocabulary(formatted.sparkSession, vocabulary)
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(data.value)
        now: _Conversation | None = None
        for batch in batches:
            done = []
            starts = batch.column("input_ids").offsets.to_numpy()
            starts = starts - starts[0]
            ids, mask = (batch.column(c).flatten().to_numpy() for c in ("input_ids", "loss_mask"))
            seps = np.flatnonzero(ids == codec.sep)  # no role or text can hold one
            if len(seps) != len(batch) or (ids[starts[:-1]] != codec.turn).any() or (ids[starts[1:] - 1] != codec.end).any():
                raise ValueError("a turn lacks its marks")
            for i, conv in enumerate(batch.column("conv_id").to_pylist()):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.result())
                    now = _Conversation(conv, codec)
                turn = slice(starts[i], starts[i + 1])
                now.add(ids[starts[i] + 1:seps[i]], ids[seps[i] + 1:starts[i + 1] - 1], ids[turn][mask[turn] == 1])
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(now.result(), kinds)], names)

    return (formatted.select("conv_id", "turn_no", "input_ids", "loss_mask").repartition("conv_id").sortWithinPartitions("conv_id", "turn_no")
            .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))


class _Conversation:
    def __init__(self, conv, codec: Codec):
        self.conv, self.codec = conv, codec
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, role_ids: np.ndarray, text_ids: np.ndarray, learned_ids: np.ndarray) -> None:
        role, text = (self.codec.decode(x.tolist()) for x in (role_ids, text_ids))
        same = np.array_equal(learned_ids, text_ids)
        learned = unescape(text if same else self.codec.decode(learned_ids.tolist()))
        self.turns += 1
        self.chars += len(role) + len(text) + sum(map(len, MARKS))
        self.all.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
        self.loss.update(learned.encode())
        self.loss_chars += len(learned)

    def result(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars
