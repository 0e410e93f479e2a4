"""Chat formatting at token level.

A turn is <|im_start|> role <|im_sep|> text <|im_end|>. Role and text are
encoded segment by segment and the template's ids, which lie beyond the
vocabulary, are spliced between them; the loss mask is the running sum of +1
where an assistant's text begins and -1 where it ends. A control string inside
a role or text is broken up by a backslash after its first character, and
backslashes are doubled, so that the rendered text has control strings only
where the template put them and the content can be read back exactly.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Strings that templates use to steer a model, the first three being this template's.
CONTROLS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TURN, SEP, END = range(3)
_CONTROL = re.compile("|".join(re.escape(x) for x in CONTROLS))
SEGMENTS = "conv_id long, turn long, role string, input_ids array<int>, loss_mask array<int>"


def escaped(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


@lru_cache(maxsize=2)
def codec(ranks_path: str):
    """(encode, ids -> bytes, first reserved id) of a byte-level vocabulary given as ranks."""
    import tiktoken
    from public_tokenizers import PATTERN

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    coder = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return coder.encode_ordinary, coder.decode_bytes, len(ranks) + 1  # one more: end of text


def assembled(role: str, text: str, encode, reserved: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, loss mask) of one turn."""
    segments = [[reserved + TURN], encode(escaped(role)), [reserved + SEP], encode(escaped(text)), [reserved + END]]
    ends = np.cumsum([len(s) for s in segments])
    edges = np.zeros(ends[-1] + 1, np.int32)
    if role == "assistant":
        np.add.at(edges, ends[2:4], (1, -1))
    return np.concatenate([np.array(s, np.int32) for s in segments]), np.cumsum(edges[:-1]).astype(np.int32)


def segments(conversations: DataFrame, ranks_path: str) -> DataFrame:
    """Rows (conv_id, turn, role, text) -> their token segments; a conversation is its segments in order of turn.

    Null text and role count as empty. Rows of one turn are ordered by role and
    text; repeated rows are repeated turns. A null conv_id is a conversation,
    a null turn comes first. Other columns are not read.
    """
    plain = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, _, reserved = codec(ranks_path)
        for batch in batches:
            for piece in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                made = [assembled(r, t, encode, reserved) for r, t in zip(piece.column("role").to_pylist(), piece.column("text").to_pylist(), strict=True)]
                at = pa.array(np.append(0, np.cumsum([len(i) for i, _ in made])), pa.int32())
                ids, mask = (pa.ListArray.from_arrays(at, pa.array(np.concatenate([m[j] for m in made]), pa.int32())) for j in (0, 1))
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in ("conv_id", "turn", "role")), ids, mask], ["conv_id", "turn", "role", "input_ids", "loss_mask"])

    return plain.repartition(F.col("conv_id"), F.col("turn"), F.col("text")).mapInArrow(build, SEGMENTS)


class _Digest:
    """Running digests of one conversation: memory doesn't grow with its turns."""

    def __init__(self):
        self.turns, self.loss, self.n_turns, self.loss_chars, self.formatted_chars, self.n_tokens = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0

    def add(self, ids: np.ndarray, mask: np.ndarray, to_bytes, reserved: int) -> None:
        marks = np.flatnonzero(ids >= reserved)
        if [int(ids[i]) - reserved for i in marks] != [TURN, SEP, END] or marks[0] != 0 or marks[2] != len(ids) - 1:
            raise ValueError("not a turn of this template")
        role, text = (to_bytes(ids[a + 1 : z].tolist()).decode() for a, z in ((marks[0], marks[1]), (marks[1], marks[2])))
        under = unescaped(to_bytes(ids[mask == 1].tolist()).decode())
        self.n_turns += 1
        self.turns.update(f"{unescaped(role)}\n{unescaped(text)}\n".encode())
        self.loss.update(under.encode())
        self.loss_chars += len(under)
        self.formatted_chars += len(role) + len(text) + sum(len(CONTROLS[i]) for i in (TURN, SEP, END))
        self.n_tokens += len(ids)

    def row(self, conv_id) -> tuple:
        return conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars, self.n_tokens


def read_back(turns: DataFrame, ranks_path: str) -> DataFrame:
    """Segments -> conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens, from the ids and masks alone."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, to_bytes, reserved = codec(ranks_path)
        now, state, done = object(), None, []
        for batch in batches:
            ids, mask = batch.column("input_ids"), batch.column("loss_mask")
            at = ids.offsets.to_numpy()
            ids, mask = ids.values.to_numpy(), mask.values.to_numpy()[mask.offsets[0].as_py() - int(at[0]) :]
            for conv, a, z in zip(batch.column("conv_id").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                if conv != now:
                    if state:
                        done.append(state.row(now))
                    now, state = conv, _Digest()
                state.add(ids[a:z], mask[a:z], to_bytes, reserved)
            if len(done) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names)
                done = []
        if state:
            done.append(state.row(now))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names)

    content = F.xxhash64("input_ids")
    ordered = turns.withColumn("tie", content).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "tie").drop("tie")
    return ordered.mapInArrow(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long")


def packed(turns: DataFrame) -> DataFrame:
    """Segments -> one row (conv_id, input_ids, loss_mask) for each conversation, as a trainer reads it."""
    parts = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.xxhash64("input_ids").alias("tie"), "input_ids", "loss_mask"))).alias("p"))
    return parts.select("conv_id", F.flatten(F.transform("p", lambda x: x["input_ids"])).alias("input_ids"), F.flatten(F.transform("p", lambda x: x["loss_mask"])).alias("loss_mask"))


def _sql_escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for c in CONTROLS:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


ORACLE_SQL = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role) AS turns,
  coalesce(string_agg(text, '' ORDER BY turn, role) FILTER (WHERE role = 'assistant'), '') AS loss,
  sum(length({_sql_escaped("role")}) + length({_sql_escaped("text")}) + {sum(len(CONTROLS[i]) for i in (TURN, SEP, END))}) AS formatted_chars FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars FROM g
"""
