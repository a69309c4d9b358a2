"""Packing token sequences by first-fit decreasing.

A document's tokens are cut into full sequences and a rest. Full sequences need no partner.
The rests go to groups by a hash, and each group is packed on its own by first-fit
decreasing: the longest rest first, each into the first sequence with room for it, which a
tournament tree of the room left in every sequence finds in logarithmic time. Tokens never
leave the task that made them; only lengths are shuffled. A group has about ``GROUP_DOCS``
rests, so that the few badly filled sequences at its end weigh little.

The token ids are those of the ``tokenizers`` library for the given vocabulary file, called
with ``add_special_tokens=False``: a special token that a text spells is its one id. Where
the same vocabulary lies beside it as ranks (same name, ``.tiktoken``), texts whose characters
are all below U+0250 are tokenised by ``tiktoken``, which is several times faster; for these
characters both split alike, and without two white-space characters in a row the split
needs no look-ahead. All other texts, and those that spell an added token, go to
``tokenizers``.

Defined cases: a null text is empty and gives just its end token; rows that repeat are
packed once each; null ids are ids like any other; other columns play no part; an empty
table gives an empty result. Texts of any length are cut, not shortened.
"""

from __future__ import annotations

import base64
import math
import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklane.session import settle

CONTEXT = 2048
END_TOKEN = 1
GROUP_DOCS = 8192
#: Very long texts are tokenised in blocks of about so many characters.
BLOCK = 1 << 20
#: Sequence numbers of a group are its number times this plus a count.
GROUP_STRIDE = 1 << 24
#: Full sequences are numbered from here by their place in the table.
FULL_FROM = 1 << 62

PIECE_COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
#: Fixed value: how byte_bpe_50k splits texts in which white space never follows white space.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"

_SPACE = re.compile(r"\s")
_SLOW_TEXT = re.compile(r"[^\x00-ɏ]|\s\s")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokenizer(vocabulary: str) -> Callable[[str], list[int]]:
    """text -> ids, for one task."""
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    exact = Tokenizer.from_file(vocabulary)
    added = [t.content for t in exact.get_added_tokens_decoder().values()]
    ranks_file = os.path.splitext(vocabulary)[0] + ".tiktoken"
    if not os.path.exists(ranks_file):
        return lambda text: exact.encode(text, add_special_tokens=False).ids
    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(
        "ranks", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}
    )

    def encode(text: str) -> list[int]:
        if _SLOW_TEXT.search(text) or any(t in text for t in added):
            return exact.encode(text, add_special_tokens=False).ids
        if len(text) <= BLOCK:
            return fast.encode_ordinary(text)
        ids, start = [], 0
        while start < len(text):
            # no token has white space after its first character
            space = _SPACE.search(text, start + BLOCK)
            end = space.start() if space else len(text)
            ids += fast.encode_ordinary(text[start:end])
            start = end
        return ids

    return encode


def pieces(
    docs: DataFrame, id_col: str, text_col: str, context: int, vocabulary: str | None
) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, seat (its row's number)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(vocabulary or default_vocabulary())
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text, seat in zip(
                batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(),
                strict=True,
            ):
                ids = encode(text.as_py() or "")
                ids.append(END_TOKEN)
                packed = np.array(ids, "<u4")
                for start in range(0, len(packed), context):
                    part = packed[start : start + context]
                    crc = zlib.crc32(part.tobytes())
                    rows.append((doc_id, start, len(part), crc, len(packed), seat))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=[*PIECE_COLUMNS, "seat"],
            )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        # the place of a row in its table: stable for a table that is read from files
        F.monotonically_increasing_id().alias("seat"),
    ).mapInArrow(cut, ", ".join(f"{c} long" for c in (*PIECE_COLUMNS, "seat")))


class RoomTree:
    """A tournament over the room left in sequences: a node knows the most room below it."""

    def __init__(self, context: int, most: int):
        self.leaves = 1 << max(0, most - 1).bit_length()
        self.room = [context] * (2 * self.leaves)

    def place(self, length: int) -> int:
        """Put a piece into the first sequence with room for it; returns its number."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < length:
                at += 1
        number = at - self.leaves
        room[at] -= length
        while at > 1:
            at //= 2
            left, right = room[2 * at], room[2 * at + 1]
            most = left if left > right else right
            if room[at] == most:
                break
            room[at] = most
        return number


def first_fit_decreasing(lengths: np.ndarray, context: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset for each length."""
    tree = RoomTree(context, len(lengths))
    numbers, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        number = tree.place(int(lengths[i]))
        numbers[i] = number
        offsets[i] = context - tree.room[tree.leaves + number] - lengths[i]
    return numbers, offsets


def _in_groups(rests: DataFrame, groups: int, context: int, seed: int) -> DataFrame:
    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "seat"], ascending=[False, True])
        numbers, offsets = first_fit_decreasing(rows["length"].to_numpy(), context)
        base = int(rows["group"].iloc[0]) * GROUP_STRIDE
        return rows.assign(sequence_id=base + numbers, offset=offsets).drop(
            columns=["seat", "group"]
        )

    return (
        rests.withColumn("group", F.pmod(F.xxhash64(F.lit(seed), "seat"), F.lit(groups)))
        .groupBy("group")
        .applyInPandas(
            fill,
            ", ".join(f"{c} long" for c in (*PIECE_COLUMNS, "sequence_id", "offset")),
        )
    )


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    context: int = CONTEXT,
    vocabulary: str | None = None,
    seed: int = 11,
) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    found = settle(pieces(docs, id_col, text_col, context, vocabulary))
    full = F.col("length") == context
    rests = found.where(~full)
    groups = max(1, math.ceil(rests.count() / GROUP_DOCS))
    alone = found.where(full).select(
        *PIECE_COLUMNS,
        (F.lit(FULL_FROM) + F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return _in_groups(rests, groups, context, seed).unionByName(alone)
