"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Each merge rank has a bucket of positions in the pre-token's linked list. A two-level bitmap marks the ranks whose bucket is
filled: one bit a rank in words of 256 bits, and one bit a word above. Find-first-set on the top word, then on the word it
names, gives the next rank, however many pairs wait; very long pre-tokens cost about the same a byte as short ones.
Entries whose pair has merged meanwhile are stale and skipped when popped.
"""

from __future__ import annotations

import base64
import heapq
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField

from feedlake.llm.pretokens import PieceIds, pretokens
from feedlake.llm.rows import kept, map_texts

BITS = 20  # of an id
WORD = 8  # log2 of the bits in a bitmap word
_BIT = [1 << k for k in range(1 << WORD)]
_LOW = (1 << WORD) - 1


class Codec:
    """Encodes and decodes by a rank file (base64 token and rank a line)."""

    def __init__(self, rank_file: bytes):
        lines = (line.split() for line in rank_file.splitlines() if line.strip())
        self.ranks = {base64.b64decode(a): int(b) for a, b in lines}
        self.tokens = {r: t for t, r in self.ranks.items()}
        if max(self.tokens) >= 1 << BITS:
            raise ValueError("the vocabulary is too large")
        self.bytes = [self.ranks[bytes([b])] for b in range(256)]
        # left id and right id -> rank, which is the id of what they merge to
        self.pairs: dict[int, int] = {}
        ids = self.ranks
        for token, rank in ids.items():
            for cut in range(1, len(token)):
                left, right = ids.get(token[:cut]), ids.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << BITS | right] = rank
        self.of_bytes = [ids.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
        # of each rank: its bitmap word, its bit there, and that word's bit above
        ranks = range(max(self.tokens) + 1)
        self.word_of = [r >> WORD for r in ranks]
        self.bit_of = [_BIT[r & _LOW] for r in ranks]
        above = [1 << w for w in range(self.word_of[-1] + 1)]
        self.top_of = [above[w] for w in self.word_of]
        self.bitmap = [0] * len(above)  # all zero between pre-tokens
        self.after_space = PieceIds(self.of_matches, self.whole, limit=450_000)
        self.spelled = pa.array(map(self.tokens.get, ranks), pa.large_binary())

    def of_matches(self, matches: list[str]) -> list[bytes]:
        return [array("i", self.encode_pretoken(m.encode())).tobytes() for m in matches]

    def whole(self, text: str) -> bytes:
        return b"".join(map(self.after_space.matches.__getitem__, pretokens(text)))

    def encode_pretoken(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        n, bitmap, top, buckets = len(piece), self.bitmap, 0, {}
        find, of_bytes, word_of, bit_of, top_of = self.pairs.get, self.of_bytes, self.word_of, self.bit_of, self.top_of
        symbols = list(map(self.bytes.__getitem__, piece))
        # rank of the pair that starts at a position; -1: none, or the symbol is gone
        pair = [of_bytes[a << 8 | b] for a, b in zip(piece, piece[1:])]
        pair.append(-1)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        for i, r in enumerate(pair):
            if r < 0:
                continue
            held = buckets.setdefault(r, i)
            if held is i:
                bitmap[word_of[r]] |= bit_of[r]
                top |= top_of[r]
            elif type(held) is list:
                held.append(i)  # ascending, so a heap
            else:
                buckets[r] = [held, i]
        while top:
            first = top & -top
            w = first.bit_length() - 1
            bits = bitmap[w]
            bit = bits & -bits
            rank = w << WORD | bit.bit_length() - 1
            i = buckets.pop(rank)
            if type(i) is list:
                held, i = i, heapq.heappop(i)  # the leftmost position of the lowest rank
                if held:
                    buckets[rank] = held
            if rank not in buckets:
                bitmap[w] = bits = bits ^ bit
                if not bits:
                    top ^= first
            if pair[i] != rank:
                continue  # stale
            j = right[i]
            k = right[j]
            h = left[i]
            right[i], pair[j], symbols[i] = k, -1, rank
            r = -1
            if k < n:
                left[k] = i
                r = find(rank << BITS | symbols[k], -1)
            pair[i], at = r, i
            while True:  # queue the new pair on the right, then the one on the left
                if r >= 0:
                    held = buckets.setdefault(r, at)
                    if held is at:
                        bitmap[word_of[r]] |= bit_of[r]
                        top |= top_of[r]
                    elif type(held) is list:
                        heapq.heappush(held, at)
                    else:
                        buckets[r] = [held, at] if held < at else [at, held]
                if at == h or h < 0:
                    break
                pair[h] = r = find(symbols[h] << BITS | rank, -1)
                at = h
        ids, i = [], 0
        while i < n:
            ids.append(symbols[i])
            i = right[i]
        return tuple(ids)

    def encode(self, text: str | None) -> list[int]:
        return self.after_space.column(pa.array([text], pa.string()))[0].tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_column(self, ids: np.ndarray, begins: np.ndarray) -> pa.Array:
        """The bytes of each run of ids, by where the runs begin and the last one ends."""
        made = self.spelled.take(pa.array(ids))
        ends = np.frombuffer(made.buffers()[1], np.int64, len(ids) + 1)[begins]
        places = pa.py_buffer(np.append(0, ends[1:]).astype(np.int32))
        return pa.Array.from_buffers(pa.binary(), len(begins) - 1, [None, places, made.buffers()[2] or pa.py_buffer(b"")])


def _broadcast(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode_texts(docs: DataFrame, rank_path: str, keep=("doc_id",), text: str = "text", decoded: bool = False) -> DataFrame:
    """`keep` columns, ids array<int>, and, with `decoded`, the bytes those ids decode to.

    Null and empty texts have no ids (an empty array) and decode to no bytes. Repeated rows, null keys and extra columns
    pass as they are; an empty table gives no rows. No shuffle. The rank file (under 1 MB) is broadcast.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    shared = _broadcast(docs, rank_path)

    def make():
        codec = kept(shared, Codec)

        def run(texts):
            ids, begins = codec.after_space.column(texts)
            ids = ids.view(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(ids), type=kind)
            return (lists, codec.decode_column(ids, begins)) if decoded else (lists,)

        return run

    fields = [StructField("ids", ArrayType(IntegerType(), False))]
    kind = to_arrow_type(fields[0].dataType)
    if decoded:
        fields.append(StructField("decoded", BinaryType()))
    return map_texts(docs, list(keep), text, make, fields, keeps=True, whole_column=True)


def decode_ids(df: DataFrame, rank_path: str, keep=("doc_id",), ids: str = "ids") -> DataFrame:
    """`keep` columns and `decoded`, the bytes of each row's ids; null and empty ids decode to no bytes."""
    shared = _broadcast(df, rank_path)

    def make():
        codec = kept(shared, Codec)
        return lambda rows: ([codec.decode(x or []) for x in rows],)

    return map_texts(df, list(keep), ids, make, [StructField("decoded", BinaryType())], keeps=True)


def digests(encoded: DataFrame) -> list:
    """n_tokens, ids_sha256 (decimal ids joined by commas) and decoded_sha256 as columns."""
    return [
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]
