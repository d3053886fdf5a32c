"""Token counts by heap-and-linked-list byte-pair merging.

A pre-token starts as one symbol a byte, linked left and right. A heap holds (rank, position) of adjacent pairs; the lowest
rank (leftmost on ties) is popped, stale entries are skipped, the pair merges and its new neighbours are pushed. The count
is symbols minus merges; no id is looked up or emitted. n bytes cost O(n log n), so a megabyte without spaces is fine.
"""

from __future__ import annotations

import heapq
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from feedlake.llm.pretokens import chunks, pretokens
from feedlake.llm.rows import BoundedCache, kept, map_texts


BITS = 20  # of a symbol number
MASK, POSITION = (1 << BITS) - 1, (1 << 40) - 1


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte in byte-level vocabularies: printable Latin-1 bytes stand for themselves, the
    others take the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class MergeCounter:
    """Counts tokens of a text as the library does for a byte-level BPE tokenizer file (the JSON's bytes)."""

    def __init__(self, vocabulary: bytes):
        spec = json.loads(vocabulary)
        if spec["model"]["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["normalizer"]:
            raise ValueError("a byte-level BPE tokenizer without normalizer is needed")
        to_byte = byte_alphabet()
        symbols = {bytes([b]): b for b in range(256)}  # symbol numbers, for the merge table only
        self.merges: dict[int, int] = {}  # left symbol and right symbol -> rank and merged symbol
        for rank, m in enumerate(spec["model"]["merges"]):
            x, y = (bytes(to_byte[c] for c in part) for part in (m.split(" ") if isinstance(m, str) else m))
            merged = symbols.setdefault(x + y, len(symbols))
            self.merges.setdefault(symbols[x] << BITS | symbols[y], rank << BITS | merged)
        if len(symbols) > 1 << BITS:
            raise ValueError("the vocabulary is too large")
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.words = BoundedCache(lambda w: self.merge_count(w.encode()))
        self.after_space = BoundedCache(lambda piece: self.segment(" " + piece))

    def merge_count(self, piece: bytes) -> int:
        n = len(piece)
        if n < 2:
            return n
        find = self.merges.get
        symbols = list(piece)  # -1: merged into the one on its left
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []  # rank, then position
        for i in range(n - 1):
            m = find(symbols[i] << BITS | symbols[i + 1])
            if m is not None:
                heap.append(m >> BITS << 40 | i)
        heapq.heapify(heap)
        pop, push, merges = heapq.heappop, heapq.heappush, 0
        while heap:
            top = pop(heap)
            i = top & POSITION
            a, j = symbols[i], right[i]
            if a < 0 or j == n:
                continue  # stale: merged away, or now the last symbol
            m = find(a << BITS | symbols[j])
            if m is None or m >> BITS != top >> 40:
                continue  # stale: a side has grown since
            symbols[i] = a = m & MASK
            symbols[j] = -1
            merges += 1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                m = find(a << BITS | symbols[k])
                if m is not None:
                    push(heap, m >> BITS << 40 | i)
            h = left[i]
            if h >= 0:
                m = find(symbols[h] << BITS | a)
                if m is not None:
                    push(heap, m >> BITS << 40 | h)
        return n - merges

    def segment(self, text: str) -> int:
        """Tokens of a text; each special string counts one and cuts the text, as by the library's default."""
        if self.special is None or not self.special.search(text):
            return sum(map(self.words.__getitem__, pretokens(text)))
        plain = sum(sum(map(self.words.__getitem__, pretokens(s))) for s in self.special.split(text))
        return plain + sum(1 for _ in self.special.finditer(text))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        pieces = chunks(text)
        if pieces is None:
            return self.segment(text)
        return self.segment(pieces[0]) + sum(map(self.after_space.__getitem__, pieces[1:]))


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens, over_limit for every row.

    Null and empty texts count 0 bytes and 0 tokens. Repeated rows give repeated rows, null ids stay null, an empty table
    gives no rows, and columns other than the two named are ignored. No shuffle: each row is counted where it is read.
    The vocabulary file (1 to 2 MB, whatever the data) is read by the driver and broadcast.
    """
    with open(vocabulary_path, "rb") as f:
        data = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(data)

    def make():
        counter = kept(shared, MergeCounter)

        def run(texts):
            n_bytes = [len(t.encode()) if t else 0 for t in texts]
            return n_bytes, [counter.count(t) for t in texts]

        return run

    out = map_texts(docs, [id_col], text, make, [StructField("n_bytes", LongType()), StructField("n_tokens", LongType())], keeps=True)
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
