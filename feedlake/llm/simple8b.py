"""Token-id files in Simple-8b: word-aligned coding of ids, written and read through Spark.

Words. Each 64-bit word has a selector in its top 4 bits and ids in the other 60. Selectors 2 to 15 pack 60, 30, 20, 15, 12,
10, 8, 7, 6, 5, 4, 3, 2 or 1 ids of 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30 or 60 bits, the first id lowest. An id of 2**60
or more is an escape of two words: selector 0 carries its high 32 bits and no id, selector 1 the low 32 bits.

Files. A dataset is a folder of Parquet files, one row a block, blocks in ascending document order (file number, then `seq`). A
block holds whole documents: `file`, `seq`, `first_id` (ids before it in its file), `doc_ids`, `doc_lens`, `n_ids`, `words`
(little-endian 64-bit words) and `offsets` (the word at which each run of SUB_BLOCK ids starts, so a reader can decode any
run alone; a word never crosses a run). A file's own start is the sum of `n_ids` over the files before it.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from codecs import charmap_decode

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlake.llm.pretokens import PieceIds
from feedlake.llm.rows import kept, map_arrow, parts, quoted

#: Ids in a word and bits of each, for selectors 2 to 15.
COUNTS = [60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1]
WIDTHS = [1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60]
SUB_BLOCK = 4096
BLOCK_IDS = 1 << 18
_ESCAPE = np.uint64(1) << np.uint64(60)
_LOW32 = np.uint64(0xFFFFFFFF)
_S60 = np.uint64(60)

#: The characters that byte-level vocabularies write for bytes: visible Latin-1 as it is, the others from 256 on.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
BYTE_CHARACTERS = "".join(chr(256 + _HIDDEN.index(b)) if b in _HIDDEN else chr(b) for b in range(256))
#: Characters that every version of the Unicode tables since 5.0 puts in the same class: Latin, Cyrillic, kana, Han, Hangul.
_PLAIN = r"\t-\r!-~\u00a1-\u00ac\u00ae-\u024f\u0400-\u0481\u048a-\u04ff\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
_plain, _all_plain = re.compile(f"[{_PLAIN}]+").fullmatch, re.compile(f"[ {_PLAIN}]+").fullmatch


def pack(ids: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """uint64 words and the word offset of each sub-block."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.uint64), []
    select = np.full(n, 15, np.uint8)
    select[ids >= _ESCAPE] = 1
    small = ids.astype(np.uint32) if ids.max() <= _LOW32 else ids
    for s in range(12, -1, -1):  # widest first; narrower words that fit replace them
        count = COUNTS[s]
        if count > n:
            break
        fits, reach = small < small.dtype.type(1 << WIDTHS[s]), 1  # 30 bits at most
        while reach < count:  # until `fits` tells of each id whether it and the next count - 1 all fit
            more = min(reach, count - reach)
            fits[:-more] &= fits[more:]
            reach += more
        fits[n - count + 1 :] = False
        if not fits.any():
            break  # no word of this width, so none of a narrower one, which holds more ids
        for k in range(1, count):  # a word stays in its sub-block
            fits[SUB_BLOCK - k :: SUB_BLOCK] = False
        np.putmask(select, fits, s + 2)
    starts, i, steps = [], 0, np.array([1, 1, *COUNTS], np.uint8)[select].tobytes()
    while i < n:
        starts.append(i)
        i += steps[i]
    starts = np.fromiter(starts, np.int64, len(starts))
    chosen = select[starts]
    size = 1 + (chosen == 1)
    place = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint64)
    for s in np.flatnonzero(np.bincount(chosen)).tolist():
        where, first = place[chosen == s], starts[chosen == s]
        if s == 1:
            out[where] = ids[first] >> np.uint64(32)
            out[where + 1] = (np.uint64(1) << _S60) | (ids[first] & _LOW32)
            continue
        word = np.full(len(first), np.uint64(s) << _S60, np.uint64)
        for k in range(COUNTS[s - 2]):
            word |= ids[first + k] << np.uint64(k * WIDTHS[s - 2])
        out[where] = word
    return out, place[np.searchsorted(starts, np.arange(0, n, SUB_BLOCK))].tolist()


def unpack(words: np.ndarray) -> np.ndarray:
    """All ids of some words (whole words from a sub-block's offset on), vectorised by selector."""
    words = np.asarray(words, np.uint64)
    select = (words >> _S60).astype(np.int64)
    count = np.array([0, 1, *COUNTS])[select]
    place = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint64)
    for s in np.unique(select):
        if s == 0:
            continue
        at = np.flatnonzero(select == s)
        if s == 1:
            out[place[at]] = ((words[at - 1] & _LOW32) << np.uint64(32)) | (words[at] & _LOW32)
            continue
        width = WIDTHS[s - 2]
        mask = np.uint64((1 << width) - 1)
        for k in range(COUNTS[s - 2]):
            out[place[at] + k] = (words[at] >> np.uint64(k * width)) & mask
    return out


class LibraryIds:
    """Ids of whole texts from the tokenizers library.

    A byte-level tokenizer without normalizer or post-processor gets a text in pieces between spaces, each asked for once
    and kept a while: pieces of plain characters go match by match to the library's model, others to its encode. Texts with white-space
    runs or an added token's string, and all texts of other tokenizers, are encoded whole.
    """

    def __init__(self, vocabulary: bytes):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_str(vocabulary.decode())
        self.model = self.tokenizer.model
        spec = json.loads(vocabulary)
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        cut = spec.get("pre_tokenizer") or {}
        self.apart = (
            cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
            and not spec.get("normalizer") and not spec.get("post_processor") and not spec.get("truncation")
            and not spec.get("padding")
        )
        if self.apart:  # the model with another cut, and of each id whether its token begins with a space
            self.marked = Tokenizer(self.model)
            self.marked.pre_tokenizer = CharDelimiterSplit(BYTE_CHARACTERS[0])
            vocabulary = self.tokenizer.get_vocab()
            self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
            self.spaced[[i for t, i in vocabulary.items() if t.startswith(BYTE_CHARACTERS[32])]] = True
        self.pieces = PieceIds(self.of_matches, self.whole, self.refused, self.added, limit=250_000)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def refused(self, pieces: list[str]) -> set[str]:
        return set() if _all_plain(" ".join(pieces)) else {p for p in pieces if p and not _plain(p)}

    def of_matches(self, matches: list[str]) -> list[bytes]:
        """The model's ids of each match; plain characters leave the zero byte free as a mark between matches."""
        characters = charmap_decode("\0".join(matches).encode(), "strict", BYTE_CHARACTERS)[0]
        if len(matches) > 1:  # of many words with a space in front, each begins with the one token that holds its space
            found = np.array(self.marked.encode_batch_fast([characters], add_special_tokens=False)[0].ids, np.uint32)
            begins = np.flatnonzero(self.spaced[found]).tolist()
            if len(begins) == len(matches) and not begins[0]:
                data = found.tobytes()
                return [data[4 * a : 4 * b] for a, b in zip(begins, begins[1:] + [len(found)])]
        tokenize = self.model.tokenize
        return [array("I", [t.id for t in tokenize(c)]).tobytes() for c in characters.split(BYTE_CHARACTERS[0])[: len(matches)]]

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's begin, with the end of the last."""
        if self.apart:
            return self.pieces.column(texts)
        made = [self.whole(t) if t else b"" for t in texts.to_pylist()]
        return np.frombuffer(b"".join(made), np.uint32), np.cumsum([0, *map(len, made)]) // 4

    def ids(self, text: str | None) -> np.ndarray:
        return self.column(pa.array([text], pa.string()))[0]


BLOCK_SCHEMA = (
    "file int, seq int, first_id bigint, n_ids bigint, doc_ids array<bigint>, doc_lens array<bigint>,"
    " offsets array<int>, words binary"
)


def write_ids(
    docs: DataFrame, path: str, vocabulary_path: str, end_id: int = 0, id_col: str = "doc_id", text: str = "text"
) -> str:
    """Encode every text, append `end_id`, and write the ids in ascending document order below `path` (a new folder).

    Order: id (nulls first), then a hash of the text, so repeated ids have a fixed order and copies are dealt apart by
    text. Null and empty texts write the end id alone; an empty table writes no block. Other columns are not read.
    One range shuffle of the texts; a task holds one block and the texts of one slice.
    """
    with open(vocabulary_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        library, file = kept(shared, LibraryIds), TaskContext.get().partitionId()
        seq, first, held, names, size = 0, 0, [], [], 0

        def block():
            nonlocal seq, first, size
            flat = np.concatenate(held)
            packed, offsets = pack(flat)
            row = {
                "file": file, "seq": seq, "first_id": first, "n_ids": len(flat), "doc_ids": list(names),
                "doc_lens": [len(x) for x in held], "offsets": offsets, "words": packed.astype("<u8").tobytes(),
            }
            seq, first, size = seq + 1, first + len(flat), 0
            held.clear()
            names.clear()
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in batches:
            for part in parts(batch, 1):
                flat, at_doc = library.column(part.column(1))
                for name, start, end in zip(part.column(0).to_pylist(), at_doc.tolist(), at_doc[1:].tolist()):
                    held.append(np.append(flat[start:end], np.uint32(end_id)))
                    names.append(name)
                    size += len(held[-1])
                    if size >= BLOCK_IDS:
                        yield block()
        if held:
            yield block()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(BLOCK_SCHEMA))
    picked = docs.select(F.col(quoted(id_col)).cast("bigint").alias("id"), F.col(quoted(text)).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    ordered = picked.repartitionByRange(*order).sortWithinPartitions(*order)
    map_arrow(ordered, run, BLOCK_SCHEMA, keeps=True).write.parquet(path)
    return path


def read_ids(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """From the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the ids as little-endian
    32-bit integers) and, with `ids`, the ids themselves."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    # one row a file goes through the window: its size follows the number of files, not of ids
    files = blocks.groupBy("file").agg(F.sum("n_ids").alias("n"))
    starts = files.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("file_start"))
    # and so does the broadcast of the starts, which spares the blocks, as large as all ids, a shuffle
    placed = blocks.join(F.broadcast(starts), "file").select(
        (F.col("file_start") + F.col("first_id")).alias("start"), "doc_ids", "doc_lens", "words"
    )
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * ids

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                start, names, lens, data = (batch.column(k)[i].as_py() for k in range(4))
                flat = unpack(np.frombuffer(data, "<u8"))
                ends = np.cumsum(lens)
                cut = [flat[e - n : e] for e, n in zip(ends, lens)]
                cols = [
                    pa.array(names, pa.int64()),
                    pa.array(start + ends - np.array(lens), pa.int64()),
                    pa.array(lens, pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in cut], pa.int64()),
                ]
                if ids:
                    cols.append(pa.array([x.astype(np.int64) for x in cut], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(cols)])

    return map_arrow(placed, run, schema)
