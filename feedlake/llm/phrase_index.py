"""Benchmark decontamination with a distributed positional inverted index.

Index: training documents are dealt into shards; a shard row lists every term it holds (as bytes, so terms are equal or
not, never hashed) with the ascending positions of the term in the shard's word stream. Documents are laid end to end with a gap
wider than any phrase, so a position names a document and a word. The index knows nothing of the items: it is a Parquet dataset in the
shared folder, written once, that answers any set of items.

Query: a test item's windows of `size` consecutive words are phrases. In each shard a phrase starts from the posting list of
its rarest term there, shifted by the term's offset, and is intersected with the other shifted lists from rare to common;
a phrase with an absent term is skipped at once. What is left are exact occurrences. Proximity matches are asked for by `slop`: a
piece of `size` words of an item is near where all its distinct words stand, in any order, within `size + slop` words.

Items are dealt into blocks of about BLOCK_BYTES by a hash, written by Spark, and pass over the index one block after
the other: the driver and a task hold one block at a time, however large the benchmark is. A Python process keeps a block as
arrays of numbers, some 30 bytes a word, for all its tasks.

A shard is a Parquet row group and an Arrow batch of its own, so writers, readers and Python hold one shard at a time, however
many of them a task has: their number follows the row groups of the documents' files, which no split divides.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.rows import SLICE_ROWS, give_back, kept, map_arrow, quoted, short_batches, short_reads, word_column, words
from feedlake.workspace import materialize, new_dir

WINDOW = 10
SLOP = 10
#: Bounds, whatever the table's size: text bytes laid into one shard (a longer document is a shard of its own), and bytes
#: of test items in one broadcast block, on average (a longer item is a block of its own size).
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 16 << 20
GAP = 64

#: A row group for each shard. Without it Parquet's writer looks at its size after a hundred rows.
SHARD_GROUPS = {"parquet.block.row.count.limit": 1, "parquet.page.row.count.limit": 1}
#: Numbers of item names that are spread out at once.
NAMES = 1 << 18

INDEX_SCHEMA = (
    "shard bigint, doc_ids array<bigint>, first array<bigint>, lens array<bigint>, terms array<binary>, ends array<int>, postings binary"
)
FOUND_SCHEMA = (
    "shard bigint, k int, doc_id bigint, n_words bigint, spans array<struct<a:bigint,b:bigint>>, items array<string>, near array<string>"
)

ITEMS = pa.schema([("id", pa.string()), ("text", pa.string())])


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


class Numbering(dict):
    """Terms numbered as they come."""

    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


def packed(places: np.ndarray) -> bytes:
    """Differences of the positions, byte plane by byte plane: small numbers leave long runs of zeros to the file's codec."""
    return np.diff(places.astype("<i4"), prepend=np.int32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i4")[:, 0], dtype=np.int64)


def item_blocks(items: DataFrame, id_col: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """(block, id, text) written into the shared folder, repeated rows once, and the number of blocks. One number reaches the driver."""
    picked = items.select(F.col(quoted(id_col)).cast("string").alias("id"), F.col(quoted(text)).alias("text"))
    picked = materialize(picked.where("text is not null").distinct(), "items")
    size = picked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int")
    if blocks == 1:
        return picked.withColumn("block", F.lit(0)), 1
    path = new_dir(items.sparkSession, "item-blocks")
    picked.withColumn("block", block).write.partitionBy("block").parquet(path)
    return items.sparkSession.read.schema("id string, text string, block int").parquet(path), blocks


def build_index(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> str:
    """Write the postings of every term of every text. No shuffle: a shard is laid out where its texts are read.
    Null and empty texts have no postings and a length of 0; their rows are kept."""

    def run(batches):
        task, seq = TaskContext.get().partitionId(), 0
        number = Numbering()
        ids, lens, codes, size = [], [], [], 0

        def shard():
            nonlocal seq, size
            length = np.array(lens, np.int64)
            code = np.concatenate(codes)
            place = np.arange(len(code)) + np.repeat(GAP * np.arange(len(lens)), length)
            order = np.argsort(code, kind="stable")  # positions stay ascending within a term
            row = {
                "shard": (task << 32) + seq, "doc_ids": list(ids), "first": np.cumsum(length + GAP) - (length + GAP), "lens": list(lens),
                "terms": list(number), "ends": np.cumsum(np.bincount(code, minlength=len(number))), "postings": packed(place[order]),
            }
            ids.clear(), lens.clear(), codes.clear(), number.clear()
            seq, size = seq + 1, 0
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                for doc, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    w = words(t)
                    ids.append(doc)
                    lens.append(len(w))
                    codes.append(np.fromiter(map(number.__getitem__, w), np.int32, len(w)))
                    size += len(t) if t else 0
                    if size >= SHARD_BYTES:
                        yield shard()
        if ids:
            yield shard()

    arrow = _arrow(INDEX_SCHEMA)
    picked = docs.select(F.col(quoted(id_col)).cast("bigint"), F.col(quoted(text)))
    with short_batches(docs.sparkSession), short_reads(docs.sparkSession):
        map_arrow(picked, run, INDEX_SCHEMA).write.options(compression="zstd", **SHARD_GROUPS).parquet(path)
    return path


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number from 1 on for each pair of numbers, the same for equal pairs."""
    key = a.astype(np.int64) * (int(b.max(initial=0)) + 1) + b
    return (np.unique(key, return_inverse=True)[1] + 1).astype(np.int32)


def runs_numbered(code: np.ndarray, left: np.ndarray, size: int) -> np.ndarray:
    """For each place the same number where the next `size` codes are the same; a run ends with its item, `left` codes from there.
    Numbers of runs of 1, 2, 4 ... codes are paired, so that runs are equal or not, never hashed."""

    def after(run, n):
        out = np.zeros(len(run), np.int32)
        out[: max(0, len(run) - n)] = run[n:]
        out[left <= n] = 0
        return out

    step, run, whole, done = 1, code + np.int32(1), None, 0
    while True:
        if size & step:
            whole, done = run if whole is None else paired(whole, after(run, done)), done + step
        if done == size:
            return whole
        run, step = paired(run, after(run, step)), 2 * step


class Named:
    """Things and the numbers of the items that hold each: `first` has a place of every distinct thing, from things that are equal
    by `number`, at `place`, of the item `name`."""

    def __init__(self, number: np.ndarray, place: np.ndarray, name: np.ndarray):
        order = np.lexsort((name, number))
        number, name = number[order], name[order]
        new = np.ones(len(number), bool)
        new[1:] = number[1:] != number[:-1]
        other = new.copy()
        other[1:] |= name[1:] != name[:-1]
        self.first, self.names = place[order][new], name[other]
        self.ends = np.append(np.flatnonzero(new[other]), len(self.names)).astype(np.int32)

    def of(self, things: np.ndarray) -> np.ndarray:
        """The numbers of the items of some things, ascending, each once."""
        begin, found = self.ends[things], np.empty(0, np.int32)
        count = self.ends[things + 1] - begin
        part = np.cumsum(count, dtype=np.int64) // NAMES
        for at in np.split(np.arange(len(things)), np.flatnonzero(np.diff(part)) + 1):
            n = count[at]
            places = np.repeat(begin[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
            found = np.unique(np.append(found, self.names[places]))
        return found


class Phrases:
    """A block of items: its terms, its windows as places in the stream of the items' words, each once, with the items that hold
    it, and its pieces (every `size` words, the last one flush with the item's end) as sets of distinct terms, each once.

    Made of the items as a serialized batch of (id, text), and `size`. Items are numbered by name, in the names' order.
    """

    def __init__(self, block: tuple[bytes, int]):
        data, size = block
        ids, texts = pa.ipc.read_record_batch(pa.py_buffer(data), ITEMS).columns
        ids = pc.fill_null(ids, "null")
        stream, ends = word_column(texts)
        coded = stream.dictionary_encode()
        self.terms, self.code = coded.dictionary, coded.indices.to_numpy()
        del stream, coded
        length = np.diff(ends, prepend=0)
        worded = np.flatnonzero(length)
        ids, ends, length = ids.take(pa.array(worded)), ends[worded], length[worded]
        names = pc.unique(ids)
        self.names = names.take(pc.sort_indices(names))
        name = pc.index_in(ids, value_set=self.names).to_numpy()

        item = np.repeat(np.arange(len(ends), dtype=np.int32), length)
        left = (ends[item] - np.arange(len(item))).astype(np.int32)
        # a window starts where `size` words are left, or where a shorter item begins
        starts = np.flatnonzero((left >= size) | (left == length[item])).astype(np.int32)
        self.phrases = Named(runs_numbered(self.code, left, size)[starts], starts, name[item[starts]])
        self.length = np.minimum(left[self.phrases.first], size)
        give_back()

        begin = ends - length
        last = np.maximum(length - size, 0)
        n = -(-last // size)  # of pieces before the last one
        of = np.repeat(np.arange(len(ends), dtype=np.int32), n + 1)
        at = size * (np.arange(len(of)) - np.repeat(np.cumsum(n + 1) - (n + 1), n + 1))
        at = begin[of] + np.minimum(at, last[of])
        number, absent = np.zeros(len(at), np.int32), np.int32(-1)
        place = at[:, None] + np.arange(size)
        words_in = np.where(place < ends[of][:, None], self.code[np.minimum(place, max(0, len(self.code) - 1))], absent) if len(at) else np.empty((0, size), np.int32)
        del place
        words_in.sort(axis=1)
        words_in[:, 1:][words_in[:, 1:] == words_in[:, :-1]] = absent
        words_in.sort(axis=1)
        for k in range(size):
            number = paired(number, words_in[:, k] + np.int32(1))
        self.pieces = Named(number, np.arange(len(at), dtype=np.int32), name[of])
        words_in = words_in[self.pieces.first]
        self.piece_terms = words_in[words_in >= 0]
        self.piece_ends = np.append(0, np.cumsum((words_in >= 0).sum(axis=1)))


def intersect(lists: list[np.ndarray], offsets: list[int]) -> np.ndarray:
    """Starts at which every list has a position at its offset; lists in any order, taken from the shortest."""
    order = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    start = lists[order[0]] - offsets[order[0]]
    for k in order[1:]:
        if not len(start):
            break
        want, held = start + offsets[k], lists[k]
        at = np.searchsorted(held, want)
        at[at == len(held)] = 0
        start = start[held[at] == want]
    return start


def proximity_places(lists: list[np.ndarray], reach: int) -> np.ndarray:
    """Positions of the rarest list inside some run of `reach` words that holds a position of every list."""
    order = sorted(lists, key=len)
    near = order[0]
    for held in order[1:]:
        at = np.searchsorted(held, near - reach + 1)
        near = near[(at < len(held)) & (held[np.minimum(at, len(held) - 1)] < near + reach)]
        if not len(near):
            return near
    # all words are about; now every run that holds the place, for some hundred thousand places at a time
    ok = np.zeros(len(near), bool)
    for i in range(0, len(near), 1 << 14):
        runs = near[i : i + (1 << 14), None] - np.arange(reach)
        whole = np.ones(runs.shape, bool)
        for held in order[1:]:
            at = np.searchsorted(held, runs)
            whole &= (at < len(held)) & (held[np.minimum(at, len(held) - 1)] < runs + reach)
        ok[i : i + (1 << 14)] = whole.any(axis=1)
    return near[ok]


class Postings:
    """A shard's posting lists by the term numbers of a block of items."""

    def __init__(self, terms: pa.Array, ends: np.ndarray, data: bytes, wanted: pa.Array):
        at = pc.fill_null(pc.index_in(wanted, value_set=terms), -1).to_numpy()
        count = np.diff(ends, prepend=0)
        self.count = np.where(at >= 0, count[at], 0) if len(ends) else np.zeros(len(at), np.int64)
        self.end = np.where(at >= 0, ends[at], 0) if len(ends) else self.count
        self.places = unpacked(data)

    def lists(self, terms: np.ndarray) -> list[np.ndarray]:
        return [self.places[self.end[t] - self.count[t] : self.end[t]] for t in terms]

    def phrases(self, items: Phrases) -> Iterator[tuple[np.ndarray, int, int]]:
        """(starts, phrase length, phrase) of each phrase that occurs."""
        first, length = items.phrases.first, items.length
        held = np.append(0, np.cumsum((self.count > 0)[items.code], dtype=np.int32))
        for p in np.flatnonzero(held[first + length] - held[first] == length).tolist():
            n = int(length[p])
            start = intersect(self.lists(items.code[first[p] : first[p] + n]), list(range(n)))
            if len(start):
                yield start, n, p

    def near(self, items: Phrases, reach: int) -> Iterator[tuple[np.ndarray, int]]:
        """(places, piece) of each piece that stands within `reach` words somewhere."""
        ends = items.piece_ends
        held = np.append(0, np.cumsum((self.count > 0)[items.piece_terms], dtype=np.int32))
        for p in np.flatnonzero(held[ends[1:]] - held[ends[:-1]] == np.diff(ends)).tolist():
            places = proximity_places(self.lists(items.piece_terms[ends[p] : ends[p + 1]]), reach)
            if len(places):
                yield places, p


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint intervals, ascending, of the words in any of the given ones."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    head = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]])) if len(start) else np.empty(0, np.int64)
    return start[head], reach[np.append(head[1:] - 1, len(reach) - 1)] if len(start) else reach


class Found:
    """Pairs of a document and a thing, some bytes each, and by document the items of its things."""

    def __init__(self, things: Named):
        self.things, self.doc, self.thing = things, array("i"), array("i")

    def add(self, docs: np.ndarray, thing: int) -> None:
        self.doc.frombytes(docs.astype(np.int32).tobytes())
        self.thing.extend([thing] * len(docs))

    def sort(self) -> np.ndarray:
        """The documents that have any."""
        doc, thing = np.frombuffer(self.doc, np.int32), np.frombuffer(self.thing, np.int32)
        order = np.argsort(doc, kind="stable")
        self.docs, begin = np.unique(doc[order], return_index=True)
        self.by_doc = dict(zip(self.docs.tolist(), zip(begin.tolist(), [*begin[1:].tolist(), len(doc)])))
        self.sorted = thing[order]
        return self.docs

    def of(self, doc: int) -> np.ndarray:
        at = self.by_doc.get(doc)
        return self.things.of(np.unique(self.sorted[slice(*at)])) if at else NONE


NONE = np.empty(0, np.int32)


def _lists(values: pa.Array, lengths) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), values)


def query_block(index: DataFrame, shared: Broadcast, size: int = WINDOW, slop: int | None = None, every: bool = True) -> DataFrame:
    """FOUND_SCHEMA rows of one block of items, as of `Phrases`, over the stored index: of every document row, or of those with a match."""
    arrow = _arrow(FOUND_SCHEMA)

    def shown(shard: int, ids: pa.Array, first: np.ndarray, lens: np.ndarray, postings: Postings, items: Phrases):
        exact, near = Found(items.phrases), Found(items.pieces)
        start, end = array("q"), array("q")
        for at, length, p in postings.phrases(items):
            start.frombytes(at.tobytes())
            end.frombytes((at + length).tobytes())
            exact.add(np.unique(np.searchsorted(first, at, side="right") - 1), p)
        for at, p in postings.near(items, size + slop) if slop is not None else ():
            near.add(np.unique(np.searchsorted(first, at, side="right") - 1), p)
        # documents lie apart, so no interval reaches into the next one
        a, b = merged(np.frombuffer(start, np.int64), np.frombuffer(end, np.int64))
        of = np.searchsorted(first, a, side="right") - 1
        a, b = a - first[of], b - first[of]
        docs = np.union1d(exact.sort(), near.sort())
        docs = np.arange(len(ids)) if every else docs.astype(np.int64)
        rows, held, begin = ([], []), 0, 0
        for k, doc in enumerate(docs.tolist(), 1):
            for found, numbers in zip((exact, near), rows):
                numbers.append(found.of(doc))
                held += len(numbers[-1])
            if k - begin < SLICE_ROWS and held < NAMES and k < len(docs):
                continue
            part = docs[begin:k]
            low, high = np.searchsorted(of, part, side="left"), np.searchsorted(of, part, side="right")
            pieces = slice(low[0], high[-1])  # no other document between them has any
            spans = pa.StructArray.from_arrays([pa.array(a[pieces]), pa.array(b[pieces])], names=["a", "b"])
            cols = [
                pa.array(np.full(len(part), shard)), pa.array(part, pa.int32()), ids.take(pa.array(part)), pa.array(lens[part]),
                _lists(spans, high - low),
                *(_lists(items.names.take(pa.array(np.concatenate(n))), [len(x) for x in n]) for n in rows),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow)], schema=arrow)
            rows, held, begin = ([], []), 0, k

    def run(batches):
        items = kept(shared, Phrases)
        for batch in batches:
            for i in range(batch.num_rows):
                shard, ids, first, lens, terms, ends, data = (batch.column(k)[i] for k in range(7))
                postings = Postings(terms.values, ends.values.to_numpy().astype(np.int64), data.as_py(), items.terms)
                yield from shown(shard.as_py(), ids.values, first.values.to_numpy(), lens.values.to_numpy(), postings, items)

    return map_arrow(index, run, FOUND_SCHEMA, keeps=True)


def _covered(spans: Column) -> Column:
    """Words in the union of the intervals."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))

    def add(acc, s):
        a = F.greatest(s["a"], acc["end"])
        return F.struct((acc["n"] + F.greatest(s["b"] - a, F.lit(0))).alias("n"), F.greatest(s["b"], acc["end"]).alias("end"))

    return F.aggregate(F.array_sort(spans), start, add)["n"]


def query_index(index: DataFrame, blocks: DataFrame, n_blocks: int, size: int = WINDOW, slop: int | None = None) -> DataFrame:
    """doc_id, n_words, n_hit, items and near (sorted strings of the items found), one row per indexed document row.

    `blocks` as of `item_blocks`. One pass over the index a block; the first one tells of every row, later ones of rows with a match,
    and their findings are united by document row. Findings are written into the shared folder.
    """
    if size + (slop or 0) > GAP:
        raise ValueError(f"at most {GAP} words")
    spark = index.sparkSession

    def block(b: int) -> Broadcast:
        held = blocks.where(F.col("block") == b).select("id", "text").toArrow()  # about BLOCK_BYTES
        held = pa.RecordBatch.from_arrays([c.cast(f.type).combine_chunks() for c, f in zip(held.columns, ITEMS)], schema=ITEMS)
        return spark.sparkContext.broadcast((held.serialize().to_pybytes(), size))

    path = new_dir(spark, "phrase-found")
    for b in range(n_blocks):
        shared = block(b)
        with short_batches(spark, 1):
            query_block(index, shared, size, slop, every=b == 0).write.mode("append").parquet(path)
        shared.unpersist()
    found = spark.read.schema(FOUND_SCHEMA).parquet(path)
    if n_blocks > 1:
        united = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
        rows = found.groupBy("shard", "k")
        found = rows.agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), united("spans"), united("items"), united("near"))
    return found.select("doc_id", "n_words", _covered(F.col("spans")).alias("n_hit"), "items", "near")


def open_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(path)


def contamination(
    docs: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text: str = "text", slop: int | None = None
) -> DataFrame:
    """doc_id, n_words, n_hit, items (by exact phrases) and near (by proximity, with `slop`; else empty) for every document row.

    Items of fewer words than `size` are one phrase and one piece; null or word-less items none; a null item id is named "null". Repeated
    item rows count once, repeated documents are judged alike, overlapping occurrences mark a word once, null texts
    have 0 words, extra columns are not read, an empty table on either side gives no hits.
    """
    spark = docs.sparkSession
    index = open_index(spark, build_index(docs, new_dir(spark, "phrase-index"), id_col, text))
    return query_index(index, *item_blocks(items), size, slop)


def item_digest(found: DataFrame) -> list:
    """n_items, items_sha256, contaminated, n_near and near_sha256 as columns."""
    digest = lambda c: F.sha2(F.concat_ws(",", c), 256)
    return [
        F.size("items").cast("bigint").alias("n_items"),
        digest("items").alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near").cast("bigint").alias("n_near"),
        digest("near").alias("near_sha256"),
    ]
