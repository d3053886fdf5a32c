"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

Shingles are five consecutive words (lower-cased; a text of fewer words is one shingle, a text without words has none). Rows
with the same shingle set are one node, so copies are joined once. Each of TREES trees gives a node a path of LEVELS
symbols, a byte of a min-hash each, packed into one long: its order is the order of the sorted prefix trie, and a shift
shortens the prefix. The forest is one table in the order of tree, path, node (a range shuffle that splits hot paths, then a sort);
a trie node at some depth is a run of equal prefixes in it, and one walk over the sorted rows finds the runs of all depths.

Shortening. Matches start at full depth: nodes that share a whole path are candidates and are verified on their texts' word
tuples. Then prefixes are shortened by one symbol, for those nodes that need it: a node is settled, and takes part in no shorter match with
another settled one, once it has links and even its weakest would have been found at this depth, in some tree, with probability `recall`.
The last depth is the one at which two sets of similarity `threshold` meet with that probability; a node without links gets there.

Hot prefixes. A run of up to SMALL nodes verifies all its pairs. Larger runs, and those that a piece of the walk (an Arrow batch) may
have cut, are gathered into buckets by their prefix. A bucket of more than SMALL nodes first verifies every node against two hubs,
picked by a hash of node and tree, so a node meets other hubs in other trees. After that most nodes of a large group are in
one class. What is left are the strays, nodes of a bucket outside its main class. Each meets every node of the bucket in
another class, in blocks of about BLOCK nodes a side: signatures first (a pair that agrees in fewer symbols than
similarity `threshold` gives but for a chance of 3 in 100,000 is passed over), then shingle hashes. A pair is looked at in
the first tree that brings it together, and a stray's first link to each class of the block is written and verified. So
linked pairs that meet in the forest end in one class, and no bucket is cut, sampled or collected.

Links of large groups. Links stay within a class. So once the classes are known, the nodes of large buckets ("crowd") are
compared all with all inside each class, in blocks of about BLOCK nodes or BLOCK_BYTES of shingle hashes a side; each pair of blocks is one
row of work. The shared shingles of all pairs of two blocks are one matrix product, so every pair is exact. For `n_links` a
task returns a count a node; pair rows are made only when `links` is read. Links with a node outside the crowd come from the buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField

from feedlake.llm.components import components
from feedlake.llm.rows import BoundedCache, map_arrow, map_texts, quoted, short_batches, words
from feedlake.workspace import materialize

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.999
TREES = 32
LEVELS = 8
SMALL = 16
BLOCK = 1024
BLOCK_BYTES = 16 << 20
COLUMNS = 4096


class JaccardJoin(NamedTuple):
    documents: DataFrame  # doc_id, text_hash, class_id, copy_of, n_links, representative: one row per document row
    links: DataFrame | None  # doc_a, doc_b, similarity: all links between representatives of different shingle sets


def meeting(similarity, depth: int, trees: int = TREES):
    """The probability that two sets of this similarity share a prefix of this depth in some tree (number or column)."""
    return 1 - (1 - similarity**depth) ** trees


def prefix_depth(threshold: float, recall: float, trees: int = TREES, levels: int = LEVELS) -> int:
    """The longest prefix at which `threshold` reaches `recall` over the trees."""
    for depth in range(levels, 0, -1):
        if meeting(threshold, depth, trees) >= recall:
            return depth
    raise ValueError("more trees are needed for this recall")


def shingle_set(text: str | None) -> set[tuple[bytes, ...]]:
    w = words(text)
    if len(w) < SHINGLE:
        return {tuple(w)} if w else set()
    return set(zip(*(w[k:] for k in range(SHINGLE))))


def shingle_hashes(w: list[bytes], word_hash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    n = len(w)
    h = np.fromiter(map(word_hash, w), np.uint64, n)
    size = min(n, SHINGLE)
    x = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        x = x * np.uint64(0x9E3779B97F4A7C15) + h[k : n - size + 1 + k]
        x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(x ^ (x >> np.uint64(32)))


def forest_paths(sets: list[np.ndarray], trees: int, levels: int, seed: int = 7) -> np.ndarray:
    """(sets, trees) longs: levels bytes of independent min-hashes each."""
    rng = np.random.default_rng(seed)
    scale = rng.integers(0, 1 << 31, trees * levels, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shift = rng.integers(0, 1 << 32, trees * levels, dtype=np.uint32)
    flat = (np.concatenate(sets) >> np.uint64(16)).astype(np.uint32)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    low = np.empty((trees * levels, len(sets)), np.uint32)
    for p in range(trees * levels):
        low[p] = np.minimum.reduceat(flat * scale[p] + shift[p], starts)
    symbols = ((low * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
    padded = np.zeros((len(sets), trees, 8), np.uint8)
    padded[:, :, :levels] = symbols.T.reshape(len(sets), trees, levels)
    return padded.view(">i8")[:, :, 0].astype(np.int64)


def signatures(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """doc_id, text_hash, fingerprint (of the shingle set; null without words), paths."""

    def make():
        cache = BoundedCache(xxhash.xxh3_64_intdigest)

        def run(texts):
            sets = [shingle_hashes(w, cache.__getitem__) if w else None for w in map(words, texts)]
            full = [s for s in sets if s is not None]
            paths = iter(forest_paths(full, TREES, LEVELS) if full else ())
            prints = [None if s is None else xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            return prints, [None if s is None else next(paths) for s in sets]

        return run

    rows = docs.select(F.col(quoted(id_col)).cast("bigint").alias("doc_id"), F.col(quoted(text)).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    fields = [StructField("fingerprint", BinaryType()), StructField("paths", ArrayType(LongType()))]
    return map_texts(rows, ["doc_id", "text_hash"], "text", make, fields)


def similarity(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b) -> (a, b, sim), exactly, on word tuples. Rows reach a task sorted by a, whose set is built once a run."""

    def run(batches: Iterator[pa.RecordBatch]):
        last, left = None, set()
        for batch in batches:
            sims = []
            for i in range(batch.num_rows):
                a = batch.column(0)[i].as_py()
                if a != last:
                    last, left = a, shingle_set(batch.column(2)[i].as_py())
                right = shingle_set(batch.column(3)[i].as_py())
                both = len(left & right)
                sims.append(both / (len(left) + len(right) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sims, pa.float64())], names=["a", "b", "sim"])

    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return map_arrow(both, run, "a bigint, b bigint, sim double")


def trie_runs(tree: np.ndarray, path: np.ndarray, node: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted rows: those in long runs of equal prefixes or in the first or last one, which the piece may cut, as row
    numbers; and all pairs of the other runs, but those that share a longer prefix, as row numbers of either."""
    prefix = path >> (8 * (LEVELS - depth))
    head = np.flatnonzero(np.append(True, (tree[1:] != tree[:-1]) | (prefix[1:] != prefix[:-1])))
    size = np.diff(np.append(head, len(node)))
    whole = size <= SMALL
    whole[[0, -1]] = False
    run, short = np.repeat(np.arange(len(head)), size), np.repeat(whole, size)
    first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(1, min(SMALL, int(size[whole].max(initial=1)))):
        same = short[k:] & (run[k:] == run[:-k])
        if depth < LEVELS:
            longer = 8 * (LEVELS - depth - 1)
            same &= path[k:] >> longer != path[:-k] >> longer
        at = np.flatnonzero(same)
        first.append(at)
        second.append(at + k)
    return np.flatnonzero(~short), np.concatenate(first), np.concatenate(second)


def walk_forest(nodes: DataFrame, least: int) -> DataFrame:
    """(depth, tree, prefix, node, other): pairs (node, other) of short whole runs, and members (other is null) of the others,
    for each depth from LEVELS down to `least`. Paths of one tree lie sorted over many tasks; ties are split by node."""

    def run(batches):
        for batch in batches:
            tree, path, node = (batch.column(k).to_numpy() for k in range(3))
            if not len(node):
                continue
            for depth in range(LEVELS, least - 1, -1):
                rest, a, b = trie_runs(tree, path, node, depth)
                at, other = np.concatenate([rest, a]), np.concatenate([np.zeros(len(rest), np.int64), node[b]])
                cols = [
                    pa.array(np.full(len(at), depth, np.int32)), pa.array(tree[at]), pa.array(path[at] >> (8 * (LEVELS - depth))),
                    pa.array(node[at]), pa.array(other, mask=np.arange(len(at)) < len(rest)),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=["depth", "tree", "prefix", "node", "other"])

    paths = nodes.select("node", F.posexplode("paths").alias("tree", "path")).select("tree", "path", "node")
    tries = paths.repartitionByRange("tree", "path", "node").sortWithinPartitions("tree", "path", "node")
    return map_arrow(tries, run, "depth int, tree int, prefix bigint, node bigint, other bigint")


def _members(runs: DataFrame) -> DataFrame:
    """(depth, bucket, tree, size, hubs, node) of the gathered runs of two nodes or more."""
    bucket = F.xxhash64("depth", "tree", "prefix").alias("bucket")  # a collision only adds candidates
    members = runs.where("other is null").select("depth", bucket, "tree", "node")
    by = F.xxhash64("node", "tree")
    hubs = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"), F.min_by("node", by).alias("h"), F.max_by("node", by).alias("g")
    )
    hubs = materialize(hubs.where("size > 1").select("bucket", "size", F.array("h", "g").alias("hubs")), "forest-hubs")
    return materialize(members.join(hubs, "bucket"), "forest-members")


def _settled(verified: DataFrame, depth: int, threshold: float, recall: float) -> DataFrame:
    """Nodes with links, even the weakest of which would have been found at this depth."""
    ends = verified.where(F.col("sim") >= threshold).select(F.explode(F.array("a", "b")).alias("node"), "sim")
    return ends.groupBy("node").agg(F.min("sim").alias("weakest")).where(meeting(F.col("weakest"), depth) >= recall).select("node")


def _unsettled_pairs(pairs: DataFrame, settled: DataFrame) -> DataFrame:
    marked = lambda side: settled.select(F.col("node").alias(side), F.lit(True).alias(f"{side}_done"))
    open_ = pairs.join(marked("a"), "a", "left").join(marked("b"), "b", "left")
    return open_.where("a_done is null or b_done is null").select("a", "b")


def _from_texts(df: DataFrame, label: str) -> DataFrame:
    with short_batches(df.sparkSession):
        return materialize(df, label)


def _pair(x, y) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _first_pairs(members: DataFrame) -> DataFrame:
    """Distinct (a, b) of (bucket, node, size, hubs): all pairs of small buckets, node and hub of large ones."""
    small, large = members.where(F.col("size") <= SMALL), members.where(F.col("size") > SMALL)
    x, y = small.select("bucket", F.col("node").alias("a")), small.select("bucket", F.col("node").alias("b"))
    pairs = x.join(y, "bucket").where("a < b").select("a", "b")
    stars = large.select("node", F.explode("hubs").alias("hub")).where("node <> hub").select(*_pair(F.col("hub"), F.col("node")))
    return pairs.unionByName(stars).distinct()


def least_agreement(threshold: float, symbols: int, z: float = 4.0) -> int:
    """Symbols that sets of similarity `threshold` share, less z standard deviations."""
    p = threshold + (1 - threshold) / 256
    return int(symbols * p - z * (symbols * p * (1 - p)) ** 0.5)


def _blocks(rows: DataFrame, name: str) -> DataFrame:
    """(bucket, n, n_bytes, node, ...) -> a row for each block of about BLOCK nodes or BLOCK_BYTES of shingle hashes of a bucket."""
    block = F.pmod(F.xxhash64("node"), F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("n_bytes") / BLOCK_BYTES)))
    return rows.groupBy("bucket", block.alias("block")).agg(
        F.first("tree").alias("tree"), F.collect_list(F.struct("node", "label", "paths", "shingles")).alias(name)
    )


def _hashes(texts: DataFrame) -> DataFrame:
    """node, shingles (sorted 64-bit hashes)."""

    def make():
        cache = BoundedCache(xxhash.xxh3_64_intdigest)
        return lambda rows: ([shingle_hashes(words(t), cache.__getitem__).tobytes() for t in rows],)

    return map_texts(texts, ["node"], "text", make, [StructField("shingles", BinaryType())])


def stray_links(a: list[dict], b: list[dict], tree: int, depth: int, threshold: float, agree: int) -> list[tuple[int, int]]:
    """(node of a, node of b): each a's first link to each other class of b, of the pairs that no lower tree brings together."""
    symbols = lambda side: np.array([x["paths"] for x in side], ">i8").view(np.uint8).reshape(len(side), TREES, LEVELS)
    sa, sb = symbols(a), symbols(b)
    labels = np.array([x["label"] for x in b])
    sets = [np.frombuffer(x["shingles"], np.uint64) for x in b]
    out = []
    for x, s in zip(a, sa):
        same = sb == s
        hit = np.flatnonzero((same.sum(axis=(1, 2)) >= agree) & (labels != x["label"]))
        hit = hit[~same[hit, :tree, :depth].all(axis=2).any(axis=1)]
        own, linked = np.frombuffer(x["shingles"], np.uint64), set()
        for k in hit:
            if labels[k] not in linked:
                both = len(np.intersect1d(own, sets[k], assume_unique=True))
                if both >= threshold * (len(own) + len(sets[k]) - both) - 1e-6:
                    linked.add(labels[k])
                    out.append((x["node"], b[k]["node"]))
    return out


def _stray_pairs(members: DataFrame, label: DataFrame, nodes: DataFrame, texts: DataFrame, depth: int, threshold: float) -> DataFrame:
    """Distinct (a, b) of different classes in one large bucket, one of them outside its main class, that link."""
    large = members.where(F.col("size") > SMALL).select("bucket", "tree", "node").join(label, "node", "left")
    large = materialize(large.withColumn("label", F.coalesce("label", "node")), "forest-labelled")
    count = large.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    main = count.groupBy("bucket").agg(
        F.max_by("label", F.struct("n", "label")).alias("main"), F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.max("n").alias("top")
    )
    main = materialize(main.where("k > 1").select("bucket", "main"), "forest-mixed")
    mixed = materialize(large.join(main, "bucket"), "forest-mixed-members")
    needed = texts.join(mixed.select("node").distinct(), "node", "left_semi")
    held = materialize(_hashes(needed).join(nodes.select("node", "paths"), "node"), "forest-mixed-nodes")
    mixed = mixed.join(held, "node")
    strays = mixed.where("label <> main")
    sized = lambda rows: rows.join(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("shingles")).alias("n_bytes")), "bucket")
    sides = _blocks(sized(strays), "strays").join(_blocks(sized(mixed), "others").drop("block", "tree"), "bucket").select("strays", "others", "tree")
    agree = least_agreement(threshold, TREES * LEVELS)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                strays, others, tree = (batch.column(k)[i].as_py() for k in range(3))
                found = stray_links(strays, others, tree, depth, threshold, agree)
                low, high = [min(x) for x in found], [max(x) for x in found]
                yield pa.RecordBatch.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["a", "b"])

    return map_arrow(sides, run, "a bigint, b bigint").distinct()


def block_similarity(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """(a, b) Jaccard similarities of sets of distinct hashes: 0/1 matrices of the hashes both sides hold, COLUMNS at a time."""
    sizes = [np.array([len(x) for x in side]) for side in (a, b)]
    flat = [np.concatenate(side) for side in (a, b)]
    held = np.intersect1d(*flat)
    cells = []
    for n, x in zip(sizes, flat):
        row, column = np.repeat(np.arange(len(n)), n), np.minimum(np.searchsorted(held, x), max(len(held) - 1, 0))
        hit = held[column] == x if len(held) else np.zeros(len(x), bool)
        row, column = row[hit], column[hit]
        order = np.argsort(column, kind="stable")
        cells.append((row[order], column[order]))
    both = np.zeros((len(a), len(b)))
    for start in range(0, len(held), COLUMNS):
        sides = []
        for n, (row, column) in zip(sizes, cells):
            x, y = np.searchsorted(column, (start, start + COLUMNS))
            ones = np.zeros((len(n), min(COLUMNS, len(held) - start)), np.float32)
            ones[row[x:y], column[x:y] - start] = 1
            sides.append(ones)
        both += sides[0] @ sides[1].T
    return both / (sizes[0][:, None] + sizes[1][None, :] - both)


def _crowd(members: DataFrame, label: DataFrame, texts: DataFrame) -> DataFrame:
    """node, label, shingles of the nodes of large buckets that share a class with another one."""
    nodes = members.where(F.col("size") > SMALL).select("node").distinct().join(label, "node")
    nodes = materialize(nodes, "forest-crowd-labels")
    more = nodes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("label")
    nodes = nodes.join(more, "label")
    held = _hashes(texts.join(nodes.select("node"), "node", "left_semi"))
    return materialize(held.join(nodes, "node").select("node", "label", "shingles"), "forest-crowd")


def _block_pairs(crowd: DataFrame) -> DataFrame:
    """(label, low, high, sides): every two blocks of a class, and each block with itself; a side is (block, nodes)."""
    size = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum(F.length("shingles")) / BLOCK_BYTES))
    blocks = crowd.groupBy("label").agg(size.alias("blocks"))
    rows = crowd.join(blocks, "label").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    sides = rows.groupBy("label", "blocks", "block").agg(F.collect_list(F.struct("node", "shingles")).alias("nodes"))
    sides = sides.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    return sides.groupBy("label", low, high).agg(F.collect_list(F.struct("block", "nodes")).alias("sides")).select("sides")


def _crowd_links(crowd: DataFrame, threshold: float, counts: bool) -> DataFrame:
    """Links of the crowd: (node, n), summed per task row, or (a, b, sim)."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                sides = [s["nodes"] for s in batch.column(0)[i].as_py()]
                ids = [np.array([x["node"] for x in side]) for side in sides]
                sets = [[np.frombuffer(x["shingles"], np.uint64) for x in side] for side in sides]
                sim = block_similarity(sets[0], sets[-1])
                linked = sim >= threshold
                if len(sides) == 1:  # a block with itself
                    linked = np.triu(linked, 1)
                if counts:
                    nodes = np.concatenate([ids[0], ids[-1]])
                    n = np.concatenate([linked.sum(axis=1), linked.sum(axis=0)])
                    yield pa.RecordBatch.from_arrays([pa.array(nodes[n > 0], pa.int64()), pa.array(n[n > 0], pa.int64())], names=["node", "n"])
                else:
                    for k in range(len(ids[0])):
                        hit = np.flatnonzero(linked[k])
                        x, y = np.full(len(hit), ids[0][k]), ids[-1][hit]
                        arrays = [pa.array(np.minimum(x, y), pa.int64()), pa.array(np.maximum(x, y), pa.int64()), pa.array(sim[k, hit], pa.float64())]
                        yield pa.RecordBatch.from_arrays(arrays, names=["a", "b", "sim"])

    return map_arrow(_block_pairs(crowd), run, "node bigint, n bigint" if counts else "a bigint, b bigint, sim double")


def jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL, list_links: bool = True
) -> JaccardJoin:
    """Classes of documents joined by links of similarity >= threshold.

    `class_id`: least id in the class; `copy_of`: least id with the same shingle set; `n_links`: links of that set to other
    sets (without `list_links`, only classes are wanted: no `n_links` and no `links`); `representative`: true for the rows (of one id and text) that stand for the class. Texts without words (null,
    empty) are classes of their own. A null id is greater than others; repeated rows fall in one class; extra columns
    are not read; an empty table gives no rows.
    """
    least = prefix_depth(threshold, recall)
    sig = _from_texts(signatures(docs, id_col, text), "forest-signatures")
    named = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    nodes = sig.where("fingerprint is not null").groupBy("fingerprint").agg(F.min(named).alias("rep"), F.first("paths").alias("paths"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "forest-nodes")

    runs = materialize(walk_forest(nodes, least), "forest-runs")
    members = _members(runs)
    short = runs.where("other is not null").select("depth", *_pair(F.col("node"), F.col("other")))
    matched = short.select(F.explode(F.array("a", "b")).alias("node")).unionByName(members.select("node")).distinct()

    rep = F.col("rep")
    wanted = nodes.join(matched, "node", "left_semi").select(
        "node", rep["doc_id"].alias("rep_id"), rep["text_hash"].alias("rep_hash")
    )
    wanted = materialize(wanted, "forest-wanted")
    rows = docs.select(F.col(quoted(id_col)).cast("bigint").alias("doc_id"), F.col(quoted(text)).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    # both sides grow with the data: no broadcast, at any size
    texts = rows.join(wanted.hint("shuffle_merge"), F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_hash") == F.col("rep_hash")))
    texts = materialize(texts.groupBy("node").agg(F.first("text").alias("text")), "forest-texts")

    verified = None
    for depth in range(LEVELS, least - 1, -1):
        at = F.col("depth") == depth
        pairs = short.where(at).select("a", "b").unionByName(_first_pairs(members.where(at))).distinct()
        if verified is not None:
            settled = materialize(_settled(verified, depth + 1, threshold, recall), "forest-settled")
            pairs = _unsettled_pairs(pairs.join(verified, ["a", "b"], "left_anti"), settled)
        found = _from_texts(similarity(materialize(pairs, "forest-pairs"), texts), "forest-verified")
        verified = found if verified is None else verified.unionByName(found)
    links = verified.where(F.col("sim") >= threshold)
    label = components(links)
    members = members.where(F.col("depth") == least)
    pairs = materialize(_stray_pairs(members, label, nodes, texts, least, threshold).join(verified, ["a", "b"], "left_anti"), "forest-pairs")
    if pairs.limit(1).count():
        late = _from_texts(similarity(pairs, texts).where(F.col("sim") >= threshold), "forest-verified")
        links = materialize(links.unionByName(late), "forest-links")
        if late.limit(1).count():
            label = components(links)

    own = nodes.join(label, "node", "left").select("fingerprint", "node", "rep", F.coalesce("label", "node").alias("label"))
    own = materialize(own, "forest-labels")
    heads = materialize(own.groupBy("label").agg(F.min("rep").alias("head")), "forest-heads")
    classes = own.join(heads, "label")
    if list_links:
        crowd = _crowd(members, label, texts)
        inside = lambda side: crowd.select(F.col("node").alias(side), F.lit(True).alias(f"{side}_in"))
        links = links.join(inside("a"), "a", "left").join(inside("b"), "b", "left").where("a_in is null or b_in is null").select("a", "b", "sim")
        links = materialize(links, "forest-outer-links")
        ends = links.select(F.explode(F.array("a", "b")).alias("node"), F.lit(1).cast("bigint").alias("n"))
        degree = ends.unionByName(_crowd_links(crowd, threshold, True)).groupBy("node").agg(F.sum("n").alias("n_links"))
        classes = classes.join(materialize(degree, "forest-degrees"), "node", "left")
    counted = [F.coalesce("n_links", F.lit(0)).alias("n_links")] if list_links else []
    classes = materialize(classes.select(F.col("fingerprint").alias("of"), "head", "rep", *counted), "forest-classes")
    head, rep = F.col("head"), F.col("rep")
    alone = F.col("of").isNull()
    documents = sig.drop("paths").join(classes, F.col("fingerprint") == F.col("of"), "left").select(
        "doc_id",
        "text_hash",
        F.when(alone, F.col("doc_id")).otherwise(head["doc_id"]).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(rep["doc_id"]).alias("copy_of"),
        *[F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links") for _ in counted],
        (alone | (F.col("doc_id").eqNullSafe(head["doc_id"]) & (F.col("text_hash") == head["text_hash"]))).alias("representative"),
    )
    if not list_links:
        return JaccardJoin(documents, None)
    ids = nodes.select("node", F.col("rep")["doc_id"].alias("id"))
    pairs = links.unionByName(_crowd_links(crowd, threshold, False)).join(ids.toDF("a", "doc_a"), "a").join(ids.toDF("b", "doc_b"), "b")
    return JaccardJoin(documents, pairs.select("doc_a", "doc_b", F.col("sim").alias("similarity")))
