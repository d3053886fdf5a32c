"""Helpers the operators share: table reads, words, and running a Python function over a text column."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Rows a Python function sees at once; a slice of the Arrow batch, so memory follows a few texts, not a partition.
SLICE_ROWS = 256

#: Rows and bytes of text that a function of a whole Arrow column sees at once.
PART_ROWS, PART_BYTES = 8 * SLICE_ROWS, 4 << 20

# Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased. In UTF-8 every byte of
# such a character is 0x80 or more, so the words can be cut bytewise.
_WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8; none for null."""
    return text.encode().translate(_WORD_TABLE).split() if text else []


def word_column(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """`words` of all texts of a string column, one after the other, and the place where each text's words end."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = (texts.buffers()[2] or pa.py_buffer(b"")).to_pybytes().translate(_WORD_TABLE)
    texts = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    cut = pc.split_pattern(texts, " ")
    held = pc.greater(pc.binary_length(cut.flatten()), 0)
    before = np.append(0, np.cumsum(held.to_numpy(zero_copy_only=False), dtype=np.int64))
    ends = before[np.cumsum(pc.list_value_length(cut).to_numpy(), dtype=np.int64)] if len(cut) else before[:0]
    return cut.flatten().filter(held).cast(pa.binary()), ends


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python, once an application: the driver serves it as a zip."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


@contextmanager
def short_batches(spark: SparkSession, rows: int = 4 * SLICE_ROWS) -> Iterator[None]:
    """For actions inside: Arrow batches of at most so many rows, as a batch of whole texts lies in memory on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) < rows:
        spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def short_reads(spark: SparkSession) -> Iterator[None]:
    """For actions inside: Parquet rows are decoded SLICE_ROWS at a time at most, as whole texts lie in each of these batches, and
    Arrow batches end at about 8 MB, unless the session has a limit."""
    rows, size = "spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxBytesPerBatch"
    wanted = {rows: min(int(spark.conf.get(rows)), SLICE_ROWS), size: 2 * PART_BYTES}
    before = {k: spark.conf.get(k, None) for k in wanted}
    if before[size] is not None:
        del wanted[size], before[size]
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_kept: list = []


def kept(shared, make: Callable):
    """`make` of a broadcast value, which this Python process keeps for its next tasks of the same operator."""
    value = shared.value
    key = (make.__module__, make.__qualname__, hash(value))
    if not _kept or _kept[0] != key:
        let_go()
        _kept.extend((key, make(value)))
    return _kept[1]


def let_go() -> None:
    """Free what `kept` holds; such objects refer to themselves by their caches, so only a collection frees them."""
    if _kept:
        _kept.clear()
        gc.collect()
    give_back()


def give_back() -> None:
    """Arrow's memory pool keeps what arrays have freed, as much as its largest column took, until it is told to."""
    pa.default_memory_pool().release_unused()


def map_arrow(df: DataFrame, run: Callable, schema, keeps: bool = False) -> DataFrame:
    """Spark hands its Python processes from stage to stage: a function that does not use `kept` (`keeps`) first frees what an
    earlier operator left there."""
    ship(df.sparkSession)

    def alone(batches):
        let_go()
        return run(batches)

    return df.mapInArrow(run if keeps else alone, schema)


def parts(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, of at most PART_ROWS rows and, by column `text`, PART_BYTES bytes (or one row)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(), dtype=np.int64)
    at = 0
    while at < len(ends):
        most = (ends[at - 1] if at else 0) + PART_BYTES
        upto = min(max(int(np.searchsorted(ends, most, "right")), at + 1), at + PART_ROWS)
        yield batch.slice(at, upto - at)
        at = upto


def map_texts(
    df: DataFrame,
    keep: Sequence[str],
    text: str,
    make: Callable[[], Callable[[list], Sequence]],
    fields: Sequence[StructField],
    keeps: bool = False,
    whole_column: bool = False,
) -> DataFrame:
    """`keep` columns as they are, plus the columns a Python function derives from the text column.

    `make()` runs once a task and returns a function from a list of texts (None for null) to one sequence per field; with
    `whole_column`, from the texts as an Arrow array.
    Only `keep` and the text reach Python; other columns, whatever their names, are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    schema = StructType([StructField(c, df.schema[c].dataType) for c in keep] + list(fields))
    types = [to_arrow_type(f.dataType) for f in fields]
    names = [f.name for f in schema.fields]
    at_text = list(keep).index(text) if text in keep else len(keep)
    n_keep = len(keep)

    def run(batches):
        f = make()
        for batch in batches:
            slices = parts(batch, at_text) if whole_column else map(batch.slice, range(0, batch.num_rows, SLICE_ROWS), repeat(SLICE_ROWS))
            for part in slices:
                made = f(part.column(at_text) if whole_column else part.column(at_text).to_pylist())
                arrays = [part.column(i) for i in range(n_keep)]
                arrays += [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(made, types)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
                if whole_column:
                    made = arrays = None
                    give_back()

    picked = [F.col(quoted(c)) for c in keep] + [F.col(quoted(text)).alias("__text")] * (at_text == n_keep)
    return map_arrow(df.select(*picked), run, schema, keeps)


class BoundedCache(dict):
    """A dict that computes what it lacks. It holds two generations of at most `limit` entries each: when the young one
    is full it becomes the old one, and an entry asked for again moves back. Long keys are computed and not kept."""

    def __init__(self, compute: Callable, limit: int = 150_000, longest: int = 48):
        super().__init__()
        self.compute, self.limit, self.longest = compute, limit, longest
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value
