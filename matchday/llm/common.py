"""Helpers shared by the operators: tables in the shared folder, word hashes, split keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the contracts, U+0020 and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a new local one where none is set (local mode only)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        made = spark.sparkContext._jsc.sc().getCheckpointDir()
        if made.isEmpty():
            master = spark.sparkContext.master
            if not (master == "local" or master.startswith("local[")):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="checkpoint-"))
            made = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = made.get()
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a lost executor repeats no work before this point."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def others(df: DataFrame, *own: str) -> list[str]:
    """Columns of ``df`` without those named like an operator's ``own``, in any case (Spark's names ignore it)."""
    taken = {name.lower() for name in own}
    return [c for c in df.columns if c.lower() not in taken]


def word_count(text: Column) -> Column:
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's text leaves no remainder by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class _WordHashes(dict):
    """Word to 64-bit hash; emptied when it holds ``limit`` words, so its memory is bounded."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _WordHashes()


def forget_words() -> None:
    """Empty the table of word hashes: a task that ends leaves no memory behind in its reused Python worker."""
    _hashes.clear()


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of a text's words, A-Z lower-cased, in order (bytes.split() splits at SPACE)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over unsigned integers, element by element."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x



def only(df: DataFrame, ids: DataFrame, column: str, how: str = "left_semi", most: int = 2_000_000) -> DataFrame:
    """Rows of ``df`` whose ``column`` is (``left_semi``) or is not (``left_anti``) in ``ids``.

    Up to ``most`` counted ids are broadcast (some tens of MB); beyond that both sides are shuffled.
    """
    ids = ids.select(column)
    return df.join(F.broadcast(ids) if ids.count() <= most else ids.hint("shuffle_merge"), column, how)


def text_slices(texts: list[bytes | None], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive stretches of ``texts`` of at most ``most`` bytes together, but one text at least."""
    start = size = 0
    for at, text in enumerate(texts):
        size += len(text or b"")
        if size > most and at > start:
            yield start, at
            start, size = at, len(text or b"")
    if start < len(texts):
        yield start, len(texts)


_DDL = {pa.int64(): "bigint", pa.int32(): "int", pa.float64(): "double", pa.string(): "string", pa.binary(): "binary", pa.bool_(): "boolean"}


def ddl(kind: pa.DataType) -> str:
    """The Spark name of an Arrow type."""
    if pa.types.is_list(kind):
        return f"array<{ddl(kind.value_type)}>"
    if pa.types.is_struct(kind):
        return f"struct<{', '.join(f'`{f.name}`: {ddl(f.type)}' for f in kind)}>"
    return _DDL[kind]


def map_texts(docs: DataFrame, column: str, keep: list[str], fields: dict[str, pa.DataType],
              make: Callable[[], Callable[[list[bytes], pa.RecordBatch], list]], most: int = 4_000_000) -> DataFrame:
    """``keep`` columns of ``docs``, unchanged, with ``fields`` that a function gives for whole texts.

    ``make`` builds the function once a task. It is called with UTF-8 texts (NULL as empty) of at most ``most`` bytes together, or one
    longer text, and their kept rows, and returns a tuple of field values for each text.
    """
    kept = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            texts = batch.column(len(keep)).cast(pa.binary()).to_pylist()
            for start, end in text_slices(texts, most):
                rows = batch.slice(start, end - start)
                columns = zip(*function([t or b"" for t in texts[start:end]], rows))
                found = [pa.array(values, type=kind) for values, kind in zip(columns, fields.values())]
                yield pa.RecordBatch.from_arrays([*rows.columns[:len(keep)], *found], names=[*keep, *fields])

    text = F.col(f"`{column}`").cast("string").alias("__text")
    return docs.select(*[F.col(f"`{c}`") for c in keep], text).mapInArrow(
        run, ", ".join([*kept, *(f"`{name}` {ddl(kind)}" for name, kind in fields.items())]))
