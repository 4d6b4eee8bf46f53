"""What the operators of this subpackage share: work tables, Arrow steps, words and hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from chainlake.session import configured, work_folder

# A batch for Python holds at most so many rows and bytes, so that long texts do not fill a worker's memory.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}
# A worker's cache of word hashes or encodings starts anew at this many entries; results do not depend on it.
CACHED_WORDS = 400_000

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def tuned(spark: SparkSession) -> SparkSession:
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    return configured(spark)


def saved(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """`df` written once to the shared folder and read from there: its lineage ends, and its size is known."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path, compression=compression)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.saved_at = path
    return found


def drop(*tables: DataFrame) -> None:
    """Delete tables of `saved` that nothing still to be computed reads."""
    for table in tables:
        spark = table.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(table.saved_at)
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def arrow_step(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """Run `step` over the Arrow batches of each partition; it yields columns as {name: list or array}."""
    fields = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in step(batches):
            arrays = [pa.array(columns[f.name], type=f.type) for f in fields]
            yield pa.RecordBatch.from_arrays(arrays, schema=fields)

    return df.mapInArrow(run, schema)


def raw_texts(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column's values as UTF-8, not decoded."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def values(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


class WordHashes(dict):
    """XXH64 of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one, so that their order says nothing about what they came from."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words, from the words' hashes; the words' order counts. None below k words."""
    n = len(words) - k + 1
    if n < 1:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    return mixed(total + np.uint64(k))
