"""Tables of foldable rows in buckets, to which each batch adds a part and in which too many parts become one.

A batch writes its rows below `generation=<batch>/bucket=<bucket>`, then commits by renaming one small file that lists, for each bucket, the
generations that hold it. Readers go by the last commit, so they see a batch whole or not at all, and what a failed batch left is
never read. A replayed batch starts from the commit before it and writes the same again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "bucket"
GENERATION = "generation"
_COMMITS = "_commits"


def _store(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder


def _commits(spark: SparkSession, path: str) -> list[int]:
    store, folder = _store(spark, f"{path}/{_COMMITS}")
    names = [f.getPath().getName() for f in store.listStatus(folder)] if store.exists(folder) else []
    return sorted(int(name) for name in names if name.isdecimal())


def _listed(spark: SparkSession, path: str, batch: int) -> dict[str, list[int]]:
    """{bucket: generations} of a commit; as many entries as there are buckets."""
    return json.loads(spark.read.text(f"{path}/{_COMMITS}/{batch}", wholetext=True).first()[0])


def _commit(spark: SparkSession, path: str, batch: int, listed: dict[str, list[int]]) -> None:
    store, target = _store(spark, f"{path}/{_COMMITS}/{batch}")
    _, private = _store(spark, f"{path}/{_COMMITS}/.{batch}")
    out = store.create(private, True)
    out.write(bytearray(json.dumps(listed).encode()))
    out.close()
    store.delete(target, False)
    if not store.rename(private, target):
        raise OSError(f"commit {batch} of {path} could not be renamed into place")


def _parts(spark: SparkSession, path: str, listed: dict[str, list[int]]) -> DataFrame:
    paths = [f"{path}/{GENERATION}={g}/{BUCKET}={b}" for b, found in sorted(listed.items()) for g in found]
    return spark.read.option("basePath", path).parquet(*paths).drop(GENERATION)


def bucket_numbers(rows: DataFrame, bucket: Column) -> set[int]:
    """The buckets that rows fall into: no more of them than there are buckets."""
    return set(rows.agg(F.collect_set(bucket)).first()[0])


def read(spark: SparkSession, path: str, before: int | None = None, buckets: set[int] | None = None) -> DataFrame | None:
    """All parts as of the last commit, or the last `before` a batch, not folded, without their bucket; of some `buckets`, or of all. None
    where there is no such part; without any commit and without `before`, an error."""
    commits = [c for c in _commits(spark, path) if before is None or c < before]
    if not commits:
        if before is not None:
            return None
        raise FileNotFoundError(f"nothing was committed below {path}")
    listed = _listed(spark, path, commits[-1])
    wanted = listed if buckets is None else {b: found for b, found in listed.items() if int(b) in buckets}
    return _parts(spark, path, wanted).drop(BUCKET) if wanted else None


def merge(
    rows: DataFrame, path: str, batch: int, fold: Callable[[DataFrame], DataFrame], bucket: Column, most: int = 4
) -> None:
    """Add `rows` as generation `batch`. `bucket` is made of what `fold` groups by; `fold` makes parts of a bucket one and takes repeated rows.

    A bucket that has `most` parts already is folded with what comes. Only buckets of `rows` are written.
    """
    spark = rows.sparkSession
    before = [c for c in _commits(spark, path) if c < batch]
    listed = _listed(spark, path, before[-1]) if before else {}
    full = {b: found for b, found in listed.items() if len(found) >= most}
    incoming = f"{path}/_incoming/{batch}"
    if full:
        # Which buckets the batch touches is known once it is read, so it is written and read back.
        rows.write.mode("overwrite").parquet(incoming)
        rows = spark.read.schema(rows.schema).parquet(incoming)
        touched = bucket_numbers(rows, bucket)
        due = {b: found for b, found in full.items() if int(b) in touched}
        listed = {b: found for b, found in listed.items() if b not in due}
        if due:
            mine = bucket.isin(*map(int, due))
            old = _parts(spark, path, due).drop(BUCKET)
            rows = fold(old.unionByName(rows.where(mine))).unionByName(rows.where(~mine))
    target = f"{path}/{GENERATION}={batch}"
    rows.withColumn(BUCKET, bucket).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(target)
    store, folder = _store(spark, target)
    written = [f.getPath().getName().partition("=")[2] for f in store.listStatus(folder) if f.isDirectory()]
    _commit(spark, path, batch, listed | {b: [*listed.get(b, []), batch] for b in written})
    store.delete(_store(spark, incoming)[1], True)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete what none of the last `keep` commits lists, and the commits before them; how many parts went. A replay needs one commit back,
    a reader that is under way the one it began with."""
    commits = _commits(spark, path)
    kept = {(g, b) for c in commits[-keep:] for b, found in _listed(spark, path, c).items() for g in found}
    store, folder = _store(spark, path)
    gone = 0
    for generation in store.listStatus(folder):
        name, _, number = generation.getPath().getName().partition("=")
        # A generation after the last commit is being written.
        if name != GENERATION or not commits or int(number) > commits[-1]:
            continue
        for part in store.listStatus(generation.getPath()):
            if part.isDirectory() and (int(number), part.getPath().getName().partition("=")[2]) not in kept:
                store.delete(part.getPath(), True)
                gone += 1
    for commit in commits[:-keep]:
        store.delete(_store(spark, f"{path}/{_COMMITS}/{commit}")[1], False)
    return gone
