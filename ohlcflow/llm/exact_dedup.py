"""Exact duplicates by a partitioned cuckoo-filter index of live content digests.

The text is normalised (runs of ASCII white space become one space) and hashed.
Its *digest* is 64 bits, its *content* the SHA-256. Digests fall into index
buckets; each bucket has a cuckoo filter over the digests of its live keys, and
its keys stored beside it (digest, content, keeper, count). An arriving row asks
the filter: a miss is new and is inserted; a hit is checked against the bucket's
stored content, so a false positive of the filter, or two contents with one
digest, is told apart. Deleting the last row of a key takes its fingerprint out.
When an insertion finds no room, the filter is rebuilt twice as large from the
stored keys.

An index is a frame of one row per bucket that can be written and read like any
other: ``(bucket, capacity, filter, keys)``. A bucket is one task's state, so
buckets are sized by row count (``BUCKET_KEYS`` distinct keys each, on average).
Before the shuffle each task folds the copies it has seen into one row per batch,
so a text that makes up a third of all rows costs a bucket one row per batch.

Edge cases: null counts as the empty text. Rows with equal id and content count
twice and are both kept or dropped by their id: the row kept is the one whose
doc_id is the smallest, null ids last; of rows equal in id and content one is
kept. Extra columns are ignored. An empty table gives an empty index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, scratch

#: Distinct keys of an index bucket, on average.
BUCKET_KEYS = 100_000
#: Slots of a filter bucket, bits of a fingerprint, evictions before a resize.
SLOTS, FINGERPRINT_BITS, MAX_KICKS = 4, 16, 200

_MASK = (1 << 64) - 1
_KEY = "struct<digest:long, content:binary, keeper:long, n:long>"
INDEX_SCHEMA = f"bucket long, capacity long, filter binary, keys array<{_KEY}>"


def normalised(text: Column) -> Column:
    """Runs of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


class CuckooFilter:
    """Fingerprints of 64-bit digests, two candidate buckets each; supports
    deletion of a digest that is in it. ``insert`` returns False when full."""

    def __init__(self, capacity: int, table: bytes | None = None):
        buckets = 1
        while buckets * SLOTS < capacity:
            buckets *= 2
        self.mask = buckets - 1
        self.capacity = buckets * SLOTS
        self.table = (
            np.zeros((buckets, SLOTS), np.uint16)
            if table is None
            else np.frombuffer(table, np.uint16).reshape(buckets, SLOTS).copy()
        )

    def _places(self, digest: int) -> tuple[int, int, int]:
        h = (digest & _MASK) * 0x9E3779B97F4A7C15 & _MASK
        mark = (h >> 48) or 1
        i = (h >> 16) & self.mask
        return mark, i, self._other(i, mark)

    def _other(self, i: int, mark: int) -> int:
        return (i ^ (mark * 0x5BD1E995)) & self.mask

    def __contains__(self, digest: int) -> bool:
        mark, i, j = self._places(digest)
        return mark in self.table[i].tolist() or mark in self.table[j].tolist()

    def insert(self, digest: int) -> bool:
        mark, i, j = self._places(digest)
        for k in (i, j):
            row = self.table[k].tolist()
            if 0 in row:
                self.table[k, row.index(0)] = mark
                return True
        at = i
        for kick in range(MAX_KICKS):
            slot = (mark + kick) % SLOTS
            out = int(self.table[at, slot])
            self.table[at, slot] = mark
            mark, at = out, self._other(at, out)
            row = self.table[at].tolist()
            if 0 in row:
                self.table[at, row.index(0)] = mark
                return True
        # The displaced mark is lost here; the caller rebuilds from stored keys.
        return False

    def delete(self, digest: int) -> bool:
        mark, i, j = self._places(digest)
        for k in (i, j):
            row = self.table[k].tolist()
            if mark in row:
                self.table[k, row.index(mark)] = 0
                return True
        return False


class BucketIndex:
    """One index bucket: the filter and the stored keys behind it."""

    def __init__(self, capacity: int = 1024):
        self.filter = CuckooFilter(capacity)
        self.keys: dict[int, list[list]] = {}
        self.resizes = 0

    @classmethod
    def load(cls, capacity: int, table: bytes, keys) -> BucketIndex:
        self = cls(1)
        self.filter = CuckooFilter(capacity, table)
        for k in keys:
            self.keys.setdefault(k["digest"], []).append([bytes(k["content"]), k["keeper"], k["n"]])
        return self

    def _find(self, digest: int, content: bytes) -> list | None:
        if digest not in self.filter:
            return None
        return next((k for k in self.keys.get(digest, ()) if k[0] == content), None)

    def insert(self, digest: int, content: bytes, keeper: int | None, n: int) -> None:
        """Add ``n`` rows of a content, the smallest id of which is ``keeper``."""
        key = self._find(digest, content)
        if key is not None:
            key[2] += n
            if key[1] is None or keeper is not None and keeper < key[1]:
                key[1] = keeper
            return
        self.keys.setdefault(digest, []).append([content, keeper, n])
        if not self.filter.insert(digest):
            self._resize()

    def delete(self, digest: int, content: bytes, keeper: int | None, n: int) -> int:
        """Remove up to ``n`` rows of a content, the smallest id of which is
        ``keeper``; returns how many it had."""
        key = self._find(digest, content)
        if key is None:
            return 0
        gone = min(n, key[2])
        key[2] -= gone
        if keeper is not None and keeper == key[1]:
            key[1] = None
        if not key[2]:
            rest = [k for k in self.keys[digest] if k is not key]
            self.filter.delete(digest)
            if rest:
                self.keys[digest] = rest
            else:
                del self.keys[digest]
        return gone

    def _resize(self) -> None:
        """A filter twice as large, from the stored keys."""
        capacity = self.filter.capacity * 2
        while True:
            self.resizes += 1
            self.filter = CuckooFilter(capacity)
            if all(self.filter.insert(d) for d, ks in self.keys.items() for _ in ks):
                return
            capacity *= 2

    def rows(self) -> list[dict]:
        return [
            {"digest": d, "content": c, "keeper": keeper, "n": n}
            for d, ks in self.keys.items()
            for c, keeper, n in ks
        ]


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, digest, content)`` of every row."""
    text = normalised(F.col(text_col))
    sha = F.unhex(F.sha2(text, 256))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), sha.alias("content")).select(
        "doc_id", F.xxhash64("content").alias("digest"), "content"
    )


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies within a batch as one row: (digest, content, keeper, n)."""
    for b in batches:
        t = pa.Table.from_batches([b]).group_by(["digest", "content"]).aggregate([("doc_id", "min"), ("digest", "count")])
        t = t.select(["digest", "content", "doc_id_min", "digest_count"]).rename_columns(["digest", "content", "keeper", "n"])
        yield from t.combine_chunks().to_batches()


def _index_row(bucket: int, index: BucketIndex) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "bucket": [bucket],
            "capacity": [index.filter.capacity],
            "filter": [index.filter.table.tobytes()],
            "keys": [index.rows()],
        }
    )


def _apply(key, old: pd.DataFrame, ops: pd.DataFrame) -> pd.DataFrame:
    """One bucket: the stored index, if any, with the changes made."""
    bucket = int(key[0])
    if len(old):
        o = old.iloc[0]
        index = BucketIndex.load(int(o["capacity"]), o["filter"], o["keys"])
    else:
        index = BucketIndex()
    for row in ops.itertuples(index=False):
        change = index.delete if row.delete else index.insert
        keeper = int(row.keeper) if row.named else None
        change(int(row.digest), bytes(row.content), keeper, int(row.n))
    return _index_row(bucket, index)


class DedupIndex:
    """A live index over a corpus: build, insert, delete, look up.

    ``state`` is the frame of index buckets; ``n_buckets`` is fixed at the build.
    Each change returns a new index, written to the shared folder.
    """

    def __init__(self, state: DataFrame, n_buckets: int, work):
        self.state, self.n_buckets, self._work = state, n_buckets, work

    @classmethod
    def empty(cls, spark, n_rows: int) -> DedupIndex:
        """An index with room for about ``n_rows`` distinct contents (it grows)."""
        with scratch(spark, "dedup") as work:
            return cls(spark.createDataFrame([], INDEX_SCHEMA), max(32, -(-n_rows // BUCKET_KEYS)), work)

    def _bucket(self) -> Column:
        return F.pmod(F.shiftrightunsigned("digest", 20), F.lit(self.n_buckets))

    def _changed(self, rows: DataFrame, delete: bool = False, counted: bool = True) -> DedupIndex:
        folded = rows.select("doc_id", "digest", "content").mapInArrow(
            _fold, "digest long, content binary, keeper long, n long"
        )
        ops = folded.select(
            self._bucket().alias("bucket"),
            "digest",
            "content",
            # Pandas has no null integers: a flag says whether there is an id.
            F.coalesce("keeper", F.lit(0).cast("long")).alias("keeper"),
            F.col("keeper").isNotNull().alias("named"),
            (F.col("n") if counted else F.lit(0).cast("long")).alias("n"),
            F.lit(delete).alias("delete"),
        )
        state = (
            self.state.groupBy("bucket")
            .cogroup(ops.groupBy("bucket"))
            .applyInPandas(_apply, INDEX_SCHEMA)
        )
        return DedupIndex(self._work.table(state, "index"), self.n_buckets, self._work)

    def insert(self, docs: DataFrame, **cols: str) -> DedupIndex:
        return self._changed(digests(docs, **cols))

    def delete(self, docs: DataFrame, **cols: str) -> DedupIndex:
        """Take rows out, one live row of their content each. A content whose keeper
        goes while copies live on has no keeper until ``elect``."""
        return self._changed(digests(docs, **cols), delete=True)

    def elect(self, live: DataFrame, **cols: str) -> DedupIndex:
        """Name keepers among ``live`` rows that the index holds already."""
        return self._changed(digests(live, **cols), counted=False)

    def keys(self) -> DataFrame:
        """``(digest, content, keeper, n)`` of the live contents."""
        return self.state.select(F.explode("keys").alias("k")).select("k.*")

    def lookup(self, rows: DataFrame) -> DataFrame:
        """``rows`` of ``digests`` with ``keeper`` and ``n`` of their live content, null
        where there is none."""
        keys = self.keys().select(F.col("digest").alias("_d"), F.col("content").alias("_c"), "keeper", "n")
        same = (rows["digest"] == F.col("_d")) & (rows["content"] == F.col("_c"))
        return rows.join(keys, same, "left").drop("_d", "_c")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, content)`` of every row; ``content`` is the
    SHA-256 of the normalised text."""
    spark = docs.sparkSession
    with scratch(spark, "dedup") as work:
        rows = work.table(digests(docs, id_col, text_col), "digests")
        index = DedupIndex(spark.createDataFrame([], INDEX_SCHEMA), max(32, -(-rows.count() // BUCKET_KEYS)), work)
        index = index._changed(rows)
        # Contents of one row need no group; the others are few and narrow.
        groups = work.table(index.keys().where("n > 1"), "groups")
        g = groups.select(F.col("digest").alias("_d"), F.col("content").alias("_c"), "keeper", "n")
        same = (rows["digest"] == F.col("_d")) & (rows["content"] == F.col("_c"))
        out = rows.join(broadcast_if_small(g), same, "left")
        alone = F.col("_d").isNull()
        out = out.select(
            "doc_id",
            F.when(alone, F.col("doc_id")).otherwise(F.col("keeper")).alias("keep_id"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
            "content",
            alone.alias("_alone"),
        )
        # Of rows equal in id and content, one stays.
        first = out.where("doc_id <=> keep_id and not _alone")
        again = work.table(first.groupBy("doc_id", "content").count().where("count > 1"), "again")
        kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
        if again.isEmpty():
            return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "content")
        marks = again.select(F.col("doc_id").alias("_i"), F.col("content").alias("_c"))
        out = out.join(
            broadcast_if_small(marks), F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("content") == F.col("_c")), "left"
        )
        rank = F.row_number().over(Window.partitionBy("_i", "_c").orderBy("group_size"))
        plain = out.where("_c is null").withColumn("kept", kept)
        copies = out.where("_c is not null").withColumn("kept", rank == 1)
        names = ["doc_id", "keep_id", "group_size", "kept", "content"]
        return plain.select(*names).union(copies.select(*names))
