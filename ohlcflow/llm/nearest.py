"""Approximate nearest neighbours by inner product with cross-polytope hashing.

**Index.** A vector is scaled to length 1, padded to a power of two and turned by fast
Hadamard pseudo-rotations (three rounds of sign flips and a Hadamard transform). Its hash
is the nearest signed axis; several rotations in a row, the last of them over fewer axes,
make as many buckets as keep the mean bucket near ``BUCKET_ROWS`` however many rows there
are. ``TABLES`` independent tables hold every row.

**Probing.** A query's loss for an axis is what its greatest coordinate has over that one;
a bucket's loss is the sum over its rotations. A query probes every bucket of every table
whose loss is at most ``reach``. The reach is fitted: for at most ``SAMPLE`` query vectors
the true neighbours are found by brute force in one pass over all rows, and the reach is
the least at which ``RECALL`` of them lie in a probed bucket. Data without structure (unit
vectors in all directions) need a large one; the recall does not depend on it.

**Reranking.** Rows of a bucket, and the queries that probe it, meet in one group of at
most a few times ``GROUP_ROWS`` rows; larger buckets are cut into pieces and their queries
go to each. A task holds one group's rows and streams its queries over them, so memory is
bounded on both sides. Inner products select; what is left is scored again in double
precision, summed in the order of the components, and only the best of each group leave it.
With many groups the same search runs over a share of the rows first (one in the square root
of the groups): what a query finds there bounds its best from below, and groups of the whole
index send only what reaches that floor. The result is the same with and without.
Queries that found fewer than ``k`` rows search once more without a limit on the loss.

Equal vectors are one class: it is searched once and stands for its ``k + 1`` smallest ids,
so a vector that makes up a third of all rows costs one row.

Edge cases: vectors that are null, empty, zero, of another than the commonest length, or
hold null or non-finite components take no part, nor do rows without an id. Rows that share
an id are rows of their own: each is a query, and a candidate to the other. Ties go to the
smaller id. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import mix
from .common import Scratch, broadcast_if_small, scratch, shuffle_width
from .vectors import matrix, matrix_blocks, usable_vectors

TABLES = 2
#: Mean rows of a bucket.
BUCKET_ROWS = 256
#: Mean rows of a group: what a task holds at a time.
GROUP_ROWS = 8192
#: Query vectors the reach is fitted on, and the share of their neighbours it must cover.
SAMPLE = 256
RECALL = 0.95
#: Parts into which a class of equal vectors is dealt where its rows are gathered.
SALTS = 16
#: Queries scored at a time in a task.
QUERY_ROWS = 256

_U = np.uint64


def _hadamard(x: np.ndarray) -> np.ndarray:
    rows, d = x.shape
    half = 1
    while half < d:
        y = x.reshape(rows, d // (2 * half), 2, half)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(rows, d)
        half *= 2
    return x / math.sqrt(d)


class Polytopes:
    """The hash functions for vectors of ``dim`` components and about ``n`` rows."""

    def __init__(self, dim: int, n: int, tables: int = TABLES):
        self.dim, self.tables = dim, tables
        self.size = 1 << max(dim - 1, 0).bit_length()
        # Axes of each rotation: as many buckets as rows ask for.
        self.axes, left = [], n / BUCKET_ROWS
        while left >= 2:
            self.axes.append(min(self.size, 1 << (int(left // 2).bit_length() - 1)))
            left /= 2 * self.axes[-1]
        self.buckets = math.prod(2 * a for a in self.axes)

    def _signs(self, table: int, part: int, turn: int) -> np.ndarray:
        seed = ((table * 64 + part) * 3 + turn) << 32
        bits = mix(np.arange(self.size, dtype=_U) + _U(seed + 1))
        return 1.0 - 2.0 * (bits >> _U(63)).astype(np.float64)

    def losses(self, x: np.ndarray, table: int) -> list[np.ndarray]:
        """Per rotation, the loss of every signed axis: ``2 axis + (1 if positive)``."""
        scale = np.abs(x).max(axis=1, keepdims=True)
        unit = x / scale
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        padded = np.zeros((len(x), self.size))
        padded[:, : self.dim] = unit
        out = []
        for part, axes in enumerate(self.axes):
            y = padded
            for turn in range(3):
                y = _hadamard(y * self._signs(table, part, turn))
            y = y[:, :axes]
            both = np.stack([-y, y], axis=2).reshape(len(x), 2 * axes)
            out.append(both.max(axis=1, keepdims=True) - both)
        return out

    def codes(self, x: np.ndarray, table: int) -> np.ndarray:
        """The bucket of each vector in a table; tables have buckets of their own."""
        code = np.full(len(x), table, np.int64)
        for loss in self.losses(x, table):
            code = code * loss.shape[1] + loss.argmin(axis=1)
        return code

    def probes(self, x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """``(row, bucket)`` of every bucket within reach, by row."""
        rows, codes = [], []
        for table in range(self.tables):
            row = np.arange(len(x))
            code, spent = np.full(len(x), table, np.int64), np.zeros(len(x))
            for loss in self.losses(x, table):
                total = spent[:, None] + loss[row]
                at, axis = np.nonzero(total <= reach)
                code, spent, row = code[at] * loss.shape[1] + axis, total[at, axis], row[at]
            rows.append(row)
            codes.append(code)
        row, code = np.concatenate(rows), np.concatenate(codes)
        order = np.argsort(row, kind="stable")
        return row[order], code[order]

    def least_loss(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Loss at which each query vector's probing reaches the bucket of its ``x``."""
        best = np.full(len(q), np.inf)
        for table in range(self.tables):
            spent = np.zeros(len(q))
            for ql, xl in zip(self.losses(q, table), self.losses(x, table)):
                spent += np.take_along_axis(ql, xl.argmin(axis=1)[:, None], 1)[:, 0]
            best = np.minimum(best, spent)
        return best


def _dots(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed in the order of the components; infinite where
    they are past a double's range."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = q[:, 0] * x[:, 0]
        for j in range(1, q.shape[1]):
            out += q[:, j] * x[:, j]
    return out


def _scaled(v: np.ndarray, by_row: bool) -> np.ndarray:
    """Vectors with components up to 1: of each row, or of all by one factor. Neither
    changes the order of a query's inner products, and none can overflow."""
    return v / np.abs(v).max(axis=1 if by_row else None, keepdims=True)


def _best(s: np.ndarray, k: int, slack: np.ndarray, floor: np.ndarray | float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` greatest of each row, at least ``floor``, with whatever
    is within ``slack`` of that; -inf marks what is no candidate."""
    least = np.full(len(s), floor)
    if s.shape[1] > k:
        least = np.maximum(least, np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k])
    return np.nonzero((s >= (least - slack)[:, None]) & (s > -np.inf))


def _slack(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """More than the rounding of any inner product with a row of ``x``."""
    length = np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max(initial=0.0)
    return 4e-16 * (q.shape[1] + 4) * length


def _first(group: np.ndarray, k: int) -> np.ndarray:
    """Whether each entry is among the first ``k`` of its run of the sorted ``group``."""
    start = np.searchsorted(group, group, side="left")
    return np.arange(len(group)) - start < k


def _top(row, score, head, k1, k2, k: int) -> np.ndarray:
    """Indices of the ``k`` best classes of each row, each once: best score, then smallest
    head, first."""
    order = np.lexsort((k2, k1, head, -score, row))
    r, a, b = row[order], k1[order], k2[order]
    again = np.zeros(len(order), bool)
    again[1:] = (r[1:] == r[:-1]) & (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    order = order[~again]
    return order[_first(row[order], k)]


_COLS = ("k1", "k2", "head")


def _named(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names]


def _sample_task(model: Polytopes, q: np.ndarray, own: np.ndarray, k: int):
    """Brute force of the sample: the best ``k`` rows of the task for each sample query,
    with the loss at which they would be found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        for batch in batches:
            for part, x in matrix_blocks(batch, "vector", model.dim):
                k1, k2, head = _named(part, *_COLS)
                unit, some = _scaled(q, True), _scaled(x, False)
                at, col = _best(unit @ some.T, k + 1, _slack(unit, some))
                other = (k1[col] != own[at, 0]) | (k2[col] != own[at, 1])
                at, col = at[other], col[other]
                found = [at, _dots(q[at], x[col]), head[col], k1[col], k2[col], model.least_loss(q[at], x[col])]
                if kept is not None:
                    found = [np.concatenate(c) for c in zip(kept, found)]
                best = _top(*found[:5], k)
                kept = [c[best] for c in found]
        if kept is not None:
            names = ["row", "score", "head", "k1", "k2", "loss"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in kept], names=names)

    return run


def _index_task(model: Polytopes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in matrix_blocks(batch, "vector", model.dim):
                for table in range(model.tables):
                    code = pa.array(model.codes(x, table))
                    yield pa.RecordBatch.from_arrays([*part.columns, code], names=[*part.schema.names, "bucket"])

    return run


def _probe_task(model: Polytopes, reach: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, q in matrix_blocks(batch, "vector", model.dim):
                for i in range(0, len(q), QUERY_ROWS):
                    some = part.slice(i, QUERY_ROWS)
                    row, code = model.probes(q[i : i + QUERY_ROWS], reach)
                    k1, k2 = _named(some, "k1", "k2")
                    cols = [pa.array(k1[row]), pa.array(k2[row]), pa.array(code)]
                    yield pa.RecordBatch.from_arrays(cols, names=["k1", "k2", "bucket"])

    return run


_FOUND = "q1 long, q2 long, k1 long, k2 long, head long, score double"


def _search_task(dim: int, k: int, tables: int):
    """Rows of a partition come by group, its indexed rows (sorted by bucket) before its
    queries: the former are kept, the latter stream over them."""

    def scored(parts: list[pa.RecordBatch], batch: pa.RecordBatch) -> pa.RecordBatch | None:
        index = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        x = matrix(index.column(index.schema.get_field_index("vector")), dim)
        bucket, k1, k2, head = _named(index, "bucket", *_COLS)
        names, begin = np.unique(bucket, return_index=True)
        end = np.append(begin[1:], len(bucket))
        q = matrix(batch.column(batch.schema.get_field_index("vector")), dim)
        wanted = batch.column(batch.schema.get_field_index("buckets"))
        row = np.repeat(np.arange(len(q)), pc.list_value_length(wanted).to_numpy())
        probe = wanted.flatten().to_numpy()
        at = np.minimum(np.searchsorted(names, probe), len(names) - 1)
        hit = names[at] == probe
        order = np.argsort(at[hit], kind="stable")
        at, row = at[hit][order], row[hit][order]
        if not len(at):
            return None
        unit, some = _scaled(q, True), _scaled(x, False)
        s = np.full((len(q), len(x)), -np.inf)
        cut = np.flatnonzero(np.diff(at)) + 1
        for rows, b in zip(np.split(row, cut), at[np.append(0, cut)].tolist()):
            s[rows, begin[b] : end[b]] = unit[rows] @ some[begin[b] : end[b]].T
        floor = batch.column(batch.schema.get_field_index("floor")).to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore", invalid="ignore"):
            low = floor / (np.abs(q).max(axis=1) * np.abs(x).max())
        # A class is in a group once per table at most.
        r, c = _best(s, k * tables, _slack(unit, some), np.where(np.isfinite(low), low, -np.inf))
        score = _dots(q[r], x[c])
        keep = ~(score < floor[r])
        r, c, score = r[keep], c[keep], score[keep]
        best = _top(r, score, head[c], k1[c], k2[c], k)
        r, c, score = r[best], c[best], score[best]
        q1, q2 = _named(batch, "k1", "k2")
        cols = [q1[r], q2[r], k1[c], k2[c], head[c], score]
        return pa.RecordBatch.from_arrays([pa.array(v) for v in cols], names=["q1", "q2", "k1", "k2", "head", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            group, query = _named(batch, "group", "query")
            cut = np.flatnonzero((np.diff(group) != 0) | (query[1:] != query[:-1])) + 1
            for i, j in zip(np.append(0, cut).tolist(), np.append(cut, len(group)).tolist()):
                if group[i] != now:
                    now, parts = group[i], []
                if not query[i]:
                    parts.append(batch.slice(i, j - i))
                elif parts:
                    for a in range(i, j, QUERY_ROWS):
                        out = scored(parts, batch.slice(a, min(QUERY_ROWS, j - a)))
                        if out is not None:
                            yield out

    return run


def _keyed(rows: DataFrame) -> DataFrame:
    """``(id, k1, k2, vector)``: a 128-bit key of each vector."""
    v = F.col("vector")
    return rows.select("id", F.xxhash64(v).alias("k1"), F.xxhash64(F.lit("vector"), v).alias("k2"), "vector")


def _classes(keyed: DataFrame, k: int, work: Scratch) -> tuple[DataFrame, DataFrame]:
    """``(classes, copies)`` of keyed rows: one row ``(k1, k2, head, vector)`` per distinct
    vector, and for those with several rows their number and ``k + 1`` smallest ids."""
    key = ["k1", "k2"]
    of = keyed.groupBy(*key).agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("rows"))
    several = work.table(of.where("rows > 1"), "several")
    if several.isEmpty():
        copies = keyed.sparkSession.createDataFrame([], "k1 long, k2 long, ids array<long>, rows long")
        return keyed.select(*key, F.col("id").alias("head"), "vector"), copies
    marked = keyed.join(broadcast_if_small(several), key, "left")
    single = marked.where("head IS NULL").select(*key, F.col("id").alias("head"), "vector")
    # Equal rows, ids included, leave one class.
    heads = marked.where("id = head").select(*key, "head", "vector").dropDuplicates(key)
    classes = work.table(single.union(heads), "classes")
    part = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    smallest = marked.where("head IS NOT NULL").select("id", *key, "rows", part.alias("part"))
    for by in ([*key, "part"], key):
        nth = F.row_number().over(Window.partitionBy(*by).orderBy("id"))
        smallest = smallest.withColumn("nth", nth).where(F.col("nth") <= k + 1).drop("nth")
    copies = smallest.groupBy(*key).agg(F.sort_array(F.collect_list("id")).alias("ids"), F.min("rows").alias("rows"))
    return classes, work.table(copies, "copies")


def _fit_reach(model: Polytopes, classes: DataFrame, queries: DataFrame, k: int) -> float:
    """The loss at which ``RECALL`` of the sample's true neighbours are found."""
    sample = queries.orderBy(F.xxhash64("k1", F.lit(1)), "k1", "k2").limit(SAMPLE).collect()
    q = np.array([r["vector"] for r in sample], np.float64).reshape(-1, model.dim)
    own = np.array([(r["k1"], r["k2"]) for r in sample], np.int64).reshape(-1, 2)
    schema = "row long, score double, head long, k1 long, k2 long, loss double"
    near = classes.mapInArrow(_sample_task(model, q, own, k), schema)
    best = Window.partitionBy("row").orderBy(F.desc("score"), "head", "k1", "k2")
    near = near.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k).select("loss")
    losses = np.sort([r["loss"] for r in near.collect()])  # at most SAMPLE * k
    if not len(losses):
        return math.inf
    # A hair more than the loss itself: the probing sums in another order.
    return float(losses[math.ceil(RECALL * len(losses)) - 1]) + 1e-9


def _search(model: Polytopes, classes: DataFrame, queries: DataFrame, n: int, reach: float, k: int, work: Scratch):
    """``(q1, q2, k1, k2, head, score)``: the ``k + 1`` best classes found by each query
    vector, its own among them."""
    none = F.lit(float("-inf"))
    share = math.isqrt(math.ceil(n * model.tables / GROUP_ROWS))
    if share < 2:
        return _found(model, classes, queries.withColumn("floor", none), n, reach, k, work)
    some = classes.where(F.pmod(F.xxhash64("k2"), F.lit(share)) == 0)
    some = _found(model, some, queries.withColumn("floor", none), n // share, reach, k, work)
    floor = F.when(F.count(F.lit(1)) > k, F.min("score")).otherwise(none)
    floors = some.groupBy(F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(floor.alias("floor"))
    asked = queries.join(floors, ["k1", "k2"], "left").withColumn("floor", F.coalesce("floor", none))
    return _found(model, classes, work.table(asked, "floors"), n, reach, k, work)


def _found(model: Polytopes, classes: DataFrame, queries: DataFrame, n: int, reach: float, k: int, work: Scratch):
    """One search of ``queries (k1, k2, vector, floor)`` over about ``n`` classes: the
    ``k + 1`` best found, those below a query's floor left out."""
    spark = classes.sparkSession
    kind = f"k1 long, k2 long, head long, vector {classes.schema['vector'].dataType.simpleString()}"
    index = classes.mapInArrow(_index_task(model), f"{kind}, bucket long")
    groups = max(1, math.ceil(n * model.tables / GROUP_ROWS))
    sizes = index.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    large = sizes.where(F.col("size") > GROUP_ROWS).select("bucket", F.ceil(F.col("size") / GROUP_ROWS).alias("pieces"))
    large = broadcast_if_small(work.table(large, "large"))
    pieces = F.coalesce("pieces", F.lit(1))

    def group(piece):
        return F.pmod(F.xxhash64("bucket", piece.cast("long")), F.lit(groups))

    indexed = index.join(large, "bucket", "left").select(
        group(F.pmod("k1", pieces)).alias("group"),
        F.lit(False).alias("query"),
        "bucket",
        F.lit(None).cast("array<long>").alias("buckets"),
        "k1", "k2", "head", "vector", F.lit(None).cast("double").alias("floor"),
    )
    probes = queries.mapInArrow(_probe_task(model, reach), "k1 long, k2 long, bucket long")
    probes = probes.join(large, "bucket", "left")
    probes = probes.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)))
    asked = probes.groupBy("k1", "k2", group(F.col("piece")).alias("group"))
    asked = asked.agg(F.collect_list("bucket").alias("buckets")).join(queries, ["k1", "k2"])
    asking = asked.select(
        "group", F.lit(True).alias("query"), F.lit(None).cast("long").alias("bucket"), "buckets", "k1", "k2",
        F.lit(None).cast("long").alias("head"), "vector", "floor",
    )
    width = min(groups, max(shuffle_width(spark), groups // 8))
    met = indexed.union(asking).repartition(width, "group").sortWithinPartitions("group", "query", "bucket")
    found = met.mapInArrow(_search_task(model.dim, k + 1, model.tables), _FOUND)
    best = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "head", "k1", "k2")
    found = found.dropDuplicates(["q1", "q2", "k1", "k2"]).withColumn("nth", F.row_number().over(best))
    return work.table(found.where(F.col("nth") <= k + 1).drop("nth"), "found")


def nearest(
    df: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest rows by inner product of every row for which ``is_query`` holds:
    ``query_id``, ``rank`` from 1, ``vec_id``, ``score``; every other row is a candidate.
    ``is_query``: a Column over the id column."""
    spark = df.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    with scratch(spark, "nearest") as work:
        rows, dim = usable_vectors(df, vector, id_col)
        if not dim:
            return empty
        named = [F.col(id_col).cast("long").alias("id"), F.col(vector).alias("vector")]
        some = F.col("id").isNotNull() & F.exists("vector", lambda x: x != 0)
        query_rows = _keyed(rows.where(is_query).select(*named).where(some))
        classes, copies = _classes(_keyed(rows.select(*named).where(some)), k, work)
        n = classes.count()
        key = ["k1", "k2"]
        queries = work.table(query_rows.dropDuplicates(key).select(*key, "vector"), "queries")
        if not n or queries.isEmpty():
            return empty
        model = Polytopes(dim, n)
        reach = _fit_reach(model, classes, queries, k) if model.axes else math.inf
        found = _search(model, classes, queries, n, reach, k, work)
        # Rows that each class found stands for.
        total = copies.agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("more")).first()["more"] + n
        many = broadcast_if_small(copies)

        def ranked(found: DataFrame) -> DataFrame:
            """Per query vector its best rows, ``k + 1`` of them where there are as many."""
            each = found.join(many, key, "left").select(
                "q1", "q2", "score",
                ((F.col("q1") == F.col("k1")) & (F.col("q2") == F.col("k2"))).alias("own"),
                F.posexplode(F.coalesce("ids", F.array("head"))).alias("nth", "vec_id"),
            )
            best = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "vec_id", "own", "nth")
            each = each.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
            cells = F.sort_array(F.collect_list(F.struct("place", "vec_id", "score", "own")))
            return each.groupBy(F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(cells.alias("near"))

        near = work.table(ranked(found), "near")
        full = min(k + 1, total)
        met = near.where(F.size("near") >= full).select(*key)
        short = work.table(queries.join(met, key, "left_anti"), "short")
        if reach < math.inf and not short.isEmpty():
            again = _search(model, classes, short, n, math.inf, k, work)
            near = near.where(F.size("near") >= full).union(work.table(ranked(again), "near"))
        # A class of copies may hold many queries: dealt over parts, its short list copied.
        hot = copies.select(*key, F.lit(True).alias("hot"))
        hot = broadcast_if_small(work.table(hot, "hot"))
        part = F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(F.lit(0))
        ask = query_rows.select("id", *key).join(hot, key, "left").select("id", *key, part.alias("part"))
        parts = F.sequence(F.lit(0), F.when(F.col("hot"), F.lit(SALTS - 1)).otherwise(F.lit(0)))
        near = near.join(hot, key, "left").withColumn("part", F.explode(parts))
        out = ask.join(near, [*key, "part"])
        # The query's own row is one occurrence of its id in its own class.
        mine = F.filter("near", lambda c: c["own"] & (c["vec_id"] == F.col("id")))
        place = F.coalesce(F.get(mine, F.lit(0))["place"], F.lit(0))
        others = F.slice(F.filter("near", lambda c: c["place"] != place), 1, k)
        out = out.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "c"))
        return out.select("query_id", (F.col("at") + 1).alias("rank"), "c.vec_id", "c.score")
