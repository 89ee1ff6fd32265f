"""Shared pieces of the corpus operators: intermediate tables, connected
components, and the rounds that turn signature buckets into links.

Intermediate results are written as Parquet under the shared folder the
cluster names in ``spark.checkpoint.dir`` and read back. That cuts lineage, so
a lost executor costs a re-read rather than a recomputation of everything, and
it gives the optimiser true sizes.
"""

from __future__ import annotations

import contextlib
import functools
import gc
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: ASCII white space that separates words: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


#: Spark's setting that deletes the files of a query's shuffles when the query ends.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session inside the block, as it was after it."""
    was = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, was)


class Scratch:
    """Intermediate tables of one operator call, in one fresh shared folder."""

    def __init__(self, spark: SparkSession, name: str, shuffles_go: bool = False):
        self.spark = spark
        self.shuffles_go = shuffles_go
        self.root = scratch_path(spark, name)
        self._n = 0

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the frame that reads it back. What earlier tables were made
        of is let go first: its shuffles free the disk, its plans and broadcasts the driver.
        With ``shuffles_go`` Spark deletes the shuffles of the write when it is done; what the driver
        collects goes a table later, since Python tells the JVM of it with a delay."""
        self.release()
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        with _setting(self.spark, SHUFFLES_GO, "true") if self.shuffles_go else contextlib.nullcontext():
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._llm_path = path
        return out

    def release(self) -> None:
        release(self.spark)

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables of this folder that nothing reads any more."""
        for df in frames:
            delete_path(self.spark, df._llm_path)

    def close(self) -> None:
        """Delete the whole folder; only for results that no longer read it."""
        delete_path(self.spark, self.root)


def release(spark: SparkSession) -> None:
    """Have the files of shuffles, and the broadcasts, that no frame needs any more deleted
    now. Spark does so when the driver's garbage collector finds them unreachable, which on
    a quiet driver can be long after a table replaced them; until then they, and what the
    driver remembers of every small job, make its heap grow. Many at once are also many threads."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system of its own scheme."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def scratch(spark: SparkSession, name: str, shuffles_go: bool = False) -> Iterator[Scratch]:
    """A scratch folder deleted when the block raises; a returned frame still
    reads it, so on success the caller's driver keeps it until it is done."""
    s = Scratch(spark, name, shuffles_go)
    try:
        yield s
    except BaseException:
        s.close()
        raise


def aside(docs: DataFrame, names: Iterable[str], work: Callable[[DataFrame], DataFrame], *inputs: str) -> DataFrame:
    """``work(docs)``, where columns of ``docs`` named like ``names`` (what the work adds or uses
    inside) step aside under other names. In the result they have their own names again, unless
    the work has put a column of that name there: then that one stays. ``inputs`` are columns
    that the work reads."""
    wanted = {n.lower() for n in names} - {n.lower() for n in inputs}
    taken = {c: f"_aside_{i}_{c}" for i, c in enumerate(docs.columns) if c.lower() in wanted}
    if not taken:
        return work(docs)
    out = work(docs.withColumnsRenamed(taken))
    made = {c.lower() for c in out.columns}
    out = out.drop(*[held for c, held in taken.items() if c.lower() in made])
    return out.withColumnsRenamed({held: c for c, held in taken.items()})


def own_names(*names: str):
    """An operator on ``docs`` whose result or inner work has columns of these names: see
    :func:`aside`. Columns that its arguments name are its input."""

    def decorate(operator):
        @functools.wraps(operator)
        def run(docs: DataFrame, *args, **options) -> DataFrame:
            given = [x for x in (*args, *options.values()) if isinstance(x, str)]
            return aside(docs, names, lambda d: operator(d, *args, **options), *given)

        return run

    return decorate


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows of a written table up to which it may be broadcast (a few narrow columns:
#: some 32 MB at most). Larger ones are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a written, narrow table of at most ``rows`` rows (a
    count from Parquet footers, taken once); else the frame as it is."""
    if "_llm_rows" not in vars(table):
        table._llm_rows = table.count()
    return F.broadcast(table) if table._llm_rows <= rows else table


def connected_components(edges: DataFrame, work: Scratch, max_rounds: int = 60) -> DataFrame:
    """``(id, comp)`` for every vertex of ``edges(a, b)``; ``comp`` is the
    smallest id reachable. A distributed union-find by alternating large-star
    and small-star rounds: each round re-hangs every vertex on the smallest
    neighbour it knows, so paths halve and the rounds grow with the logarithm
    of the component size. A hub's neighbours are never gathered: the minimum
    is a partial aggregate and the re-hanging a join that adaptive execution
    may split. Empty edges give an empty result; self loops are ignored.
    """
    cur = work.table(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
            m = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
            return both.join(m, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        m = e.groupBy("a").agg(F.min("b").alias("m"))
        down = e.join(m, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return down.union(m.select("a", F.col("m").alias("b")))

    def state(e: DataFrame) -> tuple:
        r = e.agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("a", "b")).alias("x"),
            F.sum(F.xxhash64("b", "a").bitwiseAND(0xFFFFFF)).alias("s"),
        ).first()
        return tuple(r)

    before = state(cur)
    for _ in range(max_rounds):
        if not before[0]:
            break
        large = star(cur, True).where("a <> b")
        nxt = work.table(star(large, False).where("a <> b").distinct(), "stars")
        after = state(nxt)
        work.drop(cur)
        cur = nxt
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("connected_components did not converge")
    roots = cur.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("comp"))
    return cur.select(F.col("a").alias("id"), F.col("b").alias("comp")).union(roots)


def bucket_members(sigs: DataFrame) -> DataFrame:
    """``(sig, id, n)`` for the members of every signature bucket that holds at least two
    different ids, ``n`` of them; buckets with the same members are one.

    One shuffle of narrow rows; a bucket is sorted (and spilled), not gathered into one
    value. Like texts share many signatures, so most buckets repeat another's members:
    the bucket key becomes a 128-bit fingerprint of them, and copies fall away."""
    of_sig = Window.partitionBy("sig")
    several = (
        sigs.select("sig", "id")
        .withColumn("lo", F.min("id").over(of_sig))
        .withColumn("hi", F.max("id").over(of_sig))
        .where("lo <> hi")
        .select("sig", "id")
        .distinct()
    )
    marks = {
        "n": F.count(F.lit(1)).over(of_sig),
        "x": F.bit_xor(F.xxhash64("id")).over(of_sig),
        "y": F.bit_xor(F.xxhash64(F.lit("member"), "id")).over(of_sig),
    }
    return several.withColumns(marks).select(F.xxhash64("n", "x", "y").alias("sig"), "id", "n").distinct()


#: Members of a bucket up to which its pairs between components are checked directly.
SMALL_BUCKET = 8


def link_buckets(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    work: Scratch,
    refine: Callable[[DataFrame], DataFrame] | None = None,
    star_rounds: int = 1,
    near: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Components of the true links among bucket mates, without writing out all
    pairs of a bucket: ``(id, comp)`` for every id that has a link.

    ``members``: the written table of ``bucket_members``; with ``refine`` deleted when it is done.
    ``verify``: exact check; takes distinct ``(a, b)`` and returns the linked ones, written.
    ``refine``: from ``(lead, id, comp)``, the mates of leaders whose mates still span
    several components, the pairs ``(a, b)`` of different components that may link;
    every linked pair of mates must be among them.
    ``near``: drops pairs that cannot link, before they are written down.

    First each bucket's leader is checked against its other members; it is the member
    with most bucket mates, which for near copies is the text they were made from. Two
    bucket mates already in one component need no check of their own (the component
    cannot change), so only buckets that still span several components matter. With
    ``refine``, the pairs between components of buckets of at most ``SMALL_BUCKET`` members
    are checked, and of larger ones those that ``refine`` names. Without, such buckets get another
    leader, until the pairs left between components are no more than twice the bucket
    rows or the star rounds are used up; then all of them are checked. Either way no link
    between components is lost.
    """
    of_sig = Window.partitionBy("sig")
    score = members.groupBy("id").agg(F.sum("n").alias("score"))
    led = members.join(score, "id").withColumn("lead", F.max(F.struct("score", "id")).over(of_sig)["id"])
    star = work.table(led.where("id <> lead").groupBy("lead", "id").agg(F.max("n").alias("n")), "star")
    del score, led
    # Distinct as they are: a leader comes after its mates by score and id, in every bucket.
    checked = _pairs(star, "id", "lead")
    edges = verify(checked)
    if refine is not None:
        comp = work.table(connected_components(edges, work), "comp")
        of = broadcast_if_small(comp)
        # Small buckets cost at most a few pairs per row: those between components.
        small = members.where(F.col("n") <= SMALL_BUCKET).join(of, "id", "left")
        small = small.select("sig", "id", F.coalesce("comp", "id").alias("comp"))
        x, y = (small.select("sig", F.col("id").alias(k), F.col("comp").alias(f"c{k}")) for k in "ab")
        direct = x.join(y, "sig").where("a < b and ca <> cb").select("a", "b")
        # Each kind is written on its own, so that the shuffles of both are never there at once.
        direct = work.table(near(direct) if near is not None else direct, "direct")
        del small, x, y
        work.drop(members)
        mates = star.where(F.col("n") > SMALL_BUCKET).join(of, "id", "left")
        mates = mates.select("lead", "id", F.coalesce("comp", "id").alias("comp"))
        heads = of.select(F.col("id").alias("lead"), F.col("comp").alias("head"))
        mates = mates.join(heads, "lead", "left").withColumn("head", F.coalesce("head", "lead"))
        # Leaders whose mates span components: found by a maximum, which is combined before it is dealt.
        apart = mates.groupBy("lead").agg(F.max(F.col("comp") != F.col("head")).alias("apart")).where("apart")
        apart = work.table(apart.select("lead"), "apart")
        mates = work.table(mates.join(broadcast_if_small(apart), "lead").select("lead", "id", "comp"), "mates")
        refined = work.table(refine(mates), "refined")
        work.drop(mates, apart)
        fresh = refined.union(direct).distinct().join(checked, ["a", "b"], "left_anti")
        fresh = work.table(fresh, "pairs")
        work.drop(direct, refined, star)
        edges = edges.union(verify(fresh))
        return work.table(connected_components(edges, work), "comp")
    open_ = members
    for r in range(star_rounds + 1):
        comp = work.table(connected_components(edges, work), "comp")
        labelled = (
            open_.select("sig", "id")
            .join(broadcast_if_small(comp), "id", "left")
            .select("sig", "id", F.coalesce("comp", "id").alias("comp"))
        )
        spans = {
            "lo": F.min("comp").over(of_sig),
            "hi": F.max("comp").over(of_sig),
            "mates": F.count(F.lit(1)).over(of_sig),
            "same": F.count(F.lit(1)).over(Window.partitionBy("sig", "comp")),
            "lead": F.min_by(F.struct("id", "comp"), F.xxhash64("id", F.lit(r))).over(of_sig),
        }
        # Buckets within one component are done.
        open_ = work.table(labelled.withColumns(spans).where("lo <> hi").drop("lo", "hi"), "open")
        left = open_.agg(
            F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.col("mates") - F.col("same")), F.lit(0)).alias("cross")
        ).first()
        if not left["rows"]:
            return comp
        last = r == star_rounds or left["cross"] / 2 <= 2 * left["rows"]
        if last:
            x = open_.select("sig", F.col("id").alias("a"), F.col("comp").alias("ca"))
            y = open_.select("sig", F.col("id").alias("b"), F.col("comp").alias("cb"))
            pairs = x.join(y, "sig").where("a < b and ca <> cb").select("a", "b")
            pairs = near(pairs) if near is not None else pairs
        else:
            pairs = _pairs(open_.where("comp <> lead.comp"), "id", "lead.id")
        fresh = work.table(pairs.distinct().join(checked, ["a", "b"], "left_anti"), "pairs")
        edges = edges.union(verify(fresh))
        if last:
            return work.table(connected_components(edges, work), "comp")
        checked = checked.union(fresh)
    raise AssertionError("unreachable")


def _pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
