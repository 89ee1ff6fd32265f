"""As-of lookups for a table of instants (AGG-3 and WIN-2 with a ``toTs`` per request).

Time is cut into buckets, and a key's rows are dealt by bucket, so a key that holds a third
of all rows is worked on in as many tasks as it has buckets. What an instant needs from
before its bucket is carried: one row per key and bucket says what the key's last row there
was, and a window over those (a key's buckets, not its rows) hands it on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import packed_order, ts_micros

_DAY = 86_400


def _bucket(micros: Column, seconds: int) -> Column:
    return F.floor(micros / F.lit(seconds * 1_000_000)).cast("long")


def _present(keys: Sequence[str]) -> Column:
    """A row without a key matches nothing."""
    ok = F.lit(True)
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return ok


def as_of(
    instants: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    at: str = "at",
    ts: str = "ts",
    tiebreak: str | None = None,
    bucket_seconds: int = _DAY,
) -> DataFrame:
    """Every instant with the ``values`` of its key's last row at or before it.

    The columns of ``instants``, then ``values`` and ``as_of`` (the matched row's ``ts``), null
    where there is no such row; a matched row's null stays null. Rows of one time are told
    apart by ``tiebreak``, the greatest being the last. Instants are kept one by one, repeated
    and null ones too; names of ``values`` must not occur in ``instants``.

    ``bucket_seconds``: choose it so that a key's rows of one bucket suit a task.
    """
    clash = {*values, "as_of"} & set(instants.columns)
    if clash:
        raise ValueError(f"names that instants have already: {sorted(clash)}")
    names = [*values, "as_of"]
    found = F.struct(*values, F.col(ts).alias("as_of"))
    tie = F.col(tiebreak).cast("long") if tiebreak else F.lit(0).cast("long")
    right = rows.where(_present(keys) & F.col(ts).isNotNull()).select(
        *keys, ts_micros(ts).alias("_t"), tie.alias("_tie"), found.alias("_found")
    )
    right = right.withColumn("_b", _bucket(F.col("_t"), bucket_seconds))
    left = instants.select(*keys, ts_micros(at).alias("_t"), F.struct(*instants.columns).alias("_row"))
    left = left.withColumn("_b", _bucket(F.col("_t"), bucket_seconds))

    # The last row of each bucket, and for buckets with instants the last one before it.
    order = packed_order(F.col("_t"), F.col("_tie"))
    # Value by value: a struct would make the aggregation sort.
    latest = right.groupBy(*keys, "_b").agg(*[F.max_by(f"_found.{c}", order).alias(f"_{n}") for n, c in enumerate(names)])
    last = latest.select(*keys, "_b", F.struct(*[F.col(f"_{n}").alias(c) for n, c in enumerate(names)]).alias("_found"))
    asked = left.where(_present(keys) & F.col("_b").isNotNull()).select(*keys, "_b").distinct()
    both = last.withColumn("_ask", F.lit(False)).unionByName(asked.withColumn("_ask", F.lit(True)), allowMissingColumns=True)
    earlier = Window.partitionBy(*keys).orderBy("_b").rangeBetween(Window.unboundedPreceding, -1)
    carry = both.withColumn("_carry", F.last("_found", ignorenulls=True).over(earlier)).where("_ask")
    carry = carry.where("_carry IS NOT NULL").select(*keys, "_b", "_carry")

    # Within a bucket, rows and instants in one order: an instant comes after rows of its time.
    met = right.withColumn("_is", F.lit(0)).unionByName(left.withColumn("_is", F.lit(1)), allowMissingColumns=True)
    upto = Window.partitionBy(*keys, "_b").orderBy("_t", "_is", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    met = met.withColumn("_here", F.last("_found", ignorenulls=True).over(upto)).where("_is = 1")
    out = met.join(carry, [*keys, "_b"], "left").withColumn("_hit", F.coalesce("_here", "_carry"))
    return out.select("_row.*", *[F.col(f"_hit.{c}").alias(c) for c in names])


def numbered(rows: DataFrame, keys: Sequence[str], ts: str, bucket_seconds: int = _DAY, name: str = "position") -> DataFrame:
    """``rows`` with their position by time within their key, from 0. Times must be unique
    within a key and not null.

    The positions of a bucket begin after the counts of the key's earlier buckets."""
    at = rows.withColumn("_b", _bucket(ts_micros(ts), bucket_seconds))
    counts = at.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    here = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(ts)) - 1
    out = at.withColumn("_here", here).join(counts, [*keys, "_b"])
    return out.withColumn(name, F.col("_before") + F.col("_here")).select(*rows.columns, name)


def last_n_as_of(
    requests: DataFrame,
    bars: DataFrame,
    limit: int,
    keys: Sequence[str],
    ids: Sequence[str],
    at: str = "to_ts",
    ts: str = "ts",
    bucket_seconds: int = _DAY,
) -> DataFrame:
    """WIN-2 for many requests: the last ``limit`` bars at or before each one's ``at``.

    ``ids`` (unique, keys included) name a request; the result has them and the columns of
    ``bars``, one row per request and bar. ``bars`` have unique times ``ts`` within a key.

    A request finds the position of its last bar (:func:`as_of`); the bars it wants are the
    ``limit`` positions up to there. They lie in at most two bins of ``limit`` positions, so
    the second join is an equi-join whatever the number of requests of a key."""
    placed = numbered(bars.where(_present(keys) & F.col(ts).isNotNull()), keys, ts, bucket_seconds, "_pos")
    asked = requests.select(*ids, F.col(at).alias("_at"))
    last = as_of(asked, placed.select(*keys, "_pos", F.col(ts).alias("_ts")), keys, ["_pos"], "_at", "_ts", None, bucket_seconds)
    last = last.where("_pos IS NOT NULL").select(*ids, F.col("_pos").alias("_last"))
    first = F.greatest(F.col("_last") - (limit - 1), F.lit(0))
    wants = last.withColumn("_first", first).withColumn(
        "_bin", F.explode(F.sequence(F.floor(F.col("_first") / limit), F.floor(F.col("_last") / limit)))
    )
    have = placed.withColumn("_bin", F.floor(F.col("_pos") / limit))
    met = wants.join(have, [*keys, "_bin"]).where("_pos BETWEEN _first AND _last")
    return met.select(*ids, *[c for c in bars.columns if c not in ids])
