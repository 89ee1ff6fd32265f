"""Mixing sources to target weights by Pareto order sampling.

Targets: sources in code-point order (null last) weigh by a repeating pattern and
share ``share`` times all words. A source's target stops at ``max_copies`` times
its own words; the excess is shared again by weight until none is above.

Selection: with ``r = target / words``, every document of a source has the
inclusion ``r * importance`` (importance 1 where no column is given; else scaled
so that the words add up to the target, with ``max_copies`` as the ceiling). Its
whole part is allocated as certain copies. The fraction ``p`` is the inclusion
probability of one more copy: documents are ranked by random odds over inclusion
odds, ``(u / (1 - u)) / (p / (1 - p))``, and taken in that order while their
words fit what the certain copies left of the target. One closing document, not
taken and of the size nearest to the gap, is added if that brings the sum nearer.
``u`` is a hash of the document id and the seed, so reruns agree.

The order of a source is never sorted in one task: rank keys fall into cells by
two levels of leading digits, cells are summed, and only the cell in which the
target is reached is looked into further; the last level sorts the few documents
of one cell.

So the choice is one cut-off rank and one closing document per source, and the
rows themselves are never joined or moved: each reads its source's line of a small
plan.

Edge cases: a null or word-less text has size 0 and is never taken. A null source
is a source of its own, the last. A null doc_id hashes as the empty text. Rows of
equal rank are told apart by id, size and text hash; rows equal in all of these
are taken or left together. Extra columns are ignored. An empty table, or one
without words, takes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import row_index
from .common import BROADCAST_ROWS, WORD, own_names, scratch

#: Digits of the rank key that make up a cell of the first and second level.
LEVEL_DIGITS = (3, 6)
#: Digits of the whole key.
KEY_DIGITS = 15


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 from the MD5 of ``seed:doc_id``; plain
    SQL on other engines gives the same."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_copies: float) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    The level ``budget / weight`` at which sources fill up is found by rounds of
    one aggregate each: sources that their share would overfill are capped, the
    rest shares what is left. Three sums per round reach the driver.
    """
    order = [F.col("source").isNull().cast("int"), F.col("source")]
    ranked = row_index(sizes, order, name="_mix_rank")
    w = F.element_at(
        F.array(*[F.lit(float(x)) for x in weights]), ((F.col("_mix_rank") - 1) % len(weights) + 1).cast("int")
    )
    ranked = ranked.withColumn("_mix_w", w).withColumn("_mix_cap", F.col("source_size") * F.lit(float(max_copies)))
    level = 0.0
    while True:
        full = F.col("_mix_w") * F.lit(level) >= F.col("_mix_cap")
        r = ranked.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(full, F.col("_mix_cap"))), F.lit(0.0)).alias("capped"),
            F.coalesce(F.sum(F.when(~full, F.col("_mix_w"))), F.lit(0.0)).alias("w"),
        ).first()
        if r["w"] == 0:
            break
        new = (share * r["total"] - r["capped"]) / r["w"]
        if new <= level:
            break
        level = new
    target = F.least(F.col("_mix_w") * F.lit(level), F.col("_mix_cap"))
    return ranked.select("source", "source_size", target.alias("target"))


def _measured(docs: DataFrame, seed: str, importance: str | None, cols: dict[str, str]) -> DataFrame:
    """``docs`` with what its rows need to be placed: ``_size``, ``_u``, ``_gain``, ``_tie``."""
    gain = F.greatest(F.coalesce(F.col(importance).cast("double"), F.lit(0.0)), F.lit(0.0)) if importance else F.lit(1.0)
    return docs.withColumns(
        {
            "_mix_size": n_words(F.col(cols["text"])),
            "_mix_u": uniform(F.col(cols["id"]), seed),
            "_mix_gain": gain,
            "_mix_tie": F.struct(
                F.coalesce(F.col(cols["id"]).cast("string"), F.lit("")).alias("id"),
                F.xxhash64(cols["text"]).alias("text"),
            ),
        }
    )


def _placed(rows: DataFrame, max_copies: float) -> DataFrame:
    """Adds ``_certain`` copies and ``_key``, the rank of the fraction (null: none).

    Needs ``_factor``, the source's target over its (weighted) words."""
    want = F.when(
        F.col("_mix_size") > 0, F.least(F.col("_mix_gain") * F.col("_mix_factor"), F.lit(float(max_copies)))
    ).otherwise(F.lit(0.0))
    rows = rows.withColumn("_mix_want", want).withColumn("_mix_certain", F.floor("_mix_want"))
    p = F.col("_mix_want") - F.col("_mix_certain")
    odds = (F.col("_mix_u") / (1 - F.col("_mix_u"))) / (p / (1 - p))
    # odds / (1 + odds) ranks as the odds do; fixed-width digits make a key that
    # sorts and splits into cells.
    digits = F.floor(odds / (1 + odds) * F.lit(10.0**KEY_DIGITS)).cast("string")
    return rows.withColumn("_mix_key", F.when(p > 0, F.lpad(digits, KEY_DIGITS, "0"))).drop("_mix_want")


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


#: Names of the result and of the inner work.
_NAMES = (
    "mix_size", "mix_source_size", "mix_target", "mix_copies",
    "_mix_c", "_mix_cap", "_mix_cell", "_mix_certain", "_mix_closing", "_mix_copy", "_mix_cut", "_mix_factor", "_mix_gain", "_mix_key", "_mix_rank", "_mix_s", "_mix_size", "_mix_source", "_mix_source_size", "_mix_src", "_mix_target", "_mix_tie", "_mix_u", "_mix_w", "_mix_want",
)


@own_names(*_NAMES)
def pareto_mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_copies: float = 2.0,
    seed: str = "mix",
    importance: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``docs`` with ``mix_size, mix_source_size, mix_target, mix_copies``: the words
    of each row, of its source, the source's target, and how many whole copies of
    the row the mix takes."""
    spark = docs.sparkSession
    cols = {"id": id_col, "text": text_col}
    with scratch(spark, "mix") as work:
        measured = _measured(docs, seed, importance, cols)
        rows = work.table(
            measured.select(F.col(source_col).alias("_mix_source"), "_mix_size", "_mix_u", "_mix_gain", "_mix_tie"), "rows"
        )
        per = work.table(
            rows.groupBy(F.col("_mix_source").alias("source")).agg(
                F.sum("_mix_size").alias("source_size"), F.sum(F.col("_mix_size") * F.col("_mix_gain")).alias("gained")
            ),
            "sources",
        )
        targets = source_targets(per.select("source", "source_size"), weights, share, max_copies)
        named = per.select(F.col("source").alias("_mix_s"), "gained")
        plan = work.table(
            targets.join(named, _same(F.col("source"), F.col("_mix_s")))
            .select(
                F.col("source").alias("_mix_src"), "source_size", "target",
                F.when(F.col("gained") > 0, F.col("target") / F.col("gained")).otherwise(0.0).alias("_mix_factor"),
            ),
            "plan",
        )
        # What follows has a line per source at most, too: counted once.
        few = F.broadcast if plan.count() <= BROADCAST_ROWS else (lambda lines: lines)
        del targets
        of_source = _same(F.col("_mix_source"), F.col("_mix_src"))
        placed = work.table(
            _placed(rows.join(few(plan.select("_mix_src", "_mix_factor")), of_source), max_copies)
            .select("_mix_source", "_mix_size", "_mix_tie", "_mix_certain", "_mix_key"),
            "placed",
        )
        given = placed.groupBy("_mix_source").agg(F.sum(F.col("_mix_certain") * F.col("_mix_size")).alias("given"))
        rest = work.table(
            plan.join(given, of_source).select("_mix_src", (F.col("target") - F.col("given")).alias("rest")), "rest"
        )
        # Descend to the cell of the key in which the words reach the rest.
        some = placed.where("_mix_key is not null")
        at = rest.select("_mix_src", F.lit("").alias("_mix_cell"), F.lit(0).cast("long").alias("before"), "rest")
        for digits in LEVEL_DIGITS:
            inside = some.join(few(at), of_source & F.col("_mix_key").startswith(F.col("_mix_cell")))
            cells = inside.groupBy("_mix_src", "before", "rest", F.substring("_mix_key", 1, digits).alias("next")).agg(
                F.sum("_mix_size").alias("words")
            )
            order = Window.partitionBy("_mix_src").orderBy("next")
            upto = F.col("before") + F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0))
            over = cells.withColumn("upto", upto).where("upto > rest")
            at = work.table(
                over.withColumn("n", F.row_number().over(order))
                .where("n = 1")
                .select("_mix_src", F.col("next").alias("_mix_cell"), (F.col("upto") - F.col("words")).alias("before"), "rest"),
                "cells",
            )
        # In that cell, the last rank that still fits with all its ties.
        rank = F.struct("_mix_key", "_mix_tie", "_mix_size").alias("rank")
        edge = some.join(few(at), of_source & F.col("_mix_key").startswith(F.col("_mix_cell")))
        by_rank = Window.partitionBy("_mix_src").orderBy("rank")
        fits = edge.select("_mix_src", "_mix_cell", "before", "rest", rank, "_mix_size").withColumn(
            "upto", F.col("before") + F.sum("_mix_size").over(by_rank.rangeBetween(Window.unboundedPreceding, 0))
        )
        cuts = fits.groupBy("_mix_src", "_mix_cell").agg(F.max(F.when(F.expr("upto <= rest"), F.col("rank"))).alias("_mix_cut"))
        lines = work.table(
            plan.join(cuts.withColumnRenamed("_mix_src", "_mix_c"), _same(F.col("_mix_src"), F.col("_mix_c")), "left").drop("_mix_c"),
            "lines",
        )
        # The closing document, among rows that are alone with their rank.
        chosen = placed.join(few(lines.select("_mix_src", "_mix_cell", "_mix_cut")), of_source).withColumn(
            "more", _fraction_taken()
        )
        got = chosen.groupBy("_mix_src").agg(F.sum(F.col("more") * F.col("_mix_size")).alias("got"))
        gaps = work.table(
            rest.join(got.withColumnRenamed("_mix_src", "_mix_c"), _same(F.col("_mix_src"), F.col("_mix_c")))
            .select("_mix_src", (F.col("rest") - F.col("got")).alias("gap")),
            "gaps",
        )
        left = chosen.where("more = 0 and _mix_key is not null").drop("_mix_src", "_mix_cell", "_mix_cut")
        off = F.abs(F.col("_mix_size") - F.col("gap"))
        near = (
            left.join(few(gaps), of_source)
            .where(off < F.abs(F.col("gap")))
            .groupBy("_mix_src", rank, off.alias("off"))
            .agg(F.count(F.lit(1)).alias("n"))
            .where("n = 1")
            .groupBy("_mix_src")
            .agg(F.min_by("rank", F.struct("off", "rank")).alias("_mix_closing"))
        )
        lines = work.table(
            lines.join(near.withColumnRenamed("_mix_src", "_mix_c"), _same(F.col("_mix_src"), F.col("_mix_c")), "left").drop("_mix_c"),
            "lines",
        )
        work.release()
        lines = lines.withColumnsRenamed({"source_size": "_mix_source_size", "target": "_mix_target"})
        out = measured.join(few(lines), _same(F.col(source_col), F.col("_mix_src")))
        out = _placed(out, max_copies)
        closing = _same(F.struct("_mix_key", "_mix_tie", "_mix_size"), F.col("_mix_closing"))
        more = F.when(closing, F.lit(1)).otherwise(_fraction_taken())
        return out.select(
            *docs.columns,
            F.col("_mix_size").alias("mix_size"),
            F.col("_mix_source_size").alias("mix_source_size"),
            F.col("_mix_target").alias("mix_target"),
            (F.col("_mix_certain").cast("long") + more).alias("mix_copies"),
        )


def _fraction_taken() -> Column:
    """1 where the row's rank is before its source's cut-off (``cell`` null: the
    source takes every fraction)."""
    rank = F.struct("_mix_key", "_mix_tie", "_mix_size")
    head = F.col("_mix_key").substr(F.lit(1), F.length("_mix_cell"))
    taken = (
        F.when(F.col("_mix_key").isNull(), False)
        .when(F.col("_mix_cell").isNull(), True)
        .when(head != F.col("_mix_cell"), head < F.col("_mix_cell"))
        .otherwise(F.coalesce(rank <= F.col("_mix_cut"), F.lit(False)))
    )
    return taken.cast("long")


@own_names(*_NAMES)
def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, columns unchanged."""
    plan = pareto_mix(docs, **options)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies")))
    return plan.where("mix_copies > 0").select(*docs.columns, times.alias("_mix_copy")).drop("_mix_copy")
