"""Licence scan by canonical digest lookup.

A text is brought to a canonical form: line by line it is lower-cased, lines that
state a copyright holder or year are dropped, punctuation becomes one space and
equivalent spellings become one; the lines left are joined, so wrapping does not
matter. The SHA-256 of the entire canonical text is hash-joined with the digests
of the known licences. Each line is also looked up as a text of its own: that
finds the one-line notices that end many documents.

The known table is a fixed list of this package (some dozens of rows), put
through the same canonical form by Spark; it is the broadcast side. Documents are
neither shuffled nor collected: one map-only pass of built-in functions.

Edge cases: null, empty and punctuation-only texts have the empty canonical form,
which is no licence. Repeated rows each get their result; extra columns pass
through. A text with several notices has them all, sorted; ties do not arise,
since a digest belongs to one licence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import own_names
from .license_texts import DIGESTS, LICENCES, NOTICES, SPELLINGS

#: A line that names a copyright holder or year (after lower-casing).
COPYRIGHT_LINE = (
    r"^[^a-z0-9©(]*("
    r"copyright[ \t]*(\(c\)|©|[0-9<\[{]|by[ \t])"
    r"|\(c\)[ \t]*[0-9<\[{]"
    r"|©"
    r"|all rights reserved"
    r")"
)
#: Whatever is neither letter nor digit.
PUNCTUATION = r"[^\p{L}\p{N}]+"


def canonical_line(line: Column) -> Column:
    """The canonical form of one line; the empty text for a copyright line."""
    low = F.lower(line)
    flat = F.trim(F.regexp_replace(low, PUNCTUATION, " "))
    for a, b in SPELLINGS:
        flat = F.replace(flat, F.lit(a), F.lit(b))
    # Few lines start like a copyright line; the prefix test spares the others the pattern.
    return F.when(low.rlike(COPYRIGHT_LINE), "").otherwise(flat)


def canonical_lines(text: Column) -> Column:
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), canonical_line)
    return F.filter(lines, lambda x: x != "")


def known_licences(spark: SparkSession) -> DataFrame:
    """``(digest, license)`` of the known texts."""
    rows = [(name, text) for name, _, text in LICENCES]
    rows += [(name, f"{title}\n{text}") for name, title, text in LICENCES if title]
    rows += NOTICES
    known = spark.createDataFrame(rows, "license string, text string")
    lines = canonical_lines(F.col("text"))
    whole = spark.createDataFrame([(d, n) for n, d in DIGESTS], "digest string, license string")
    return known.select(F.sha2(F.array_join(lines, " "), 256).alias("digest"), "license").union(whole).distinct()


@own_names("canonical_digest", "license", "notices", "_lines", "_digest")
def scan_licences(docs: DataFrame, text_col: str = "text", digests: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with ``canonical_digest``, ``license`` (of the entire text, else null)
    and ``notices`` (sorted licences that some line states).

    ``digests``: more licences, by the ``canonical_digest`` of their whole text; they
    come after the known ones."""
    spark = docs.sparkSession
    known = known_licences(spark)
    pairs = {r["digest"]: r["license"] for r in known.collect()}  # the fixed table above
    lookup = F.create_map(*[F.lit(x) for kv in sorted(pairs.items()) for x in kv])
    # Only a line whose short hash is among the known is hashed in full.
    short = [r["h"] for r in spark.createDataFrame([(t,) for _, t in _one_line()], "t string")
             .select(F.xxhash64(canonical_line(F.col("t"))).alias("h")).distinct().collect()]
    lines = F.col("_lines")
    maybe = F.filter(lines, lambda x: F.xxhash64(x).isin(short))
    found = F.transform(maybe, lambda x: F.element_at(lookup, F.sha2(x, 256)))
    scanned = docs.withColumn("_lines", canonical_lines(F.col(text_col))).withColumns(
        {
            "canonical_digest": F.sha2(F.array_join(lines, " "), 256),
            "notices": F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull()))),
        }
    )
    more = [(d, n) for d, n in (digests or {}).items() if d not in pairs]
    known = known.union(spark.createDataFrame(more, "digest string, license string"))
    table = F.broadcast(known.select(F.col("digest").alias("_digest"), "license"))
    joined = scanned.join(table, F.col("canonical_digest") == F.col("_digest"), "left")
    return joined.select(*docs.columns, "canonical_digest", "license", "notices")


def _one_line() -> list[tuple[str, str]]:
    """Known texts that are a single line."""
    return NOTICES + [(name, text) for name, _, text in LICENCES if "\n" not in text]
