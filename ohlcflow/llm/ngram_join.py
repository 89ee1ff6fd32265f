"""Near-duplicate documents: Jaccard join on word n-grams by PartEnum signatures.

A document's set holds its distinct ``n``-word shingles (ASCII case folded; with
fewer words, the whole word sequence as one). Two documents link when
``100 * |A & B| >= percent * |A | B|``.

**Signatures.** Sizes fall into bands. For a band with largest size ``u``, two
linked sets whose smaller one lies in the band differ in at most
``k = u * (100 - percent) / percent`` elements. The feature domain is split, by
hash, into first-level parts of ``n2`` second-level parts each; there are more
first-level parts than ``k / 2``, so some first-level part sees at most one
differing element, and all but one of its second-level parts agree. Every
subset that leaves one second-level part out is enumerated as a signature (the
projection of the set on it), so linked sets share one. A set signs for its own
band, and for the band below when its size can still reach it.

Empty projections say nothing and would gather unrelated sets. With ``slack``
more first-level parts than needed, a set leaves out the empty projections of its
first ``slack`` parts that have one. More than ``slack`` parts see at most one
element that differs: if one of them agrees on something, both sets have that
signature; else all of them are such parts of both sets, and the last of them is kept by
both. ``slack`` is what sets of the band's least size need on average and a bit, so hardly
any empty projection is left. The guarantee is exact, up to 64-bit hash collisions.

**Candidates** are signature mates. A parity sketch (each element flips one of
2048 bits; two sketches never differ in more bits than the sets in elements)
drops pairs that cannot link, then the sets themselves decide. Equal sets are
one class before all that, so copies cost one row per task. Within a bucket
``common.link_buckets`` checks the leader's pairs; the leader's other mates compare
their sketches among themselves inside a task, at most ``MATES`` of them, and only pairs that may
link leave it. Mates of a leader with more are told apart by their differences from it, which
meet in rare elements (a prefix filter on small sets). Either way a family of copies that
are nearly, but not quite, alike does not cost all its pairs.

Edge cases: a null or word-less text has an empty set, ``n_shingles`` 0, and is
linked with nothing (its component is its own id). Rows with equal doc_id and
different texts are separate nodes that share the id. A row with a null doc_id
stays in the result with its ``n_shingles``, takes part in no link and has a null
component_id. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import LOWER, mix, signed, text_blocks, word_hashes, words
from .common import Scratch, broadcast_if_small, bucket_members, link_buckets, own_names, scratch, shuffle_width

#: Bits of the parity sketch.
SKETCH_BITS = 2048
#: Bits of a second sketch of sets with at least so many elements: the first one is full
#: before such sets differ in more than linked ones may.
WIDE_BITS, WIDE_FROM = 16_384, 2_500
#: Mates of one leader whose sketches are compared in one task (some 9 MB, 40 MB if wide).
MATES = 4096
#: Signatures lie by value in so many columns, and up to ``ONE_SHUFFLE`` of them (some 14 bytes
#: each) are dealt out at once; of more, one column after the other.
SIG_COLUMNS = [f"sig{k}" for k in range(4)]
ONE_SHUFFLE = 20_000_000
#: Ratio of the largest to the smallest size of a band.
BAND_RATIO = 1.5

_U = np.uint64


def bands(percent: int, top: int) -> np.ndarray:
    """Lower bounds of the size bands that hold all sizes up to ``top``.

    Bands start where sets can link with a different set at all; each is at
    least wide enough that a set's partners lie in its own band or the next."""
    lo = max(1, -(-percent // (100 - percent))) if percent < 100 else top + 1
    out = [lo]
    while out[-1] <= top:
        reach = out[-1] * 100 // percent
        out.append(max(reach, int(out[-1] * BAND_RATIO)) + 1)
    return np.array(out, np.int64)


def _layout(bounds: np.ndarray, percent: int, n2: int) -> tuple[np.ndarray, np.ndarray]:
    """First-level parts and slack of each band.

    A set of the band's least size has an empty projection in some share of its parts; more
    parts make more of them, so the slack grows until it covers what it brings."""
    u = bounds[1:] - 1
    k = u * (100 - percent) // percent
    need = k // 2 + 1
    slack = 1 + need // 16
    while True:
        parts = need + slack
        share = np.minimum(n2 * np.exp(-bounds[:-1] * (n2 - 1) / (parts * n2)), 1.0)
        weak = parts * share + 2 * np.sqrt(parts * share)
        # Beyond as many parts again, signatures of less than an element would do no good.
        more = (weak > slack) & (slack < need)
        if not more.any():
            return parts, slack
        slack = np.where(more, np.minimum(need, slack + 1 + slack // 8), slack)


def shingle_sets(offsets: np.ndarray, data: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a block."""
    s, e, first = words(offsets, data)
    h = word_hashes(data, s, e, LOWER)
    out = []
    keys = mix(np.arange(1, n + 1, dtype=_U) * _U(0xD1342543DE82EF95)) | _U(1)
    m = len(h) - n + 1
    grams = np.zeros(max(m, 0), _U)
    for j in range(n):
        if m > 0:
            grams += mix(h[j : j + m] ^ keys[j]) * keys[j]
    grams = mix(grams)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            k = keys[: b - a]
            x = (mix(h[a:b] ^ k) * k).sum(dtype=_U, keepdims=True)
            out.append(mix(x ^ _U(b - a)))
        else:
            out.append(np.zeros(0, _U))
    return out


def _cell_sums(cell: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum modulo 2**64 of the values of each cell; halves stay exact in double."""
    lo = np.bincount(cell, weights=(values & _U(0xFFFFFFFF)).astype(np.float64), minlength=n)
    hi = np.bincount(cell, weights=(values >> _U(32)).astype(np.float64), minlength=n)
    return lo.astype(_U) + (hi.astype(_U) << _U(32))


def signatures(sets: list[np.ndarray], percent: int, n2: int) -> tuple[np.ndarray, np.ndarray]:
    """``(set index, signature)`` of all sets, for every band they sign."""
    sizes = np.array([len(x) for x in sets], np.int64)
    if not len(sizes) or not sizes.max():
        return np.zeros(0, np.int64), np.zeros(0, _U)
    bounds = bands(percent, int(sizes.max()))
    parts, slack = _layout(bounds, percent, n2)
    own = np.searchsorted(bounds, sizes, side="right") - 1
    own_idx, own_sig = [], []
    for step in (0, 1):
        band = own - step
        ok = band >= 0
        if step:
            # Largest partner of the band below.
            reach = (bounds[np.maximum(own, 0)] - 1) * 100 // percent
            ok &= sizes <= reach
        pick = np.flatnonzero(ok)
        if not len(pick):
            continue
        b = band[pick]
        elems = np.concatenate([sets[i] for i in pick])
        of = np.repeat(np.arange(len(pick)), sizes[pick])
        seed = mix((b.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15))
        x = mix(elems ^ seed[of])
        n1 = parts[b]
        base = np.concatenate(([0], np.cumsum(n1 * n2)))
        part = (x >> _U(32)) % n1[of].astype(_U)
        sub = (x & _U(0xFFFFFFFF)) % _U(n2)
        cell = base[of] + (part * _U(n2) + sub).astype(np.int64)
        total = int(base[-1])
        sums = _cell_sums(cell, mix(x + _U(0x632BE59BD9B4E019)), total).reshape(-1, n2)
        count = np.bincount(cell, minlength=total).reshape(-1, n2)
        # Subset j leaves second-level part j out.
        sums = sums.sum(axis=1, dtype=_U, keepdims=True) - sums
        count = count.sum(axis=1, keepdims=True) - count
        row_of = np.repeat(np.arange(len(pick)), n1)
        row_part = np.arange(len(row_of)) - (base[:-1] // n2)[row_of]
        empty = count == 0
        # The first parts of a set with an empty projection, as many as the slack, leave it out.
        weak = np.cumsum(empty.any(axis=1))
        before = np.concatenate(([0], weak))[np.concatenate(([0], np.cumsum(n1)[:-1]))]
        keep = ~empty | (weak - before[row_of] > slack[b][row_of])[:, None]
        where = mix(
            seed[row_of][:, None] + (row_part.astype(_U) * _U(n2))[:, None] + np.arange(n2, dtype=_U)[None, :]
        )
        sig = mix((sums + count.astype(_U)) ^ where)
        r, _ = np.nonzero(keep)
        own_idx.append(pick[row_of[r]])
        own_sig.append(sig[keep])
    if not own_idx:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    return np.concatenate(own_idx), np.concatenate(own_sig)


def _fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit fingerprints of each set."""
    a = np.zeros(len(sets), _U)
    b = np.zeros(len(sets), _U)
    for i, s in enumerate(sets):
        if len(s):
            a[i] = mix(s).sum(dtype=_U)
            b[i] = mix(s ^ _U(0x27BB2EE687B0B0FD)).sum(dtype=_U)
    n = np.array([len(s) for s in sets], _U)
    return mix(a ^ (n << _U(1))), mix(b + n)


def _sketches(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """Parity of the elements in each of ``bits`` cells, 64 cells to a LONG."""
    out = np.zeros((len(sets), bits // 64), np.int64)
    for i, s in enumerate(sets):
        odd = np.bincount((s >> _U(50)) & _U(bits - 1), minlength=bits) & 1
        out[i] = np.packbits(odd.astype(np.uint8)).view(np.int64)
    return out


def _lists(rows: list[int], width: int, n: int, values: np.ndarray) -> pa.ListArray:
    """``n`` lists, those of ``rows`` with ``width`` values each, the others empty."""
    sizes = np.zeros(n + 1, np.int32)
    sizes[np.array(rows, int) + 1] = width
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), pa.array(values.ravel()))


_DOC = (
    "doc_id long, n long, id long, id2 long, sigs long, "
    + ", ".join(f"{c} array<long>" for c in SIG_COLUMNS)
    + ", sketch array<long>, wide array<long>"
)


def _sig_columns(rows: list[int], idx: np.ndarray, sig: np.ndarray, n: int) -> list[pa.Array]:
    """The number of signatures of each of ``n`` rows, and their lists, a column for each part of
    the values; ``rows`` has the row of each set, in order."""
    order = np.argsort(idx, kind="stable")
    row, sig = np.array(rows, int)[idx[order]], sig[order]
    part = sig % _U(len(SIG_COLUMNS))
    out = [pa.array(np.bincount(row, minlength=n))]
    for k in range(len(SIG_COLUMNS)):
        ends = np.cumsum(np.bincount(row[part == k] + 1, minlength=n + 1), dtype=np.int32)
        out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(sig[part == k]))))
    return out


def _sign(shingle: int, percent: int, n2: int):
    """Task function: one row per document; the first document of each set in
    the task also carries the set's signatures and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column(0)
            for i, j, off, data in text_blocks(batch, "text"):
                sets = shingle_sets(off, data, shingle)
                f1, f2 = _fingerprints(sets)
                new = []
                named = ids.slice(i, j - i).is_valid().to_pylist()
                for r, x in enumerate(f1.tolist()):
                    if len(sets[r]) and named[r] and x not in seen:
                        seen.add(x)
                        new.append(r)
                fresh = [sets[r] for r in new]
                idx, sig = signatures(fresh, percent, n2)
                long = [r for r in new if len(sets[r]) >= WIDE_FROM]
                sketch = _lists(new, SKETCH_BITS // 64, len(sets), _sketches(fresh, SKETCH_BITS))
                wide = _lists(long, WIDE_BITS // 64, len(sets), _sketches([sets[r] for r in long], WIDE_BITS))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(i, j - i),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(signed(f1)),
                        pa.array(signed(f2)),
                        *_sig_columns(new, idx, sig, len(sets)),
                        sketch,
                        wide,
                    ],
                    names=["doc_id", "n", "id", "id2", "sigs", *SIG_COLUMNS, "sketch", "wide"],
                )

    return run


def _buckets(signed_rows: DataFrame, work: Scratch) -> DataFrame:
    """The written ``bucket_members`` of all signatures of a written table.

    The signatures and their shuffle are the most that the operator has on disk. A bucket's
    signatures are in one column, so columns can be dealt out one after the other, each when
    the shuffle of the one before is gone; buckets of two columns may have the same members."""

    if (signed_rows.agg(F.sum("sigs")).first()[0] or 0) <= ONE_SHUFFLE:
        sigs = signed_rows.select("id", F.explode(F.concat(*SIG_COLUMNS)).alias("sig"))
        return work.table(bucket_members(sigs), "buckets")
    # As many signatures a task as in one shuffle: an id's are packed together, copies fall away early.
    width = -(-shuffle_width(work.spark) // len(SIG_COLUMNS))
    each = (signed_rows.select("id", F.explode(c).alias("sig")).repartition(width, "sig") for c in SIG_COLUMNS)
    parts = [work.table(bucket_members(sigs), "part") for sigs in each]
    out = work.table(functools.reduce(DataFrame.union, parts).distinct(), "buckets")
    work.drop(*parts)
    return out


def _set_rows(shingle: int):
    """Task function: the set of each wanted class, from a document that has it
    (an id that repeats with another text is passed over)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            want = batch.column(0).to_numpy()
            for i, j, off, data in text_blocks(batch, "text"):
                sets = shingle_sets(off, data, shingle)
                own = signed(_fingerprints(sets)[0])
                pick = [r for r in np.flatnonzero(own == want[i:j]).tolist() if own[r] not in seen]
                seen.update(own[pick].tolist())
                sets = [sets[r] for r in pick]
                if not sets:
                    continue
                ends = np.cumsum([0] + [len(s) for s in sets], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own[pick]),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(np.concatenate(sets)))),
                    ],
                    names=["id", "hashes"],
                )

    return run


def _bits(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Bits in which sketches differ, each of ``rows`` from each of ``others``."""
    out = np.zeros((len(rows), len(others)), np.int32)
    for word in range(rows.shape[1]):
        out += np.bitwise_count(rows[:, word, None] ^ others[None, :, word])
    return out


def _near_mates(percent: int):
    """Group function: the pairs of a leader's mates, of different components, that size and
    sketch let link."""

    def sketches(column: pa.Array, pick: np.ndarray) -> np.ndarray:
        values = column.take(pa.array(pick)).flatten().to_numpy()
        return values.view(_U).reshape(len(pick), -1)

    def run(group: pa.Table) -> pa.Table:
        table = group.combine_chunks()
        ids, comp, n = (table.column(c).to_numpy() for c in ("id", "comp", "n"))
        narrow, wide = (table.column(c).combine_chunks() for c in ("sketch", "wide"))
        is_wide = pc.list_value_length(wide).to_numpy() > 0
        order = np.argsort(n, kind="stable")
        ids, comp, n, is_wide = ids[order], comp[order], n[order], is_wide[order]
        base = sketches(narrow, order)
        found = []
        for i in range(0, len(ids), 256):
            j = min(i + 256, len(ids))
            # By size: only sets that are not too large for the block's largest.
            end = int(np.searchsorted(n, n[j - 1] * 100 // percent, side="right"))
            size = n[i:j, None] + n[None, i:end]
            least = np.minimum(n[i:j, None], n[None, i:end])
            may = (100 * least >= percent * (size - least)) & (comp[i:j, None] != comp[None, i:end])
            may &= np.arange(i, j)[:, None] < np.arange(i, end)[None]
            bits = _bits(base[i:j], base[i:end])
            both = is_wide[i:j, None] & is_wide[None, i:end]
            if (both & may).any():
                rows, cols = np.flatnonzero(is_wide[i:j]), np.flatnonzero(is_wide[i:end])
                wider = _bits(sketches(wide, order[i:j][rows]), sketches(wide, order[i:end][cols]))
                bits[np.ix_(rows, cols)] = wider
            x, y = np.nonzero(may & (bits.astype(np.int64) * (100 + percent) <= size * (100 - percent)))
            found.append(np.stack([ids[i:j][x], ids[i:end][y]]))
        a, b = np.concatenate(found, axis=1)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def _differing_bits(a: Column, b: Column) -> Column:
    each = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(each, F.lit(0), lambda n, x: n + x)


def ngram_components(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    n2: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row of ``docs``.

    ``component_id`` is the smallest id reachable by links. ``shingle`` words per
    feature, ``percent`` of Jaccard similarity, ``n2`` second-level parts (more
    parts: more, but more selective signatures).
    """
    return _components(docs, shingle, percent, n2, id_col, text_col).select("doc_id", "n_shingles", "component_id")


def _components(
    docs: DataFrame, shingle: int = 5, percent: int = 80, n2: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``ngram_components`` with the row's ``set`` and its ``comp``, which tells components
    apart that have a ``component_id`` in common."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must be 50 to 100")
    if n2 < 2:
        raise ValueError("n2 must be 2 at least")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with scratch(spark, "ngram-join", shuffles_go=True) as work:
        signed_docs = rows.mapInArrow(_sign(shingle, percent, n2), _DOC)
        # Signatures lie in one table until the buckets are known, then go.
        all_rows = work.table(signed_docs, "signed")
        doc = work.table(all_rows.select("doc_id", "n", "id"), "documents")
        members = _buckets(all_rows, work)
        mates = work.table(members.select("id").distinct(), "mates")
        # Of each set that has a mate: its size, sketch and one document.
        known = work.table(
            all_rows.where("size(sketch) > 0")
            .join(broadcast_if_small(mates), "id", "left_semi")
            .groupBy("id")
            .agg(F.min_by(F.struct("n", "sketch", "wide", "doc_id"), "doc_id").alias("c"))
            .select("id", "c.*"),
            "sketches",
        )
        work.drop(all_rows)
        del signed_docs

        def sets_of(ids: DataFrame) -> DataFrame:
            """The sets of some classes, from the texts of one document each. Most classes have
            no partner that their sketches let link: theirs are never written down."""
            wanted = work.table(ids.distinct(), "wanted")
            few = known.join(broadcast_if_small(wanted), "id", "left_semi")
            carriers = work.table(few.select("doc_id", F.col("id").alias("want")), "carriers")
            texts = rows.join(broadcast_if_small(carriers), "doc_id").select("want", "text")
            sets = work.table(texts.mapInArrow(_set_rows(shingle), "id long, hashes array<long>"), "sets")
            work.drop(wanted, carriers)
            return sets

        # A sketch is a quarter of a kilobyte: this many rows make some 15 MB.
        small = known.count() <= 50_000
        hint = F.broadcast if small else (lambda df: df)

        sizes = work.table(known.select("id", "n", (F.size("wide") > 0).alias("wide")), "sizes")
        some_wide = not sizes.where("wide").isEmpty()

        def may_link(pairs: DataFrame) -> DataFrame:
            a, b = (
                broadcast_if_small(sizes).select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("wide").alias(f"w{x}"))
                for x in "ab"
            )
            # |A ^ B| is at most (a + b) * (100 - p) / (100 + p), and a at least p / 100 * b.
            close = "100 * least(na, nb) >= {0} * greatest(na, nb)".format(percent)
            sized = pairs.join(a, "a").join(b, "b").where(close)

            def by_sketch(some: DataFrame, column: str) -> DataFrame:
                x, y = (hint(known.select(F.col("id").alias(k), F.col(column).alias(f"s{k}"))) for k in "ab")
                few = _differing_bits(F.col("sa"), F.col("sb")) * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)
                return some.join(x, "a").join(y, "b").where(few).select("a", "b")

            if not some_wide:
                return by_sketch(sized, "sketch")
            # Rows carry one kind of sketch, and only pairs of large sets the wide one.
            return by_sketch(sized.where("NOT (wa AND wb)"), "sketch").union(by_sketch(sized.where("wa AND wb"), "wide"))

        def verify(pairs: DataFrame) -> DataFrame:
            may = work.table(may_link(pairs), "may")
            sets = sets_of(may.select(F.col("a").alias("id")).union(may.select("b")))
            x, y = (sets.select(F.col("id").alias(k), F.col("hashes").alias(f"h{k}")) for k in "ab")
            both = may.join(x, "a").join(y, "b").withColumn("both", F.size(F.array_intersect("ha", "hb")))
            union = F.size("ha") + F.size("hb") - F.col("both")
            links = both.where(F.col("both") * 100 >= union * percent).select("a", "b").distinct()
            links = work.table(links, "links")
            work.drop(may, sets)
            return links

        def by_differences(mates: DataFrame) -> DataFrame:
            """Mates ``x, y`` of a leader ``c`` differ in as much as their differences from
            ``c`` differ: ``x ^ y = (x ^ c) ^ (y ^ c)``. If they link but are not both
            linked with ``c``, the differences have an element in common, and of the
            ``|x ^ c|`` elements at least ``|x ^ c| - k``, where ``k`` is what linked
            partners of ``x`` may differ in. So by a common order, rarest first, they
            meet in the first ``k + 1`` elements of their differences."""
            size = known.select("id", "n")
            sets = sets_of(mates.select("id").union(mates.select("lead")))
            c = sets.select(F.col("id").alias("lead"), F.col("hashes").alias("hc"))
            x = sets.select("id", F.col("hashes").alias("hx"))
            apart = F.concat(F.array_except("hx", "hc"), F.array_except("hc", "hx"))
            deltas = (
                mates.join(broadcast_if_small(size), "id")
                .join(c, "lead").join(x, "id")
                .select("lead", "id", "comp", "n", F.explode(apart).alias("e"))
            )
            seen = deltas.withColumn("times", F.count(F.lit(1)).over(Window.partitionBy("lead", "e")))
            by_mate = Window.partitionBy("lead", "id").orderBy("times", "e")
            limit = F.floor(F.col("n") * (100 - percent) / percent) + 1
            heads = (
                seen.withColumn("rank", F.row_number().over(by_mate))
                .where((F.col("rank") <= limit) & (F.col("times") > 1))
                .select("lead", "e", "id", "comp")
            )
            heads = work.table(heads, "differences")
            work.drop(sets)
            p = heads.select("lead", "e", F.col("id").alias("a"), F.col("comp").alias("ca"))
            q = heads.select("lead", "e", F.col("id").alias("b"), F.col("comp").alias("cb"))
            return p.join(q, ["lead", "e"]).where("a < b and ca <> cb").select("a", "b")

        def refine(mates: DataFrame) -> DataFrame:
            per = mates.groupBy("lead").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > MATES)
            per = work.table(per.select("lead"), "large")
            few = mates.join(broadcast_if_small(per), "lead", "left_anti")
            rows = few.join(hint(known.select("id", "n", "sketch", "wide")), "id")
            near = rows.groupBy("lead").applyInArrow(_near_mates(percent), "a long, b long")
            if per.isEmpty():
                return near
            return near.union(by_differences(mates.join(broadcast_if_small(per), "lead", "left_semi")))

        comp = link_buckets(members, verify, work, refine, near=may_link)
        # A class is a set of equal content: its smallest document, then the
        # smallest of the component's classes.
        least = doc.where("n > 0").groupBy("id").agg(F.min("doc_id").alias("d"), F.count(F.lit(1)).alias("k"))
        several = least.join(broadcast_if_small(comp), "id", "left").where("k > 1 or comp is not null")
        several = work.table(several.select("id", F.coalesce("comp", "id").alias("comp"), "d"), "several")
        # Folded before it is dealt out, so a large component is a row per task.
        low = work.table(several.groupBy("comp").agg(F.min("d").alias("component_id")), "least")
        by_class = several.join(broadcast_if_small(low), "comp").select("id", "comp", "component_id")
        by_class = work.table(by_class, "classes")
        work.release()
        return doc.join(broadcast_if_small(by_class), doc["id"] == by_class["id"], "left").select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when((F.col("n") == 0) | F.col("doc_id").isNull(), F.col("doc_id"))
            .otherwise(F.coalesce("component_id", "doc_id"))
            .alias("component_id"),
            doc["id"].alias("set"),
            F.coalesce("comp", doc["id"]).alias("comp"),
        )


@own_names("_set", "_drop", "_again", "_id", "_of", "_comp", "_row")
def keep_one_per_component(docs: DataFrame, **options) -> DataFrame:
    """The documents that stand for their component: those with its smallest id.

    Rows without words or without an id stay (they are linked with nothing).
    Where an id repeats, its rows count by their sets: of each component that has the id as
    its smallest, one row stays (the least by all columns); rows without words that are
    equal in all columns are one. The columns of ``docs`` are unchanged.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    comp = _components(docs, **options)
    drop = comp.where("component_id <> doc_id").select(F.col("doc_id").alias("_drop")).distinct()
    again = docs.groupBy(id_col).count().where(F.col("count") > 1).where(F.col(id_col).isNotNull())
    if again.isEmpty():
        return docs.join(drop, docs[id_col] == drop["_drop"], "left_anti")
    again = again.select(F.col(id_col).alias("_again"))
    same = docs[id_col] == again["_again"]
    once = docs.join(again, same, "left_anti")
    once = once.join(drop, once[id_col] == drop["_drop"], "left_anti")
    many = docs.join(again, same, "left_semi")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    many = many.mapInArrow(_with_set(text_col, options.get("shingle", 5)), f"{schema}, _set long")
    stand = comp.where("component_id = doc_id and n_shingles > 0").select(
        F.col("doc_id").alias("_id"), F.col("set").alias("_of"), F.col("comp").alias("_comp")
    )
    of = (many[id_col] == F.col("_id")) & (many["_set"] == F.col("_of"))
    rows = many.join(stand.distinct(), of).select("_id", "_comp", F.struct(*docs.columns).alias("_row"))
    one = rows.groupBy("_id", "_comp").agg(F.min("_row").alias("_row")).select("_row.*")
    empty = many.where("_set is null").select(*docs.columns).distinct()
    return once.union(one).union(empty)


def _with_set(text_col: str, shingle: int):
    """Task function: rows with the fingerprint of their set, null where it is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, off, data in text_blocks(batch, text_col):
                sets = shingle_sets(off, data, shingle)
                own = pa.array(signed(_fingerprints(sets)[0]), mask=np.array([not len(x) for x in sets]))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, own], names=[*part.schema.names, "_set"])

    return run
