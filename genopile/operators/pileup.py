"""Exact pileup of alignments: allele counters per position and sample.

Plan
----
Each aligned stretch of a read is cut at reference-tile borders.  These short rows are
shuffled **once**, on ``(chrom, tile)``; there the pieces of one tile and sample are counted
together, in arrays of a few tiles, so a task neither expands nor hashes single bases.  The
reference meets the pieces of a tile before they are counted, in the same layout, and positions that
a caller has no use for are left out there: those that are not listed, or those where no read differs
from the reference.  Spark does not know the layout of what Python returns, so what remains is
shuffled once more where samples of a site meet.

A tile may hold a large share of all bases (a deep amplicon, an organelle).  Such tiles are
found by a narrow first pass over position and CIGAR; there are fewer than
``skew.SHARES`` of them whatever the data.  Their pieces are dealt to many groups and counted
there first, and join the same shuffle as ready counts.  Nothing is dropped and no task sees
a whole hot tile's reads.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genopile.config import TILE, PileupOptions
from genopile.functions.alleles import COUNTERS
from genopile.functions.cigar import cigar_blocks
from genopile.operators.genome import tile_of
from genopile.operators.reads import usable
from genopile.operators.skew import LIGHT, SHARES, above_share, stored_loads

# Counter of each pileup letter; a deleted base is written ``*``.
_LETTERS = {**{a: c for a, c in COUNTERS.items() if a != "-"}, "*": "n_del"}

# Quality sums are kept as whole numbers of 1/1000 Phred units, so that they do not depend
# on the order of addition.
PHRED_UNITS = 1000

# Fixed value: the highest quality a printable character can state.
_TOP_QUALITY = 93

# Tiles that are counted at once, and bases that one task is meant to count.
_GROUPS = 64
_PART_BASES = 1 << 23


def read_blocks(reads: DataFrame, keep: list[str]) -> DataFrame:
    """One row per CIGAR operation: ``keep`` columns, read fields and a struct ``b``."""
    qual = F.when(F.col("qual") == "*", F.expr("repeat('~', length(seq))")).otherwise(F.col("qual"))
    return reads.select(
        *keep,
        "qname",
        F.col("rname").alias("chrom"),
        F.col("pos").cast("bigint").alias("read_pos"),
        "seq",
        qual.alias("qual"),
        F.explode(cigar_blocks(F.col("cigar"))).alias("b"),
    )


def _pieces(blocks: DataFrame, keep: list[str], tile: int) -> DataFrame:
    """Stretches of aligned or deleted bases, cut at tile borders."""
    size = F.col("b.len")
    after = F.col("b.read_off") + 1
    deleted = F.col("b.op") == "D"
    bases = F.when(deleted, F.expr("repeat('*', b.len)")).otherwise(F.substr("seq", after, size))
    # A deleted base has no quality of its own; the next read base stands in for it.
    quals = F.when(deleted, F.expr("repeat(substr(qual, b.read_off + 1, 1), b.len)")).otherwise(
        F.substr("qual", after, size)
    )
    whole = blocks.filter(F.col("b.op").isin("M", "=", "X", "D")).select(
        *keep,
        "chrom",
        F.xxhash64("qname", "b.read_off").alias("mark"),
        (F.col("read_pos") + F.col("b.ref_off")).alias("start"),
        size.alias("size"),
        bases.alias("bases"),
        quals.alias("quals"),
    )
    end = F.col("start") + F.col("size") - 1
    tiled = whole.withColumn("tile", F.explode(F.sequence(tile_of(F.col("start"), tile), tile_of(end, tile))))
    lo = F.greatest(F.col("start"), F.col("tile") * tile + 1)
    hi = F.least(end, (F.col("tile") + 1) * tile)
    skip = (lo - F.col("start") + 1).cast("int")
    return tiled.select(
        *keep,
        "chrom",
        "tile",
        "mark",
        lo.alias("start"),
        (hi - lo + 1).alias("size"),
        F.upper(F.substr("bases", skip, (hi - lo + 1).cast("int"))).alias("bases"),
        F.substr("quals", skip, (hi - lo + 1).cast("int")).alias("quals"),
    )


def _match_costs() -> list[int]:
    """Phred costs of a right base, -10 log10(1 - e), by quality."""
    return [round(-10 * PHRED_UNITS * math.log10(1 - 10 ** (-max(n, 1) / 10))) for n in range(_TOP_QUALITY + 1)]


def _counters(quality: bool) -> list[str]:
    names = ["depth", *_LETTERS.values()]
    if quality:
        names += [f"{kind}_{b}" for kind in ("ok", "err") for b in "acgt"]
    return names


def _quality() -> Column:
    return F.ascii("qual") - 33


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts in a row, as numbers, and the length of each text; null is empty."""
    filled = texts.fill_null("")
    _, offsets, data = filled.buffers()
    ends = np.frombuffer(offsets, np.int32, len(filled) + 1, filled.offset * 4) if len(filled) else np.zeros(1, np.int32)
    flat = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    if flat.size and flat.max() > 127:
        whole = filled.to_pylist()
        flat = np.frombuffer("".join(whole).encode("utf-32-le", "surrogatepass"), np.uint32)
        return flat, np.array([len(t) for t in whole], np.int64)
    return flat, np.diff(ends).astype(np.int64)


def _padded(flat: np.ndarray, sizes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Texts in a row brought to the wanted lengths; -1 stands behind the end of one."""
    if np.array_equal(sizes, wanted):
        return flat.astype(np.int64)
    inside = _steps(wanted)
    found = inside < np.repeat(sizes, wanted)
    out = np.full(len(inside), -1, np.int64)
    out[found] = flat[(np.repeat(np.cumsum(sizes) - sizes, wanted) + inside)[found]]
    return out


def _steps(sizes: np.ndarray) -> np.ndarray:
    """0, 1, … below each size, in a row."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _counter(names: list[str], quality: bool, min_base_qual: int, tile: int):
    """A function from lists of pieces, each of one tile, to ``at`` and counters of covered positions.

    A piece is a stretch of bases from ``at`` on, or ``ready``, such a result for some of the pieces.
    Results are numbers in a row; an unknown count is -1.
    """
    letters = np.full(256, len(_LETTERS), np.int64)
    for i, letter in enumerate(_LETTERS):
        letters[ord(letter)] = i
    cost = np.array(_match_costs(), np.float64)
    width = len(_LETTERS) + 1

    def counted(groups: pa.Array) -> pa.Array:
        size = len(groups) * tile
        owner = np.repeat(np.arange(len(groups)), pc.list_value_length(groups).to_numpy(zero_copy_only=False))
        at, bases, quals, ready = groups.flatten().flatten()
        whole = pc.and_(bases.is_valid(), quals.is_valid())
        base, n_base = _codes(pc.if_else(whole, bases, ""))
        qual, n_qual = _codes(pc.if_else(whole, quals, ""))
        wanted = np.maximum(n_base, n_qual)
        base, qual = _padded(base, n_base, wanted), _padded(qual, n_qual, wanted) - 33
        here = np.repeat(owner * tile + at.fill_null(0).to_numpy(zero_copy_only=False), wanted) + _steps(wanted)
        good = (qual >= min_base_qual) & (qual >= -33)
        here, base, qual = here[good], base[good], qual[good]
        letter = letters[np.where((base < 0) | (base > 255), 0, base)]
        spot = here * width + letter
        table = np.bincount(spot, minlength=size * width).reshape(size, width)
        depth = table.sum(1)
        # A position all of whose bases lie behind the end of the read's text has no letter counts.
        known = np.bincount(here[base >= 0], minlength=size)
        columns = [depth, *table.T[:-1]]
        if quality:
            right = np.where((qual >= 0) & (qual <= _TOP_QUALITY), cost[np.clip(qual, 0, _TOP_QUALITY)], 0)
            # All letters are summed at once; the sums are of whole numbers and so exact.
            at_letter = [[*_LETTERS].index(b) for b in "ACGT"]
            for cost_of in (right, qual * float(PHRED_UNITS)):
                columns += [*np.bincount(spot, cost_of, size * width).reshape(size, width).T[at_letter]]
        n_ready = pc.fill_null(pc.list_value_length(ready), 0).to_numpy(zero_copy_only=False) // (1 + len(names))
        if n_ready.any():
            before = ready.flatten().to_numpy(zero_copy_only=False).reshape(-1, 1 + len(names))
            spot = np.repeat(owner * tile, n_ready) + before[:, 0]
            known += np.bincount(spot[before[:, 2] >= 0], minlength=size)
            columns = [c + np.bincount(spot, np.maximum(before[:, k], 0), size).astype(np.int64) for k, c in enumerate(columns, 1)]
        held = np.flatnonzero(columns[0])
        out = np.empty((len(held), 1 + len(names)), np.int64)
        out[:, 0] = held % tile
        for k, column in enumerate(columns, 1):
            out[:, k] = column[held]
        out[known[held] == 0, 2 : 1 + width] = -1
        ends = np.searchsorted(held, np.arange(len(groups) + 1) * tile) * (1 + len(names))
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(out.ravel()))

    return counted


def _sliced(counted, groups: pa.Array) -> Iterator[pa.Array]:
    """Some lists are counted at a time, so memory is bounded by them."""
    for i in range(0, len(groups), _GROUPS):
        yield counted(groups.slice(i, _GROUPS))


def _counting(counted):
    """A column function from the pieces of one tile to counters, see :func:`_counter`."""

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for groups in batches:
            yield from _sliced(counted, groups)

    return F.arrow_udf(count, T.ArrayType(T.LongType()))


def _counting_some(counted, names: list[str], tile: int, differing: bool, marked: bool, samples: list[str] | None = None):
    """A column function from a tile to the counters of its wanted positions, a list per group.

    It takes the pieces of every group of the tile and the tile's reference.  Wanted are marked
    positions and, with ``differing``, those where some group has a base that is not the reference's;
    all of them without either.  With ``samples`` it takes the groups' samples, too, and gives a list
    per sample of these, each with every wanted position.
    """
    width = 1 + len(names)
    step = max(1, min(_GROUPS, 4 * _GROUPS // max(1, len(samples or ()))))
    column = {ord(x): names.index(n) + 1 for x, n in _LETTERS.items() if x != "*"}
    deleted = names.index(_LETTERS["*"]) + 1

    def every(spot: np.ndarray, rows: np.ndarray, code: np.ndarray, n_tiles: int) -> pa.Array:
        """Rows of all samples at each spot, zeros where a sample has none."""
        spots, place = np.unique(spot, return_inverse=True)
        n = len(samples)
        out = np.zeros((len(spots), n, width), np.int64)
        out[:, :, 0] = (spots % tile)[:, None]
        out[place[code >= 0], code[code >= 0]] = rows[code >= 0]
        owner = (spots // tile)[:, None] * n + np.arange(n)
        out = out.reshape(-1, width)[np.argsort(owner.ravel(), kind="stable")]
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner.ravel(), minlength=n_tiles * n))]) * width
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(out.ravel()))
        return pa.ListArray.from_arrays(pa.array(np.arange(n_tiles + 1, dtype=np.int32) * n), lists)

    def references(tiles: pa.Array, seqs: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Reference letters of all tiles, and which tiles have them, once for each time that contigs are there."""
        n_seqs = pc.fill_null(pc.list_value_length(seqs), 0).to_numpy(zero_copy_only=False)
        texts = seqs.flatten()
        first = np.cumsum(n_seqs) - n_seqs
        for turn in range(max(1, n_seqs.max(initial=0))):
            ref = np.full(len(tiles) * tile, ord("N"), np.int64)
            has = np.flatnonzero(n_seqs > turn)
            flat, lengths = _codes(texts.take(pa.array(first[has] + turn)))
            inside = _steps(lengths)
            short = inside < tile
            ref[(np.repeat(has, lengths) * tile + inside)[short]] = flat[short]
            yield ref, has

    def some(tiles: pa.Array, seqs: pa.Array, who: pa.Array | None = None) -> pa.Array:
        groups = tiles.flatten()
        of_group = np.repeat(np.arange(len(tiles)), pc.fill_null(pc.list_value_length(tiles), 0).to_numpy(zero_copy_only=False))
        lists = pa.concat_arrays([*_sliced(counted, groups)]) if len(groups) else pa.array([], pa.list_(pa.int64()))
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False) // width
        rows = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        owner = np.repeat(np.arange(len(groups)), sizes)
        spot = of_group[owner] * tile + rows[:, 0]
        wanted = np.full(len(tiles) * tile, not differing and not marked)
        at, bases, _, ready = groups.flatten().flatten()
        of_piece = np.repeat(of_group, pc.list_value_length(groups).to_numpy(zero_copy_only=False))
        mark = pc.and_(pc.and_(bases.is_null(), ready.is_valid()), at.is_valid()).to_numpy(zero_copy_only=False)
        wanted[of_piece[mark] * tile + at.fill_null(0).to_numpy(zero_copy_only=False)[mark]] = True
        if differing:
            # A tile whose contig is there more than once, or not at all, is held against each or none.
            others = rows[:, 1] - np.maximum(rows[:, deleted], 0)
            for ref, _ in references(tiles, seqs):
                here = ref[spot]
                here = np.where((here >= 97) & (here <= 122), here - 32, here)
                same = np.zeros(len(rows), np.int64)
                for letter, k in column.items():
                    same = np.where(here == letter, np.maximum(rows[:, k], 0), same)
                wanted[spot[others > same]] = True
        held = wanted[spot]
        if samples is not None:
            named = who.flatten()
            if named.null_count:
                raise ValueError("a read without a sample")
            known: list[np.ndarray] = []
            for ref, has in references(tiles, seqs):
                both = held & np.isin(spot // tile, has)
                if any((letters[spot[both]] == ref[spot[both]]).any() for letters in known):
                    raise ValueError("a sample is there twice at a site: contigs repeat")
                known.append(ref)
            code = pc.fill_null(pc.index_in(named, pa.array(samples, pa.string())), -1).to_numpy(zero_copy_only=False)
            return every(spot[held], rows[held], code[owner[held]], len(tiles))
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner[held], minlength=len(groups)))]) * width
        kept = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(rows[held].ravel()))
        outer = np.concatenate([[0], np.cumsum(np.bincount(of_group, minlength=len(tiles)))])
        return pa.ListArray.from_arrays(pa.array(outer.astype(np.int32)), kept)

    def count(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            for i in range(0, len(columns[0]), step):
                yield some(*(c.slice(i, step) for c in columns))

    return F.arrow_udf(count, T.ArrayType(T.ArrayType(T.LongType())))


def _bases(pieces: DataFrame, keep: list[str]) -> DataFrame:
    zipped = F.arrays_zip(F.split("bases", "").alias("base"), F.split("quals", "").alias("qual"))
    return pieces.select(*keep, "chrom", "tile", "start", F.posexplode(zipped).alias("i", "z")).select(
        *keep,
        "chrom",
        "tile",
        (F.col("start") + F.col("i")).alias("pos"),
        F.col("z.base").alias("base"),
        F.col("z.qual").alias("qual"),
    )


def pileup_counts(
    reads: DataFrame,
    options: PileupOptions = PileupOptions(),
    by: tuple[str, ...] = (),
    quality: bool = False,
    positions: DataFrame | None = None,
    tile: int = TILE,
    shares: int = SHARES,
    light: int = LIGHT,
    tiles: DataFrame | None = None,
    differing: bool = False,
    besides: DataFrame | None = None,
    samples: list[str] | None = None,
) -> DataFrame:
    """Counters per ``(chrom, tile, pos, sample)`` and any further grouping columns ``by``.

    Columns: ``depth n_a n_c n_g n_t n_n n_del`` and, with ``quality``, the Phred sums
    ``ok_* err_*`` per base.  With ``positions`` only tiles that hold a listed position are
    shuffled and only listed positions are returned.  With ``tiles`` the reference base is added as
    by :func:`with_ref`.  With ``differing`` (it needs ``tiles``) a position is returned, for all its
    samples, only where some read has a base unlike the reference that is not deleted, or where
    ``besides`` lists it; at any other no base but the reference's can be called.  With ``samples`` (it
    needs ``tiles`` and no ``by``) a position has a row for each of these and for no other, with counters
    of zero where the sample has no base; a sample may be there once at a site.
    """
    keep = ["sample", *by]
    if samples is not None and (by or tiles is None):
        raise ValueError("rows of all samples need the reference and no further grouping")
    counted = usable(reads, options)
    if options.one_per_fragment:
        counted = counted.withColumn("mate", F.col("flag").bitwiseAND(0xC0))
    named = [*keep, "qname", "mate"] if options.one_per_fragment else keep
    pieces = _pieces(read_blocks(counted, [c for c in named if c != "qname"]), named, tile)
    if positions is not None:
        wanted = positions.select("chrom", tile_of(F.col("pos"), tile).alias("tile"))
        pieces = pieces.join(wanted, ["chrom", "tile"], "left_semi")
    good = _quality() >= options.min_base_qual
    names = _counters(quality)
    counter = _counter(names, quality, options.min_base_qual, tile)
    count = _counting(counter)
    if options.one_per_fragment:
        alone, doubled = _fragments(pieces, keep, good)
        single = doubled.select(
            *keep, "chrom", "tile", "mark", F.col("pos").alias("start"), F.lit(1).alias("size"), F.col("base").alias("bases"), F.col("qual").alias("quals")
        )
        pieces = alone.unionByName(single)
    loads, total = stored_loads(pieces, ["chrom", "tile"], F.col("size"))
    hot = F.broadcast(above_share(loads, total, shares, light))
    cold = pieces.join(hot.drop("load"), ["chrom", "tile"], "left_anti")
    # A hot tile is dealt to as many groups as it holds light loads.
    part = F.pmod(F.xxhash64("mark", "start", "bases", "quals"), F.floor(F.col("load") / max(light, 1)) + 1)
    none = F.lit(None).cast("array<bigint>")
    early = pieces.join(hot, ["chrom", "tile"]).withColumns({"part": part, "ready": none})
    ready = early.groupBy("chrom", "tile", "part", *keep).agg(F.collect_list(_piece(tile)).alias("p"))
    ready = ready.select(*keep, "chrom", "tile", count("p").alias("ready"))
    rows = cold.drop("size", "mark").unionByName(ready, allowMissingColumns=True)
    # Pieces are small before they are counted, so the number of tasks follows from the bases.
    parts = max(int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / _PART_BASES))
    marks = positions if positions is not None else besides
    if marks is not None:
        start = F.col("pos").cast("bigint")
        spots = marks.select("chrom", tile_of(start, tile).alias("tile"), start.alias("start")).filter("start is not null").distinct()
        rows = rows.unionByName(spots.withColumn("ready", F.array().cast("array<bigint>")), allowMissingColumns=True)
    groups = rows.repartition(parts, "chrom", "tile").groupBy("chrom", "tile", *keep).agg(F.collect_list(_piece(tile)).alias("p"))
    if tiles is None and marks is None:
        listed = groups.select("chrom", "tile", *keep, count("p").alias("c"))
    else:
        # The groups of a tile are in one task already, and so is its reference.
        whole = groups.groupBy("chrom", "tile").agg(F.collect_list(F.struct(*keep, "p")).alias("g"))
        if tiles is None:
            whole = whole.withColumn("seqs", F.lit(None).cast("array<struct<seq:string>>"))
        else:
            known = tiles.repartition(parts, "chrom", "tile").groupBy("chrom", "tile").agg(F.collect_list(F.struct("seq")).alias("seqs"))
            whole = whole.join(known.hint("shuffle_hash"), ["chrom", "tile"], "left")
        some = _counting_some(counter, names, tile, differing, marks is not None, samples)
        given = [F.col("g.p"), F.col("seqs.seq")]
        if samples is None:
            who = F.transform("g", lambda g: F.struct(*(g[k].alias(k) for k in keep)))
        else:
            given.append(F.col("g.sample"))
            who = F.array(*(F.struct(F.lit(s).alias("sample")) for s in samples))
        found = whole.withColumns({"who": who, "c": some(*given)})
        each = found.select("chrom", "tile", F.explode_outer("seqs").alias("s"), F.arrays_zip("who", "c").alias("z"))
        each = each.select("chrom", "tile", F.col("s.seq").alias("seq"), F.explode("z").alias("z"))
        listed = each.select("chrom", "tile", "seq", *(F.col(f"z.who.{k}").alias(k) for k in keep), F.col("z.c").alias("c"))
    listed = listed.filter(F.size("c") > 0)
    width = 1 + len(names)
    each = listed.withColumn("i", F.explode(F.sequence(F.lit(0), F.size("c") - width, F.lit(width))))
    value = {n: F.get("c", F.col("i") + k) for k, n in enumerate(names, 1)}
    letters = {n: F.nullif(value[n], F.lit(-1).cast("bigint")) for n in _LETTERS.values()}
    pos = (F.col("tile") * tile + F.get("c", F.col("i")) + 1).alias("pos")
    columns = [v.alias(n) for n, v in {**value, **letters}.items()]
    if tiles is None:
        return each.select("chrom", "tile", pos, *keep, *columns)
    base = F.substr("seq", (F.get("c", F.col("i")) + 1).cast("int"), F.lit(1))
    ref = F.coalesce(F.nullif(base, F.lit("")), F.lit("N")).alias("ref")
    return each.select("chrom", "tile", pos, *keep, *columns, ref).withColumnRenamed("depth", "cov")


def _fragments(pieces: DataFrame, keep: list[str], good: Column) -> tuple[DataFrame, DataFrame]:
    """Pieces of reads that no mate overlaps, and the bases of the others, one a fragment.

    The two reads of a pair meet by name inside a tile.  Where their stretches there overlap, each
    position keeps the base of the higher quality, on a tie that of the first read.  A fragment is
    known by its sample, further keys and name; other reads of the same name belong to it.
    """
    fragment = ["chrom", "tile", *keep, "qname"]
    end = F.col("start") + F.col("size") - 1

    def own(mate: int, value: Column) -> Column:
        return F.when(F.col("mate") == mate, value)

    spans = pieces.groupBy(*fragment).agg(
        F.min(own(0x40, F.col("start"))).alias("a_lo"),
        F.max(own(0x40, end)).alias("a_hi"),
        F.min(own(0x80, F.col("start"))).alias("b_lo"),
        F.max(own(0x80, end)).alias("b_hi"),
    )
    met = spans.filter((F.col("a_lo") <= F.col("b_hi")) & (F.col("b_lo") <= F.col("a_hi"))).select(*fragment)
    alone = pieces.join(met, fragment, "left_anti").drop("qname", "mate")
    bases = _bases(pieces.join(met, fragment, "left_semi"), [*keep, "qname", "mate"]).filter(good)
    choice = F.struct(_quality().alias("q"), (F.col("mate") == 0x40).alias("first"), "base", "qual")
    best = bases.groupBy(*fragment, "pos").agg(F.max(choice).alias("best"))
    return alone, best.select(*keep, "chrom", "tile", F.xxhash64("qname").alias("mark"), "pos", "best.base", "best.qual")


def _piece(tile: int) -> Column:
    """A piece as the counting function takes it."""
    at = (F.col("start") - F.col("tile") * tile - 1).cast("int")
    return F.struct(at.alias("at"), "bases", "quals", "ready")


def with_ref(counts: DataFrame, tiles: DataFrame, tile: int = TILE) -> DataFrame:
    """Add the reference base; ``cov`` is the depth.

    Both sides are keyed on ``(chrom, tile)``, where site-level steps find them.  The hash side
    is the reference, so a task holds its own share of it and nothing more.
    """
    joined = counts.join(tiles.hint("shuffle_hash"), ["chrom", "tile"], "left")
    base = F.substr("seq", (F.col("pos") - F.col("tile") * tile).cast("int"), F.lit(1))
    return (
        joined.withColumn("ref", F.coalesce(F.nullif(base, F.lit("")), F.lit("N")))
        .withColumnRenamed("depth", "cov")
        .drop("seq")
    )
