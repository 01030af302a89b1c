"""Exact Jaccard self-join of word-shingle sets by partitioning the universe of shingles.

Two sets of sizes p <= q reach a Jaccard of 0.75 only if they differ in at most (p + q) / 7 shingles.
A hash deals the universe to more segments than that, so they agree on one segment. Sets are banded by
size; a band fixes the number of segments. A set is indexed in its own band under the subset that it has
in each segment, and searched in its own band and the next lower one. Only as many segments as the
difference bound asks for have to be searched; which ones is decided by cost, when the lists under all
keys are known: a set gives up the segments whose lists are longest, and empty ones, which many sets
share, are never used. A set with too few segments allows one difference in the fullest: it also
searches the subsets with one shingle taken out, and the sets of the band are then indexed under
theirs. If even this is too little, another hash deals the set's band again.

Candidates are groups of sets under one key. No group is turned into all its pairs: its members are
verified against a few central ones, components are formed, and only pairs of members of different
components are left to be verified. In a group of more than ``HOT_SETS`` of these, such as sets that share
a common passage and little else, a pair must also share one of the rarest shingles of each: in any order of
all shingles, the first that two linked sets have in common stands in the first seventh of the smaller and
the first quarter of the larger set, and from there on both still hold all that they must share. The sets
of such a list are first verified against its smallest one.
Verification counts the shingles, 64-bit hashes, of whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm import shared, words
from waybill.llm.components import components

INDEX, SEARCH, SEARCH_BELOW = 1, 2, 4
BUCKET_KEYS = 1_500_000
SEND_IDS = 1_000_000
STARS = 2
HOT_SETS = 32
#: Places of the table of approximate shingle counts that orders shingles by rarity.
RARITY = 1 << 18
#: Shingles that one task counts into such a table, on average.
COUNTED = 500_000
PLACE = "struct<doc_id:bigint,mark:bigint>"
_SEGMENT = np.uint64(0x2545F4914F6CDD1D)
_BAND = np.uint64(0x9FB21C651E98DF25)
_KIND = np.uint64(0xA0761D6478BD642F)


def _bounds() -> np.ndarray:
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, -(-out[-1] * 4 // 3)))
    return np.array(out, np.int64)


#: Smallest size of each band; the bands overlap no more than two for any search.
BOUNDS = _bounds()


def band_of(sizes: np.ndarray) -> np.ndarray:
    return np.searchsorted(BOUNDS, sizes, "right") - 1


def segments_of(bands: np.ndarray) -> np.ndarray:
    """Segments of a band: a quarter and eight more than the largest difference bound in it needs."""
    need = (BOUNDS[bands + 1] - 1) // 3 + 1
    return np.where(need == 1, 1, -(-need * 5 // 4) + 8)


def needed(sizes: np.ndarray, bands: np.ndarray) -> np.ndarray:
    """Difference bound of a searching set and the largest set of a band, plus 1."""
    return (np.minimum(sizes, BOUNDS[bands + 1] - 1) + sizes) // 7 + 1


@dataclass
class Sets:
    """Distinct shingles of the non-empty rows of a slice: ``values`` from ``first[i]`` on, sorted."""

    rows: np.ndarray
    values: np.ndarray
    first: np.ndarray
    names: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.first)


def sets_of(data: np.ndarray, offsets: np.ndarray) -> Sets:
    """The sets of a slice; a set's name is a hash of its content, equal for equal sets."""
    shingles, begin = words.shingle_hashes(*words.word_hashes(data, offsets))
    rows = np.flatnonzero(np.diff(begin))
    parts = [np.unique(shingles[begin[r] : begin[r + 1]]) for r in rows]
    first = np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int64)
    values = np.concatenate(parts) if parts else shingles[:0]
    names = words.mixed(np.add.reduceat(words.mixed(values), first[:-1]) + np.diff(first).astype(np.uint64)) if parts else values
    return Sets(rows, values, first, (names >> np.uint64(1)).astype(np.int64))


@dataclass
class Dealt:
    """The non-empty segments of sets in a band: set, segment, shingle count and sum, and search rank."""

    sets: np.ndarray
    segment: np.ndarray
    count: np.ndarray
    total: np.ndarray
    rank: np.ndarray
    index: np.ndarray
    of_value: np.ndarray


def deal(s: Sets, which: np.ndarray, bands: np.ndarray, seed: int) -> Dealt:
    """Deal the sets ``which`` to the segments of ``bands``; ``of_value`` gives each shingle's segment."""
    sizes = s.sizes[which]
    segments = segments_of(bands)
    base = np.cumsum(segments) - segments
    owner = np.repeat(np.arange(len(which)), sizes)
    at = np.arange(sizes.sum()) + np.repeat(s.first[:-1][which] - (np.cumsum(sizes) - sizes), sizes)
    h = words.mixed(s.values[at] + np.uint64(seed + 1) * _SEGMENT)
    place = base[owner] + ((h >> np.uint64(32)) * segments[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    count = np.bincount(place, minlength=int(segments.sum()))
    total = np.zeros(len(count), np.uint64)
    np.add.at(total, place, words.mixed(h))
    live = np.flatnonzero(count)
    sets = np.searchsorted(base, live, "right") - 1
    order = np.lexsort((-count[live], sets))
    rank = np.empty(len(live), np.int64)
    begin = np.searchsorted(sets, np.arange(len(which)))
    rank[order] = np.arange(len(live)) - begin[sets[order]]
    return Dealt(sets, live - base[sets], count[live], total[live], rank, np.searchsorted(live, place), h)


def _keys(bands: np.ndarray, seed: int, segment: np.ndarray, total: np.ndarray, kind: int) -> np.ndarray:
    h = total + segment.astype(np.uint64) * _SEGMENT + bands.astype(np.uint64) * _BAND
    return words.mixed(h + np.uint64(seed * 2 + kind) * _KIND)


def shortage(d: Dealt, n: int, need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each set the searches that segments alone do not give, and those that one difference can give."""
    live = np.bincount(d.sets, minlength=n)
    more = np.bincount(d.sets[d.count > 1], minlength=n)
    return np.maximum(0, need - live), more


def searches(s: Sets) -> Iterator[tuple[np.ndarray, np.ndarray, int, Dealt, np.ndarray, np.ndarray]]:
    """``(sets, bands, seed, dealt, need, short)`` such that every set's searches are feasible.

    A set searches its own band and, if smaller partners lie there, the next lower one.
    """
    own = band_of(s.sizes)
    lowest = band_of(-(-s.sizes * 3 // 4))
    below = np.flatnonzero(lowest < own)
    for which, bands in ((np.arange(len(own)), own), (below, own[below] - 1)):
        seed = 0
        while len(which):
            d = deal(s, which, bands, seed)
            need = needed(s.sizes[which], bands)
            short, more = shortage(d, len(which), need)
            good = short <= more
            yield which, bands, seed, d, need, np.where(good, short, -1)
            which, bands, seed = which[~good], bands[~good], seed + 1


def allowances(s: Sets) -> tuple[np.ndarray, list[tuple[int, int, bool]]]:
    """What each set may give up, and what the plain scheme does not give.

    The first is the number of segments beyond those it must search, in its own band and the next lower
    one. The second lists ``(band, seed, with one difference)`` searched by some set beside the plain way.
    """
    own = band_of(s.sizes)
    slack = np.zeros((len(own), 2), np.int64)
    found = set()
    for which, bands, seed, d, need, short in searches(s):
        if not seed:
            free = np.bincount(d.sets, minlength=len(which)) - need
            slack[which, (bands != own[which]).astype(int)] = np.where(short == 0, free, 0)
        for i in np.flatnonzero(short > 0) if not seed else np.flatnonzero(short >= 0):
            found.add((int(bands[i]), seed, bool(short[i] > 0)))
    return slack, sorted(found)


def keys_of(s: Sets, extra: list[tuple[int, int, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(set, key, role)`` of all index and search entries."""
    out: list[tuple[np.ndarray, np.ndarray, int]] = []

    def without_one(which, bands, seed, d: Dealt, chosen: np.ndarray, kind: int, role) -> None:
        """Entries of the chosen segments' subsets with one shingle taken out."""
        value = np.flatnonzero(chosen[d.index])
        seg = d.index[value]
        total = d.total[seg] - words.mixed(d.of_value[value])
        out.append((which[d.sets[seg]], _keys(bands[d.sets[seg]], seed, d.segment[seg], total, kind), role[d.sets[seg]]))

    own = band_of(s.sizes)
    for which, bands, seed, d, _, short in searches(s):
        role = np.where(bands == own[which], SEARCH, SEARCH_BELOW).astype(np.uint8)
        fine = short[d.sets] >= 0
        key = _keys(bands[d.sets], seed, d.segment, d.total, 0)
        out.append((which[d.sets[fine]], key[fine], role[d.sets[fine]]))
        loose = fine & (d.rank < short[d.sets])
        if loose.any():
            out.append((which[d.sets[loose]], _keys(bands[d.sets[loose]], seed, d.segment[loose], d.total[loose], 1), role[d.sets[loose]]))
            without_one(which, bands, seed, d, loose, 0, role)
    plans = {(-1, 0, False)} | {(b, seed, False) for b, seed, _ in extra if seed} | {(b, seed, True) for b, seed, one in extra if one}
    for band, seed, one in sorted(plans):
        which = np.arange(len(own)) if band < 0 else np.flatnonzero(own == band)
        if not len(which):
            continue
        d = deal(s, which, own[which], seed)
        role = np.full(len(which), INDEX, np.uint8)
        if one:
            without_one(which, own[which], seed, d, np.ones(len(d.sets), bool), 1, role)
        else:
            out.append((which[d.sets], _keys(own[which][d.sets], seed, d.segment, d.total, 0), role[d.sets]))
    sets, keys, role = (np.concatenate([o[k] for o in out]) for k in range(3))
    # A set's entries under one key are one.
    order = np.lexsort((keys, sets))
    sets, keys, role = sets[order], keys[order], role[order]
    first = np.flatnonzero(np.append(True, (sets[1:] != sets[:-1]) | (keys[1:] != keys[:-1])))
    return sets[first], keys[first], np.bitwise_or.reduceat(role, first)


def _batches(rows, function):
    """``mapInArrow`` body: ``function(batch, first row, sets)`` for every slice of ``(doc_id, text)``."""
    for batch in rows:
        data, offsets = words.utf8(batch.column(1))
        for a, b in words.slices(offsets, words.SMALL_SLICE_BYTES):
            yield from function(batch, a, b, sets_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))


def rare_lists(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``shingle``, ``name``, ``n``, ``place`` and ``head``: the rarest quarter of the shingles of each of ``members`` (``name``, ``n``).

    ``place`` counts from 0 in the order of rarity. A set whose partner is as large or larger shares the
    rarest common shingle within its first seventh, ``head``, and the partner within its first quarter.
    Rarity is the count of a shingle's place in a table of fixed size; any order of the shingles finds all
    linked pairs, and one by rarity keeps the lists short. Shingles that one set has, or none as head, are left out.
    """
    chosen = sets.join(members.select("name"), "name", "left_semi").select("name", "values")
    parts = -(-max(1, members.agg(F.sum("n")).first()[0] or 0) // COUNTED)

    def places(values: np.ndarray) -> np.ndarray:
        return (words.mixed(values) & np.uint64(RARITY - 1)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(RARITY, np.int64)
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64)
            total += np.bincount(places(values), minlength=RARITY)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["place", "n"])

    rarity = np.zeros(RARITY, np.int64)
    counted = chosen.coalesce(parts).mapInArrow(shared.lean(count), "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    rarity[counted["place"].to_numpy()] = counted["n"].to_numpy()
    sent = sets.sparkSession.sparkContext.broadcast(rarity)

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, shingles, place, head = [], [], [], []
            sizes = np.zeros(batch.num_rows, np.int64)
            for row, values in enumerate(batch.column(1)):
                values = np.frombuffer(values.as_buffer(), np.uint64)
                n = sizes[row] = len(values)
                first = np.lexsort((values, sent.value[places(values)]))[: n - -(-3 * n // 4) + 1]
                owner.append(np.full(len(first), row))
                shingles.append(values[first])
                place.append(np.arange(len(first)))
                head.append(np.arange(len(first)) <= n - -(-6 * n // 7))
            if owner:
                owner = np.concatenate(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(shingles).view(np.int64)),
                        batch.column(0).take(pa.array(owner)),
                        pa.array(sizes[owner]),
                        pa.array(np.concatenate(place)),
                        pa.array(np.concatenate(head)),
                    ],
                    ["shingle", "name", "n", "place", "head"],
                )

    entries = shared.kept(chosen.mapInArrow(shared.lean(rarest), "shingle long, name long, n long, place long, head boolean"))
    live = entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("_n"), F.max("head").alias("_head")).where("_n > 1 AND _head").select("shingle")
    return shared.kept(entries.join(live, "shingle"))


def rare_pairs(lists: DataFrame, parts: DataFrame | None, central: bool) -> DataFrame:
    """Pairs ``a < b`` of sets in different components that may be linked, from the lists of their rarest shingles.

    With ``central`` only those with the smallest set of each list, as many as there are entries. Where the
    rarest common shingle stands, what is left of either set must hold all that the two have to share; pairs
    that meet at a shingle where it cannot are left out there, and a linked pair meets at its rarest one.
    """
    if parts is None:
        lists = lists.withColumn("part", F.col("name"))
    else:
        lists = lists.join(parts, F.col("name") == F.col("node"), "left").select("shingle", "name", "n", "place", "head", F.coalesce("component", "name").alias("part"))
    small = lists.where("head").select("shingle", F.struct(F.col("n").alias("m"), F.col("name").alias("b"), F.col("place").alias("at"), F.col("part").alias("q")).alias("_small"))
    if central:
        small = small.groupBy("shingle").agg(F.min("_small").alias("_small"))
    small = small.select("shingle", "_small.*")
    order = (F.col("m") < F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("b") < F.col("name")))
    rest = 7 * F.least(F.col("n") - F.col("place"), F.col("m") - F.col("at")) >= 3 * (F.col("n") + F.col("m"))
    return lists.join(small, "shingle").where((F.col("part") != F.col("q")) & order & rest).select(F.least("name", "b").alias("a"), F.greatest("name", "b").alias("b"))


def named(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text), set size ``n``, set name (NULL: no set), ``slack`` and exceptional searches of every row."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each(batch, a, b, s: Sets):
            n, name, slack = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64), np.zeros((b - a, 2), np.int64)
            extra = []
            if len(s.rows):
                n[s.rows], name[s.rows] = s.sizes, s.names
                slack[s.rows], found = allowances(s)
                extra = [{"band": x, "seed": y, "one": z} for x, y, z in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[a:b],
                    batch.column(2)[a:b],
                    pa.array(n),
                    pa.array(name, mask=n == 0),
                    pa.array(slack[:, 0]),
                    pa.array(slack[:, 1]),
                    pa.array([extra] + [[]] * (b - a - 1), kind),
                ],
                ["doc_id", "mark", "n", "name", "slack", "slack_below", "extra"],
            )

        kind = pa.list_(pa.struct([("band", pa.int32()), ("seed", pa.int32()), ("one", pa.bool_())]))
        yield from _batches(rows, each)

    schema = "doc_id long, mark long, n long, name long, slack long, slack_below long, extra array<struct<band:int,seed:int,one:boolean>>"
    return shared.kept(documents.mapInArrow(shared.lean(run), schema))


def grouped(documents: DataFrame, buckets: int, extra: list[tuple[int, int, bool]]) -> DataFrame:
    """``gid``, ``name``, ``role`` of sets that share a key, one indexed and one searching, and their ``keys``.

    Keys travel packed, a row per slice and bucket, five bytes a key; a bucket is a bounded share of all
    keys. Groups of the same members are one group of several keys.
    """

    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each(batch, a, b, s: Sets):
            if not len(s.rows):
                return
            _, once = np.unique(s.names, return_index=True)
            if len(once) < len(s.names):
                lengths = s.sizes[once]
                at = np.arange(lengths.sum()) + np.repeat(s.first[:-1][once] - (np.cumsum(lengths) - lengths), lengths)
                s = Sets(s.rows[once], s.values[at], np.append(0, np.cumsum(lengths)), s.names[once])
            sets, keys, role = keys_of(s, extra)
            bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            order = np.lexsort((sets, bucket))
            sets, keys, role, bucket = sets[order], keys[order], role[order], bucket[order]
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            low = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            high = (((keys >> np.uint64(32)) & np.uint64(0x1F)).astype(np.uint8) << 3) | role
            blobs, live = [], np.flatnonzero(np.diff(edges))
            for k in live:
                x, y = edges[k], edges[k + 1]
                own, n = np.unique(sets[x:y], return_counts=True)
                parts = (np.array([len(own)], np.uint32), s.names[own], n.astype(np.uint32), low[x:y], high[x:y])
                blobs.append(b"".join(p.tobytes() for p in parts))
            yield pa.RecordBatch.from_arrays([pa.array(live.astype(np.int32)), pa.array(blobs, pa.binary())], ["bucket", "blob"])

        yield from _batches(rows, each)

    def meet(table: pa.Table) -> pa.Table:
        names, keys = [], []
        for blob in table["blob"].to_pylist():
            n = int(np.frombuffer(blob, np.uint32, 1)[0])
            own = np.frombuffer(blob, np.int64, n, 4)
            counts = np.frombuffer(blob, np.uint32, n, 4 + 8 * n)
            total = int(counts.sum())
            low = np.frombuffer(blob, np.uint32, total, 4 + 12 * n).astype(np.uint64)
            high = np.frombuffer(blob, np.uint8, total, 4 + 12 * n + 4 * total).astype(np.uint64)
            names.append(np.repeat(own, counts))
            keys.append((high >> np.uint64(3) << np.uint64(35)) | (low << np.uint64(3)) | (high & np.uint64(7)))
        name, key = np.concatenate(names), np.concatenate(keys)
        role, key = (key & np.uint64(7)).astype(np.uint8), key >> np.uint64(3)
        # Keys that come once, most of them, go before the larger sort.
        order = np.argsort(key, kind="stable")
        key = key[order]
        same = np.append(key[1:] == key[:-1], False)
        same[1:] |= same[:-1]
        order, key = order[same], key[same]
        name, role = name[order], role[order]
        order = np.lexsort((name, key))
        key, name, role = key[order], name[order], role[order]
        if not len(key):
            return pa.table({c: pa.array([], t) for c, t in (("gid", pa.int64()), ("name", pa.int64()), ("role", pa.int32()), ("keys", pa.int64()))})
        fresh = np.append(True, (key[1:] != key[:-1]) | (name[1:] != name[:-1]))
        role = np.bitwise_or.reduceat(role, np.flatnonzero(fresh))
        key, name = key[fresh], name[fresh]
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(begin, len(key)))
        roles = np.bitwise_or.reduceat(role, begin)
        good = (size > 1) & ((roles & INDEX) > 0) & (roles > INDEX)
        part = words.mixed(name.astype(np.uint64) + role.astype(np.uint64) * _KIND)
        gid = (words.mixed(np.add.reduceat(part, begin)) >> np.uint64(1)).astype(np.int64)
        gid, once, times = np.unique(gid[good], return_index=True, return_counts=True)
        picked = np.flatnonzero(good)[once]
        sizes = size[picked]
        at = np.arange(sizes.sum()) + np.repeat(begin[picked] - (np.cumsum(sizes) - sizes), sizes)
        return pa.table(
            {"gid": np.repeat(gid, sizes), "name": name[at], "role": role[at].astype(np.int32), "keys": np.repeat(times, sizes).astype(np.int64)}
        )

    packed = documents.mapInArrow(shared.lean(pack), "bucket int, blob binary")
    met = packed.groupBy("bucket").applyInArrow(shared.lean_group(meet), "gid long, name long, role int, keys long")
    return met.groupBy("gid", "name", "role").agg(F.sum("keys").alias("keys"))


def afforded(groups: DataFrame, slack: DataFrame) -> DataFrame:
    """The groups that are still searched once every set has given up its longest lists.

    A set may give up ``slack`` keys in its own band and ``slack_below`` in the next lower one, and still
    shares a searched key with every partner. ``seeks`` marks the members that still search; members that
    are only indexed stay for them.
    """
    sizes = groups.groupBy("gid").agg(F.count(F.lit(1)).alias("size"))
    below = (F.col("role") >= SEARCH_BELOW).alias("below")
    seekers = groups.where(F.col("role") > INDEX).join(sizes, "gid").select("gid", "name", "keys", "size", below).join(slack, "name")
    order = Window.partitionBy("name", "below").orderBy(F.desc("size"), "gid").rowsBetween(Window.unboundedPreceding, 0)
    allowed = F.when(F.col("below"), F.col("slack_below")).otherwise(F.col("slack"))
    seekers = seekers.withColumn("spent", F.sum("keys").over(order)).where(F.col("spent") > allowed).select("gid", "name", F.lit(True).alias("seeks"))
    live = groups.join(seekers, ["gid", "name"], "left").select("gid", "name", F.coalesce("seeks", F.lit(False)).alias("seeks"), "role")
    live = live.where(F.col("seeks") | (F.col("role").bitwiseAND(INDEX) > 0)).drop("role")
    sought = seekers.select("gid").distinct()
    return live.join(sought, "gid", "left_semi")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` of names whose sets reach the similarity, counted on the sets themselves."""
    left = sets.select(F.col("name").alias("a"), F.col("values").alias("x"))
    right = sets.select(F.col("name").alias("b"), F.col("values").alias("y"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= 75 * (len(x) + len(y) - common))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(shared.lean(count), "a long, b long")


def joined(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (smallest doc_id linked to it) of every row.

    Two documents link when the Jaccard of their sets of five-word shingles is at least 0.75. NULL and
    empty texts have no set and stand alone; rows of equal sets are one class and never paired among
    themselves. Shingles are 64-bit hashes. A NULL doc_id is kept with a NULL component unless linked to
    others. Repeated rows are kept. Other columns are ignored.
    """
    return _labelled(*_components(documents)).select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("_low", "doc_id").alias("component_id"))


def _components(documents: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rows with the names of their sets, and the component of every linked set."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = named(texts.withColumn("mark", F.xxhash64(F.coalesce("text", F.lit("")))))
    extra = [(r["band"], r["seed"], r["one"]) for r in rows.select(F.explode("extra").alias("e")).select("e.*").distinct().collect()]
    total = rows.agg(F.sum("n")).first()[0] or 0
    met = shared.kept(grouped(texts, max(16, -(-total // BUCKET_KEYS)), sorted(extra)))
    classes = rows.where("n > 0").groupBy("name").agg(
        F.min("doc_id").alias("doc_id"), *[F.max(c).alias(c) for c in ("n", "slack", "slack_below")]
    )
    groups = shared.kept(afforded(met, classes.select("name", "slack", "slack_below")))
    members = groups.groupBy("name").agg(F.count(F.lit(1)).alias("degree"))
    wanted = shared.kept(members.join(classes, "name"))
    ids = wanted.select("doc_id", F.col("name").alias("_name")).where("doc_id IS NOT NULL")
    few = wanted.count() <= SEND_IDS
    # Few enough ids are sent to the scan; beyond that, texts and ids are shuffled.
    found = texts.join(F.broadcast(ids) if few else ids, "doc_id")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each(batch, a, b, s: Sets):
            names = batch.column(2)[a:b].to_numpy()
            hit = [i for i in range(len(s.rows)) if names[s.rows[i]] == s.names[i]]
            values = [s.values[s.first[i] : s.first[i + 1]].tobytes() for i in hit]
            yield pa.RecordBatch.from_arrays([pa.array(s.names[hit]), pa.array(values, pa.binary())], ["name", "values"])

        yield from _batches(batches, each)

    def collect_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each(batch, a, b, s: Sets):
            values = [s.values[x:y].tobytes() for x, y in zip(s.first[:-1], s.first[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(s.names), pa.array(values, pa.binary())], ["name", "values"])

        yield from _batches(batches, each)

    fetched = found.select("doc_id", "text", "_name").mapInArrow(shared.lean(collect), "name long, values binary")
    # Sets that only rows without doc_id have are found by their names.
    nowhere = wanted.where("doc_id IS NULL").select("name")
    if not nowhere.isEmpty():
        unnamed = texts.where("doc_id IS NULL").mapInArrow(shared.lean(collect_all), "name long, values binary")
        fetched = fetched.unionByName(unnamed.join(nowhere, "name", "left_semi"))
    sets = shared.table(fetched.dropDuplicates(["name"]), "sets")
    central = Window.partitionBy("gid").orderBy(F.desc("seeks"), F.desc("degree"), "name")
    ranked = groups.join(wanted.select("name", "degree"), "name").withColumn("star", F.row_number().over(central)).where(F.col("star") <= STARS)
    stars = shared.kept(ranked.select("gid", "star", F.col("name").alias("centre")))
    sizes = wanted.select("name", "n")
    links, parts = None, None
    for step in range(1, STARS + 2):
        now = groups.join(sizes, "name")
        if parts is None:
            now = now.withColumn("part", F.col("name"))
        else:
            now = now.join(parts, F.col("name") == F.col("node"), "left").select("gid", "name", "seeks", "n", F.coalesce("component", "name").alias("part"))
        if step <= STARS:
            other = stars.where(F.col("star") == step).select("gid", F.col("centre").alias("b"))
            other = other.join(now.select("gid", F.col("name").alias("b"), F.col("n").alias("m"), F.col("part").alias("q")), ["gid", "b"])
        else:
            mixed = now.groupBy("gid").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p < q").select("gid")
            done = stars.select("gid", F.col("centre").alias("name"))
            now = shared.kept(now.join(mixed, "gid", "left_semi").join(done, ["gid", "name"], "left_anti"))
            hot = now.groupBy("gid").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_SETS).select("gid")
            crowd = shared.kept(now.join(hot, "gid", "left_semi").select("name", "n").distinct())
            now = now.join(hot, "gid", "left_anti")
            other = now.where("seeks").select("gid", F.col("name").alias("b"), F.col("n").alias("m"), F.col("part").alias("q"))
        apart = (F.col("part") != F.col("q")) & (4 * F.least("n", "m") >= 3 * F.greatest("n", "m"))
        if step > STARS:
            apart &= ~F.col("seeks") | (F.col("name") < F.col("b"))
        pairs = now.join(other, "gid").where(apart).select(F.least("name", "b").alias("a"), F.greatest("name", "b").alias("b"))
        if step > STARS and not crowd.isEmpty():
            lists = rare_lists(crowd, sets)
            near = shared.kept(verified(rare_pairs(lists, parts, True).distinct(), sets))
            if not near.isEmpty():
                links = links.unionAll(near)
                parts = components(links)
            pairs = pairs.unionByName(rare_pairs(lists, parts, False))
        pairs = pairs.distinct()
        new = shared.kept(verified(pairs, sets))
        links = new if links is None else links.unionAll(new)
        if not new.isEmpty():
            parts = components(links)
    return rows, parts


def _labelled(rows: DataFrame, parts: DataFrame | None) -> DataFrame:
    """Every row with its component of sets (``part``; NULL without a set) and that one's smallest doc_id (``_low``)."""
    rows = rows.select("doc_id", "mark", "n", "name")
    if parts is None:
        rows = rows.withColumn("part", F.col("name"))
    else:
        rows = rows.join(parts, F.col("name") == F.col("node"), "left").select("doc_id", "mark", "n", F.coalesce("component", "name").alias("part"))
    low = rows.where("part IS NOT NULL").groupBy(F.col("part").alias("_part")).agg(F.min("doc_id").alias("_low"))
    return rows.join(low, F.col("part") == F.col("_part"), "left")


def representatives(documents: DataFrame) -> DataFrame:
    """One row of each component, all columns: that of its smallest doc_id (no doc_id last), of several texts with
    this doc_id the one whose hash is smallest, of repeated rows one.

    NULL and empty texts have no set, are components of their own, and stay; repeated rows of one doc_id
    and no text are one.
    """
    rows = shared.kept(_labelled(*_components(documents)))
    known = rows.where("part IS NOT NULL")
    ours = F.col("doc_id").eqNullSafe(F.col("_low"))
    chosen = known.where(ours).groupBy("part", "doc_id").agg(F.min("mark").alias("mark")).select("doc_id", "mark")
    empty = rows.where("part IS NULL").select("doc_id", "mark")
    keep = chosen.unionByName(empty.where("doc_id IS NOT NULL")).distinct().select(F.struct("doc_id", "mark").cast(PLACE).alias("_place"))
    place = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("mark"))
    # One column of one type, so that the join and the choice among repeated rows need one shuffle of the texts.
    marked = documents.withColumn("_place", place.cast(PLACE))
    first = marked.join(keep, "_place", "left_semi").dropDuplicates(["_place"]).select(documents.columns)
    blank = empty.where("doc_id IS NULL").select("mark").distinct().select(F.col("mark").alias("_by"))
    alone = marked.where("doc_id IS NULL").join(blank, F.col("_place.mark") == F.col("_by"), "left_semi")
    return first.unionByName(alone.select(documents.columns))
