"""Exact Jaccard self-join of word n-gram sets: size bands, tiles, bitmap bounds, sorted intersection.

1. Every text becomes its sorted set of shingle hashes; texts of equal sets are
   one class, named by the 64-bit id of the set (the id is a hash: two different
   sets share one with a chance of 2**-64 a pair).
2. Which sets may link at all? Within a band of sizes every set is cut into the
   same number of parts by hash range. Two sets that link differ in at most ``k``
   shingles, so all but ``k`` parts agree; each set therefore sends only its
   ``k + 1`` largest parts, in one order for all sets, and two linking sets send
   an equal part (the prefix principle, on parts instead of single shingles, so a
   phrase that half of all texts contain brings few of them together). A set near
   a band's lower end also sends the parts of the band below. Equal parts join
   sets to blocks; nothing is lost and no pair is listed.
3. A block is laid out in tiles of bounded size, by size band. Bitmaps meet within a
   tile and across tiles of the same or the next band: the parity of how many
   members of a set have each hash value. Their bit counts bound the overlap of
   every pair from above. Pairs that the bound lets pass connect to narrower blocks.
4. The narrower blocks are laid out in the same way, now with the sets themselves.
   What the bound lets pass is intersected exactly, unless verified links already
   connect the two. Verified links give the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflux.llm.common import components, cut_lineage, ship_package, slices
from odflux.llm.word_arrays import mix, set_id, shingle_sets

#: A tile holds at most so many sets, and so many shingles where the sets themselves are carried.
TILE_SETS, TILE_SHINGLES = 1_024, 1_000_000
BAND_GROWTH = 1.5
#: Parts for each shingle that may differ; more make the parts smaller, fewer send more of the small ones.
PARTS_PER_DIFFERENCE = 1.42
WIDEST_BITMAP = 4_096


def most_apart(size: int, percent: int) -> int:
    """Most shingles by which a set whose smaller side has ``size`` may differ from a partner at ``percent``."""
    return (100 * size // percent) * (100 - percent) // 100


class Bands:
    """Bounds of the size bands, and the number of parts that all sets of a band are cut into."""

    def __init__(self, percent: int):
        self.percent, self.lows, self.parts = percent, [1], []

    def of(self, size: int) -> int:
        while self.lows[-1] <= size:
            step = max(BAND_GROWTH, 100 / self.percent)
            self.lows.append(math.ceil(self.lows[-1] * step) + 1)
            top = self.lows[-1] - 1
            self.parts.append(math.ceil(PARTS_PER_DIFFERENCE * most_apart(top, self.percent)) + 1)
        at = len(self.lows) - 2
        while self.lows[at] > size:
            at -= 1
        return at


def part_keys(members: np.ndarray, bands: Bands) -> np.ndarray:
    """Keys under which a set looks for partners; sets that must be equal to link have none."""
    size, found = len(members), []
    own = bands.of(size)
    low = bands.lows[own]
    chances = [(own, most_apart(size, bands.percent))]
    if own and 100 * (low - 1) >= bands.percent * size:
        chances.append((own - 1, most_apart(low - 1, bands.percent)))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(members), dtype=np.uint64)])
    for band, apart in chances:
        if not apart:
            continue
        n = bands.parts[band]
        edges = ((np.arange(n + 1, dtype=np.uint64) << np.uint64(32)) + np.uint64(n - 1)) // np.uint64(n)
        cuts = np.searchsorted(members >> np.uint64(32), edges)
        held = np.diff(cuts)
        tag = np.arange(n, dtype=np.uint64) + np.uint64(band << 40)
        keys = mix((sums[cuts[1:]] - sums[cuts[:-1]]) ^ mix(tag) ^ mix(held.astype(np.uint64)))
        found.append(keys[np.lexsort((keys, -held))[:apart + 1]])
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _star_rows(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer (key, id) rows that connect the same ids: one per key, and one edge per further id of a key."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    head = ids[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(keys) else ids
    tied = ~first & (head != ids)
    edges = np.unique(np.stack([head[tied], ids[tied]], axis=1), axis=0)
    if not len(edges):
        return keys[first], ids[first]
    ends = edges.view(np.uint64)
    meet = mix(mix(ends[:, 0]) + ends[:, 1])
    return np.concatenate([keys[first], meet, meet]), np.concatenate([ids[first], edges[:, 0], edges[:, 1]])


def _sets_of(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        sizes, ids, bits = [], [], []
        for a, b in slices(texts):
            for members in shingle_sets(texts[a:b], width):
                sizes.append(len(members))
                ids.append(set_id(members))
                bits.append(bitmap(members).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), pa.array(bits, pa.binary())],
            ["doc", "size", "set_id", "bits"])


def _keys_of(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    bands = Bands(percent)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        keys, ids, seen = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], set()
        for a, b in slices(texts):
            for members in shingle_sets(texts[a:b], width):
                if not len(members) or (ident := set_id(members)) in seen:
                    continue
                seen.add(ident)
                own = part_keys(members, bands)
                keys.append(own)
                ids.append(np.full(len(own), ident, dtype=np.int64))
        kept, who = _star_rows(np.concatenate(keys), np.concatenate(ids))
        yield pa.RecordBatch.from_arrays([pa.array(kept.view(np.int64)), pa.array(who)], ["key", "id"])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges from the first id of each run of equal keys to the others. Rows come sorted; one row is carried along."""
    last_key, head = None, None
    for batch in batches:
        keys, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if not len(keys):
            continue
        first = np.concatenate([[last_key is None or keys[0] != last_key], keys[1:] != keys[:-1]])
        place = np.maximum.accumulate(np.where(first, np.arange(len(keys)), -1))
        heads = np.where(place >= 0, ids[place], ids[0] if head is None else head)
        last_key, head = keys[-1], heads[-1]
        tied = heads != ids
        edges = np.unique(np.stack([heads[tied], ids[tied]], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], ["a", "b"])


def bitmap(members: np.ndarray) -> np.ndarray:
    """For each hash value, the parity of how many members have it, 64 values a word; about two values a member."""
    bits = min(WIDEST_BITMAP, max(64, 1 << (2 * len(members) - 1).bit_length())) if len(members) else 64
    odd = np.bincount((members & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


class Folded:
    """Bitmaps of several widths, each also at every smaller width: the two halves of a parity bitmap add up to the narrower one."""

    def __init__(self, maps: list[np.ndarray]):
        self.own = [len(m) for m in maps]
        self.at: dict[int, np.ndarray] = {}
        for words in sorted(set(self.own), reverse=True):
            table = np.zeros((len(maps), words), dtype=np.uint64)
            for i, m in enumerate(maps):
                if len(m) >= words:
                    while len(m) > words:
                        m = m[:len(m) // 2] ^ m[len(m) // 2:]
                    table[i] = m
            self.at[words] = table

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        """Least number of members by which the set i differs from each of the others, none of which has a narrower bitmap."""
        table = self.at[self.own[i]]
        return np.bitwise_count(table[others] ^ table[i]).sum(axis=1, dtype=np.int64)


def spanning_pairs(sizes: np.ndarray, maps: list[np.ndarray], percent: int, agree=None) -> list[tuple[int, int]]:
    """Pairs that connect whatever is connected by all pairs that the bitmap bound and ``agree(i, j)`` let pass."""
    order = np.argsort(sizes, kind="stable")
    sizes, folded = sizes[order], Folded([maps[i] for i in order])
    label, found = np.arange(len(sizes)), []
    ends = np.searchsorted(sizes, 100 * sizes // percent, side="right")
    for i in range(len(sizes)):
        rest = np.arange(i + 1, ends[i])
        rest = rest[label[rest] != label[i]]
        if not len(rest):
            continue
        total = sizes[rest] + sizes[i]
        bound = np.minimum((total - folded.apart(i, rest)) // 2, sizes[i])
        for j in rest[100 * bound >= percent * (total - bound)].tolist():
            if label[j] != label[i] and (agree is None or agree(int(order[i]), int(order[j]))):
                label[label == label[j]] = label[i]
                found.append((int(order[i]), int(order[j])))
    return found


def spanning_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Linking pairs (places in ``sets``, none empty) that connect whatever all linking pairs connect."""
    def agree(i: int, j: int) -> bool:
        small, large = sorted((sets[i], sets[j]), key=len)
        at = np.searchsorted(large, small)
        at[at == len(large)] = 0
        common = int((large[at] == small).sum())
        return 100 * common >= percent * (len(small) + len(large) - common)

    return spanning_pairs(np.array([len(s) for s in sets]), [bitmap(s) for s in sets], percent, agree)


def _met(batches: Iterator[pa.RecordBatch], columns: list[str], pairs) -> Iterator[pa.RecordBatch]:
    """``pairs(values of the columns)`` of each run of rows of one meeting, as ids; one meeting is held at a time."""
    now, ids, held = None, [], [[] for _ in columns]

    def links() -> pa.RecordBatch:
        found = pairs(*held) if len(ids) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([ids[i] for i, _ in found], pa.int64()),
                                           pa.array([ids[j] for _, j in found], pa.int64())], ["a", "b"])

    for batch in batches:
        meeting, who = batch.column("meeting").to_pylist(), batch.column("id").to_pylist()
        values = []
        for name in columns:
            column = batch.column(name)
            if pa.types.is_list(column.type):
                flat, offsets = column.values.to_numpy(zero_copy_only=False).view(np.uint64), column.offsets.to_numpy()
                values.append([flat[a:b].copy() for a, b in zip(offsets[:-1], offsets[1:])])
            elif pa.types.is_binary(column.type):
                values.append([np.frombuffer(v, dtype=np.uint64) for v in column.to_pylist()])
            else:
                values.append(column.to_pylist())
        for k, m in enumerate(meeting):
            if m != now:
                yield links()
                now, ids, held = m, [], [[] for _ in columns]
            if who[k] not in ids[-1:]:  # rows of one meeting come sorted by id
                ids.append(who[k])
                for kept, value in zip(held, values):
                    kept.append(value[k])
    yield links()


def _members_of(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Sets of the representatives. A text whose set is not the expected one (a repeated doc id) is passed over."""
    for batch in batches:
        texts, wanted = batch.column("text").to_pylist(), batch.column("id").to_pylist()
        for a, b in slices(texts):
            sets = shingle_sets(texts[a:b], width)
            rows = [i for i, s in enumerate(sets) if set_id(s) == wanted[a + i]]
            flat = np.concatenate([np.zeros(0, np.uint64), *[sets[i] for i in rows]]).view(np.int64)
            offsets = np.cumsum([0, *[len(sets[i]) for i in rows]]).astype(np.int32)
            at = pa.array([a + i for i in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("meetings").take(at),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["id", "meetings", "members"])


def _meetings(classes: DataFrame, blocks: DataFrame, percent: int, carried: str, columns: list[str]) -> DataFrame:
    """(id, ``columns``, meetings): for each class of a block, the tile meetings it takes part in.

    ``carried`` is what a class weighs in a tile.
    """
    band = F.floor(F.log("size") / F.lit(math.log(100 / percent))).cast("int")
    inside = (classes.join(blocks.select(F.col("node").alias("id"), F.col("root").alias("block")), "id")
              .withColumn("band", band))
    counts = inside.groupBy("block", "band").agg(F.count("*").alias("n"), F.sum(F.expr(carried)).alias("held"))
    tiles = F.ceil(F.greatest(F.col("n") / TILE_SETS, F.col("held") / TILE_SHINGLES)).cast("int")
    whole = counts.groupBy("block").agg(F.sum("n").alias("all_n"), F.sum("held").alias("all_held"))
    here = counts.select("block", "band", tiles.alias("tiles"))
    # Each band tells its number of tiles to itself and to both neighbours: one shuffle instead of two joins.
    spread = (here.select("block", "band", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("step"), "tiles")
              .groupBy("block", (F.col("band") + F.col("step")).alias("band"))
              .agg(F.max(F.when(F.col("step") == 0, F.col("tiles"))).alias("own"),
                   F.coalesce(F.max(F.when(F.col("step") == 1, F.col("tiles"))), F.lit(0)).alias("below"),
                   F.coalesce(F.max(F.when(F.col("step") == -1, F.col("tiles"))), F.lit(0)).alias("above"))
              .where("own is not null"))
    plan = spread.join(whole, "block").withColumn("small", (F.col("all_n") <= TILE_SETS) & (F.col("all_held") <= TILE_SHINGLES))
    placed = inside.join(plan, ["block", "band"]).withColumn("tile", F.pmod(F.xxhash64("id"), F.col("own").cast("long")).cast("int"))
    return placed.select("id", *columns, F.expr("""
        case when small then array(xxhash64(block)) else concat(
            transform(sequence(0, own - 1), t -> xxhash64(block, band, least(t, tile), band, greatest(t, tile))),
            if(above = 0, array(), transform(sequence(0, above - 1), t -> xxhash64(block, band, tile, band + 1, t))),
            if(below = 0, array(), transform(sequence(0, below - 1), t -> xxhash64(block, band - 1, t, band, tile)))) end
        """).alias("meetings"))


def _at_meetings(rows: DataFrame, columns: list[str]) -> DataFrame:
    return (rows.select(F.explode("meetings").alias("meeting"), "id", *columns)
            .repartition("meeting").sortWithinPartitions("meeting", "id"))


def ngram_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``.

    Words are runs of anything but space, tab, LF, VT, FF and CR, with A-Z lowered;
    a text of fewer words than ``width`` has one shingle, all its words. Two texts
    link when ``100 * |intersection| >= percent * |union|``; ``component_id`` is
    the smallest id that links reach. A null, empty or blank text has no shingle,
    links with nothing and is its own component. Rows that share an id keep one
    row each. A null id stays null and is no smallest id unless its component has
    no other. Only the two named columns are read.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50 and at most 100")
    spark = docs.sparkSession
    ship_package(spark)
    source = docs.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("text"))
    kind = dict(source.dtypes)["doc"]
    base = cut_lineage(source.mapInArrow(lambda it: _sets_of(it, width), f"doc {kind}, size long, set_id long, bits binary"))
    keys = source.select("text").mapInArrow(lambda it: _keys_of(it, width, percent), "key long, id long")
    edges = (keys.repartition("key").sortWithinPartitions("key", "id")
             .mapInArrow(_stars, "a long, b long").distinct())
    wide = components(edges)
    classes = (base.where("size > 0").groupBy(F.col("set_id").alias("id"))
               .agg(F.min("doc").alias("doc"), F.first("size").alias("size")))
    # Folded by set first, so that a set with very many copies is one row a task before any shuffle.
    candidates = cut_lineage(base.where("size > 0").groupBy(F.col("set_id").alias("id"))
                             .agg(F.first("size").alias("size"), F.first("bits").alias("bits"))
                             .join(wide.select(F.col("node").alias("id")), "id", "left_semi"))
    narrow = components(_at_meetings(_meetings(candidates, wide, percent, "1", ["size", "bits"]), ["size", "bits"])
                        .mapInArrow(lambda it: _met(it, ["size", "bits"], lambda sizes, maps: spanning_pairs(np.array(sizes), maps, percent)),
                                    "a long, b long"))
    wanted = _meetings(classes, narrow, percent, "size", ["doc"]).withColumnRenamed("doc", "rep")
    sets = (source.join(wanted, F.col("doc").eqNullSafe(F.col("rep"))).select("text", "id", "meetings")
            .mapInArrow(lambda it: _members_of(it, width), "id long, meetings array<long>, members array<long>"))
    verified = _at_meetings(sets, ["members"]).mapInArrow(
        lambda it: _met(it, ["members"], lambda members: spanning_links(members, percent)), "a long, b long")
    linked = components(verified)
    roots = (classes.select("id", F.col("doc").alias("least"))
             .join(linked.select(F.col("node").alias("id"), "root"), "id", "left")
             .withColumn("root", F.coalesce("root", "id")))
    lowest = roots.groupBy("root").agg(F.min("least").alias("component"))
    named = roots.join(lowest, "root").select(F.col("id").alias("set_id"), "component")
    empty = base.where("size = 0").select("doc", "size", F.col("doc").alias("component"))
    return (base.where("size > 0").join(named, "set_id").select("doc", "size", "component").union(empty)
            .select(F.col("doc").alias(doc_id), F.col("size").alias("n_shingles"), F.col("component").alias("component_id")))
