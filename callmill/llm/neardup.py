"""Near-duplicate records with small edits (problem 6).

Similarity is that of the sets of distinct three-word sequences. A text's fingerprint has 128 coordinates, each the least
of a permuted hash over its set, so that two texts agree in a coordinate as often as their sets are similar. Covering
locality-sensitive hashing joins them: the coordinates form eight planes of 4 x 4 points and every line of a plane (20 of
4 points, no two points on fewer or more than one line) is a mask. Whatever six points of a plane two fingerprints
differ in, some line misses them all (a set that meets every line needs 2 * 4 - 1 = 7 points), so every pair within six
differences in some plane collides in some table, and so does every pair within 55 of all 128. A pair at a similarity of
0.6 misses one plane with a probability of 0.171 and all eight with 7e-7. Of the pairs that collide, those go on whose
sketches (two bits of each coordinate) agree as often as a similar pair's do but for a chance of 1e-9, and these are
compared exactly.

Texts with equal sets are one class, named by a 64-bit digest and represented by its least id; it is compared once and
its rows are joined in at the end. Keys travel in blocks, one for each batch and bucket, with their owners' differences
packed. A bucket's blocks are read as a stream. A key that more than STRETCH classes share is taken out of it: the
members that such keys connect are cut into slices, and pairs of slices are compared, by sketch and exactly, in separate
tasks, so that no key is capped, none is gathered in one place, and a large cluster is compared once and not for each key.

Defined results: null texts and texts of fewer than 12 words are left out; repeated rows of an id count once; equal
texts have similarity 1; ties play no part. Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.common import broadcast_if_small, read, stored
from callmill.llm.common import components, in_slices

WORDS, LEAST_WORDS, LEAST_SIMILARITY = 3, 12, 0.6
#: Points of a plane's side, a prime power of 2, and planes.
SIDE, PLANES = 4, 8
#: Keys for one bucket in the mean, keys of a bucket that are held before its common ones are taken out, classes of a key that are paired in one go, pairs made at once.
KEYS_A_BUCKET, HELD, STRETCH, PAIRS_AT_ONCE = 1_000_000, 4_000_000, 1_000, 2_000_000
#: Bits of the sets of a slice that are held at once.
BITS_HELD = 1_000_000_000
#: Chance that a pair of just the least similarity is lost by its sketches.
SKETCH_LOSS = 1e-9
#: Ids up to which a list of them is broadcast to the texts; a longer one is joined by shuffling them.
IDS_SENT = 1_000_000
_WORD = re.compile(r"[^\W_]+")


@lru_cache
def lines() -> np.ndarray:
    """The masks: the lines of the affine plane over the field of 4 elements, as point numbers. Addition is xor."""
    times = [[0, 0, 0, 0], [0, 1, 2, 3], [0, 2, 3, 1], [0, 3, 1, 2]]
    sloped = [[x * SIDE + (times[m][x] ^ c) for x in range(SIDE)] for m, c in product(range(SIDE), repeat=2)]
    upright = [[x * SIDE + y for y in range(SIDE)] for x in range(SIDE)]
    return np.array(sloped + upright)


@lru_cache
def least_agreement(least: float, planes: int = PLANES) -> int:
    """Sketch values that must agree: fewer do in a pair of similarity `least` with a chance under SKETCH_LOSS."""
    n, p, term, total = planes * SIDE * SIDE, least + (1 - least) / 4, 0.0, 0.0
    for k in range(n + 1):
        term = (1 - p) ** n if k == 0 else term * (n - k + 1) / k * p / (1 - p)
        total += term
        if total > SKETCH_LOSS:
            return k
    return n


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray | None:
    """The sorted distinct hashes of three words in a row, or None for a text of too few words."""
    at, g, _ = _sets([text])
    return g if len(at) else None


def _sets(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts that have enough words: their places in the list, all hashes in a row, and where each set begins."""
    split = pc.split_pattern_regex(pa.array([t.lower() if t else "" for t in texts], pa.large_string()), pattern=r"[^\p{L}\p{N}]+")
    words = split.values.dictionary_encode()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) if w else 0 for w in words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    real = pc.not_equal(words.dictionary, "").to_numpy(zero_copy_only=False)[words.indices.to_numpy()] if len(words) else np.empty(0, bool)
    own = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))[real]
    h = hashes[words.indices.to_numpy()[real]] if len(words) else np.empty(0, np.uint64)
    sizes = np.bincount(own, minlength=len(texts))
    at = np.flatnonzero(sizes >= LEAST_WORDS)
    if not len(at):
        return at, np.empty(0, np.uint64), np.empty(0, np.int64)
    enough = (sizes >= LEAST_WORDS)[own]
    own, h = (np.cumsum(sizes >= LEAST_WORDS) - 1)[own[enough]], h[enough]
    g = _mix(_mix(_mix(h[:-2]) + h[1:-1]) + h[2:])
    inside = own[:-2] == own[2:]
    g, own = g[inside], own[:-2][inside]
    order = np.lexsort((g, own))
    g, own = g[order], own[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (own[1:] != own[:-1])
    g, own = g[new], own[new]
    return at, g, np.searchsorted(own, np.arange(len(at)))


def _source(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("_text")).where("id is not null and _text is not null")


def _each_set(source: DataFrame, schema: str, f) -> DataFrame:
    """f(ids, hashes, starts) -> record batch, over slices of the texts that have enough words."""

    def run(batches):
        for part in in_slices(batches, "_text"):
            at, g, starts = _sets(part.column("_text").to_pylist())
            if len(at):
                yield f(part.column("id").to_numpy(zero_copy_only=False)[at], g, starts)

    return source.select("id", "_text").mapInArrow(run, schema)


def digests(g: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit number for each set, the same for equal sets."""
    return _mix(np.add.reduceat(_mix(g), starts)).view(np.int64)


def _rows(x: np.ndarray) -> pa.Array:
    """The rows of an array of bytes as binary values."""
    return pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())


def classes(source: DataFrame, planes: int = PLANES) -> DataFrame:
    """id, class, sketch for each row with enough words; equal sets have one class. The sketch has two bits of each coordinate."""

    def run(ids, g, starts):
        low = (coordinates(g, starts, planes) & np.uint32(3)).astype(np.uint8)
        return pa.record_batch([pa.array(ids), pa.array(digests(g, starts)), _rows((low[::4] << 6 | low[1::4] << 4 | low[2::4] << 2 | low[3::4]).T)], names=["id", "class", "sketch"])

    return _each_set(source, "id bigint, class bigint, sketch binary", run).dropDuplicates(["id"])


def coordinates(g: np.ndarray, starts: np.ndarray, planes: int = PLANES) -> np.ndarray:
    """The fingerprints: a row for each coordinate, a column for each set.

    Sets of like size stand side by side, the shorter ones filled up with a member, so that the least of each is found for all at once.
    """
    short, sizes = (g >> np.uint64(32)).astype(np.uint32), np.diff(np.append(starts, len(g)))
    order = np.argsort(sizes, kind="stable")
    turns = _mix(np.arange(1, 2 * planes * SIDE * SIDE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32).reshape(2, -1)
    points = np.empty((planes * SIDE * SIDE, len(starts)), np.uint32)
    done = 0
    while done < len(order):
        count = max(1, min(512, 200_000 // int(sizes[order[done]])))
        some = order[done : done + count]
        z = sizes[some]
        x = short[starts[some] + np.minimum(np.arange(z.max())[:, None], z - 1)]
        for i, (a, b) in enumerate(zip(*turns)):
            h = (x ^ b) * (a | np.uint32(1))
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x85EBCA6B)
            points[i, some] = h.min(axis=0)
        done += count
    points ^= points >> np.uint32(13)  # the least hashes have few high bits; spread what tells them apart
    points *= np.uint32(0xC2B2AE35)
    return points ^ (points >> np.uint32(16))


def keys_of(g: np.ndarray, starts: np.ndarray, planes: int = PLANES) -> np.ndarray:
    """The keys of each set, a row for each mask."""
    points, rows = coordinates(g, starts, planes).astype(np.uint64), []
    for plane in range(planes):
        for j, line in enumerate(lines()):
            p = points[plane * SIDE * SIDE + line]
            rows.append(_mix(_mix((p[0] << np.uint64(32) | p[1]) + np.uint64(plane * 100 + j + 1)) + (p[2] << np.uint64(32) | p[3])))
    return np.array(rows)


def pack_owners(ids: np.ndarray) -> bytes:
    """Ascending numbers as compressed differences, all their lowest bytes first."""
    steps = np.diff(ids, prepend=np.int64(0)).astype(np.int64)
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def unpack_owners(packed: bytes, n: int) -> np.ndarray:
    steps = np.frombuffer(pa.decompress(packed, 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(steps.T).view(np.int64).ravel())


def _packed_keys(source: DataFrame, buckets: int, planes: int) -> DataFrame:
    """bucket, keys, owners: blocks of columns, an owner being a row's id."""

    def run(ids, g, starts):
        keys = keys_of(g, starts, planes)
        flat, owner = keys.ravel(), np.tile(ids, len(keys))
        bucket = (flat % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((owner, bucket))
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1)) if buckets < len(order) else np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order))
        filled = np.flatnonzero(np.diff(edges))
        # what the bucket leaves of a key is kept to 32 bits: a chance agreement is a candidate more, no error
        flat, owner, bucket = ((flat // np.uint64(buckets)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)[order], owner[order], bucket[order]
        cuts = [(edges[k], edges[k + 1]) for k in filled]
        return pa.record_batch([pa.array([bucket[a] for a, _ in cuts], pa.int32()), pa.array([flat[a:b].tobytes() for a, b in cuts], pa.binary()), pa.array([pack_owners(owner[a:b]) for a, b in cuts], pa.binary())], names=["bucket", "keys", "owners"])

    return _each_set(source, "bucket int, keys binary, owners binary", run)


def _runs(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys and owners in order without repeats, and where each key's run begins and how long it is."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    new = np.r_[True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])] if len(keys) else np.empty(0, bool)
    keys, ids = keys[new], ids[new]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys, ids, first, np.diff(np.r_[first, len(keys)])


def run_pairs(ids: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs within the runs, each less < greater, for as many runs at once as make PAIRS_AT_ONCE pairs."""
    first, sizes = first[sizes > 1], sizes[sizes > 1]
    made = np.cumsum(sizes * (sizes - 1) // 2)
    cuts = np.searchsorted(made, np.arange(0, (made[-1] if len(made) else 0) + PAIRS_AT_ONCE, PAIRS_AT_ONCE), side="right")
    for low, high in zip(cuts, cuts[1:]):
        f, z, found = first[low:high], sizes[low:high], []
        for d in range(1, int(z.max(initial=0))):
            f, z = f[z > d], z[z > d]
            at = np.repeat(f, z - d) + np.arange((z - d).sum()) - np.repeat(np.cumsum(z - d) - (z - d), z - d)
            found.append((ids[at], ids[at + d]))
        if found:
            a, b = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
            yield a[new], b[new]


def bucket_pairs(blocks: Iterator[tuple[int, np.ndarray, np.ndarray]], held: int = HELD, stretch: int = STRETCH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """(a, b, None) of the pairs that share a key, and (bucket and key, owner, ...) of the keys that more than `stretch` share.

    blocks(bucket, keys, owners) come bucket by bucket. Where a bucket grows beyond `held`, its common keys are taken out at once
    and what comes of them later passes by, so that what is held stays in proportion to the other keys.
    """
    now, common = None, np.empty(0, np.uint32)
    kept: list = []
    most = held

    def sifted() -> tuple:
        """The buffer's runs, and the rows of its common keys."""
        keys, ids, first, sizes = _runs(np.concatenate([k for k, _ in kept]), np.concatenate([i for _, i in kept]))
        big = sizes > stretch
        rare = np.repeat(~big, sizes)
        return keys, ids, first, sizes, big, rare

    def close():
        if kept:
            keys, ids, first, sizes, big, rare = sifted()
            if big.any():
                yield (np.int64(now) << np.int64(32)) + keys[~rare].astype(np.int64), ids[~rare], np.ones(0)
            for a, b in run_pairs(ids, first[~big], sizes[~big]):
                yield a, b, None

    for bucket, keys, owners in blocks:
        if bucket != now:
            yield from close()
            now, common, most = bucket, np.empty(0, np.uint32), held
            kept = []
        if len(common):
            hit = np.isin(keys, common)
            if hit.any():
                yield (np.int64(now) << np.int64(32)) + keys[hit].astype(np.int64), owners[hit], np.ones(0)
                keys, owners = keys[~hit], owners[~hit]
        kept.append((keys, owners))
        if sum(len(k) for k, _ in kept) > most:
            keys, ids, first, sizes, big, rare = sifted()
            if big.any():
                yield (np.int64(now) << np.int64(32)) + keys[~rare].astype(np.int64), ids[~rare], np.ones(0)
                common = np.union1d(common, keys[first[big]])
            kept = [(keys[rare], ids[rare])]
            most = max(held, 2 * int(rare.sum()))
    yield from close()


def _collisions(packed: DataFrame, buckets: int) -> DataFrame:
    """a, b of the different pairs of owners that share a key, and key, a of the owners of common keys; stored."""
    held, stretch = HELD, STRETCH

    def run(batches):
        blocks = (
            (bucket, np.frombuffer(k, np.uint32), unpack_owners(o, len(k) // 4))
            for batch in batches
            for bucket, k, o in zip(batch.column("bucket").to_pylist(), batch.column("keys"), batch.column("owners"))
            for k, o in [(k.as_py(), o.as_py())]
        )
        for x, y, common in bucket_pairs(blocks, held, stretch):
            none = pa.nulls(len(x), pa.int64())
            yield pa.record_batch([none if common is None else pa.array(x), pa.array(x if common is None else y), pa.array(y) if common is None else none], names=["key", "a", "b"])

    # as many reducers as there are buckets, up to what one task may hold of them
    dealt = packed.repartition(max(1, min(buckets, 20_000)), "bucket").sortWithinPartitions("bucket")
    return stored(dealt.mapInArrow(run, "key bigint, a bigint, b bigint"), "collisions")


def _sketches(packed: list) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.uint64).reshape(len(packed), -1)


def agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many of the sketches' values are equal, over the last axis."""
    differ = x ^ y
    differ = (differ | differ >> np.uint64(1)) & np.uint64(0x5555555555555555)
    return 32 * x.shape[-1] - np.bitwise_count(differ).sum(axis=-1, dtype=np.int64)


def _promising(collisions: DataFrame, reps: DataFrame, agree: int) -> DataFrame:
    """a, b of the colliding pairs whose sketches agree in at least `agree` values."""
    sketches = reps.select("rep", "sketch")
    # one shuffle serves to find the different pairs and to join them
    pairs = collisions.where("key is null").select("a", "b").repartition("a").dropDuplicates(["a", "b"])
    sided = pairs.join(sketches.withColumnsRenamed({"rep": "a", "sketch": "x"}), "a").join(sketches.withColumnsRenamed({"rep": "b", "sketch": "y"}), "b")

    def compare(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (_sketches(batch.column(c).to_pylist()) for c in "xy")
                yield batch.select(["a", "b"]).filter(pa.array(agreement(x, y) >= agree))

    return sided.select("a", "b", "x", "y").mapInArrow(compare, "a bigint, b bigint")


def similar_in_blocks(left: list[dict], right: list[dict], agree: int, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(a, b) of the members (rep, sketch, grams) of two lists that are similar enough, by sketch and then exactly.

    The right sets are rows of bits over what they hold, unless that were too wide.
    """
    x, y = _sketches([r["sketch"] for r in left]), _sketches([r["sketch"] for r in right])
    ids, sets = np.array([r["rep"] for r in right]), [np.frombuffer(r["grams"], np.uint64) for r in right]
    sizes, held = np.array([len(g) for g in sets]), np.unique(np.concatenate(sets))
    wide = len(sets) * len(held) > BITS_HELD
    if not wide:
        bits = np.zeros((len(sets), -(-len(held) // 64)), np.uint64)
        for k, g in enumerate(sets):
            at = np.searchsorted(held, g)
            np.bitwise_or.at(bits[k], at // 64, np.uint64(1) << (at % 64).astype(np.uint64))
    for r, own in zip(left, x):
        near = np.flatnonzero(agreement(own[None], y) >= agree)
        g = np.frombuffer(r["grams"], np.uint64)
        if wide:
            both = np.array([len(np.intersect1d(g, sets[k], assume_unique=True)) for k in near], np.int64)
        else:
            at = np.searchsorted(held, g)
            at = at[(at < len(held))][held[at[at < len(held)]] == g[at < len(held)]]
            mine = np.zeros(bits.shape[1], np.uint64)
            np.bitwise_or.at(mine, at // 64, np.uint64(1) << (at % 64).astype(np.uint64))
            both = np.bitwise_count(bits[near] & mine).sum(axis=1, dtype=np.int64)
        found = ids[near[both >= least * (len(g) + sizes[near] - both)]]
        yield np.full(len(found), r["rep"]), found


def _similar_of_common(collisions: DataFrame, source: DataFrame, reps: DataFrame, agree: int, least: float) -> DataFrame | None:
    """a, b of the similar pairs that share a common key, or None where no key is common.

    Keys of one cluster hold much the same members, so the keys' connected members are compared once, unless that were
    more pairs than the keys have one by one. What is compared is cut into slices, and slices are paired in separate tasks.
    """
    common = stored(collisions.where("key is not null").select("key", F.col("a").alias("rep")).distinct(), "common")
    if common.isEmpty():
        return None
    named = common.select(F.concat(F.lit("k"), "key").alias("a"), F.concat(F.lit("r"), "rep").alias("b"))
    found = components(named, named.select(F.col("a").alias("node")).union(named.select("b")).distinct())
    of_key = found.where("node like 'k%'").select(F.substring("node", 2, 30).cast("bigint").alias("key"), "component")
    sized = common.groupBy("key").agg(F.count("*").alias("n")).join(of_key, "key")
    members = found.where("node like 'r%'").groupBy("component").agg(F.count("*").alias("m"))
    whole = sized.groupBy("component").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("apart")).join(members, "component")
    chosen = stored(sized.join(whole, "component").select("key", F.when(F.col("m").cast("double") * F.col("m") <= F.col("apart"), F.concat(F.lit("c"), "component")).otherwise(F.col("key").cast("string")).alias("group")), "chosen")
    grouped = stored(common.join(chosen, "key").select("group", "rep").distinct(), "groups")
    slices = grouped.groupBy("group").agg(F.ceil(F.count("*") / STRETCH).cast("int").alias("slices"))
    grams = _grams(source, grouped.select(F.col("rep").alias("id")).distinct()).withColumnRenamed("id", "rep")
    sliced = grouped.join(slices, "group").withColumn("slice", F.pmod(F.xxhash64("rep"), F.col("slices")).cast("int")).join(reps.select("rep", "sketch"), "rep").join(grams, "rep")
    held = stored(sliced.groupBy("group", "slice").agg(F.collect_list(F.struct("rep", "sketch", "grams")).alias("m")), "slices")

    def across(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                i, j, m, n = (one.column(c)[0].as_py() for c in ("i", "j", "m", "n"))
                for u, v in similar_in_blocks(m, n, agree, least):
                    keep = u < v if i == j else u != v
                    u, v = u[keep], v[keep]
                    yield pa.record_batch([pa.array(np.minimum(u, v), pa.int64()), pa.array(np.maximum(u, v), pa.int64())], names=["a", "b"])

    left, right = held.select("group", F.col("slice").alias("i"), "m"), held.select("group", F.col("slice").alias("j"), F.col("m").alias("n"))
    spread = max(200, 4 * common.sparkSession.sparkContext.defaultParallelism)
    blocks = left.join(right, "group").where("i <= j").repartition(spread, "group", "i", "j")
    return blocks.select("i", "j", "m", "n").mapInArrow(across, "a bigint, b bigint")


def _grams(source: DataFrame, ids: DataFrame) -> DataFrame:
    """id, grams of the rows of ids(id), all different; stored. Only their texts are taken apart again."""

    def run(own, g, starts):
        bounds = np.append(starts, len(g))
        return pa.record_batch([pa.array(own), pa.array([g[x:y].tobytes() for x, y in zip(bounds, bounds[1:])], pa.binary())], names=["id", "grams"])

    wanted = source.join(broadcast_if_small(stored(ids, "ids"), IDS_SENT), "id", "left_semi")
    return stored(_each_set(wanted, "id bigint, grams binary", run).dropDuplicates(["id"]), "grams")


def _verified(pairs: DataFrame, source: DataFrame, least: float) -> DataFrame:
    """Those of the pairs (a, b) of ids whose sets are similar enough."""
    grams = _grams(source, pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct())
    sided = pairs.join(grams.withColumnsRenamed({"id": "a", "grams": "x"}), "a").join(grams.withColumnsRenamed({"id": "b", "grams": "y"}), "b")

    def compare(batches):
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both >= least * (len(x) + len(y) - both):
                    keep.append(i)
            if keep:
                yield batch.select(["a", "b"]).take(pa.array(keep))

    return sided.select("a", "b", "x", "y").mapInArrow(compare, "a bigint, b bigint")


def near_duplicates(df: DataFrame, key: str, text: str, least: float = LEAST_SIMILARITY, planes: int = PLANES) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): members(id, class) gives each row's class of equal sets, named by the class's least id, pairs(a, b) the similar classes, a < b."""
    source = _source(df, key, text)
    found = stored(classes(source, planes), "classes")
    reps = stored(found.groupBy("class").agg(F.min("id").alias("rep"), F.min_by("sketch", "id").alias("sketch")), "representatives")
    members = stored(found.select("id", F.col("class").alias("digest")).join(reps.select(F.col("class").alias("digest"), F.col("rep").alias("class")), "digest").select("id", "class"), "members")
    buckets = max(1, -(-reps.count() * planes * len(lines()) // KEYS_A_BUCKET))
    copies = stored(members.where("id <> class").select("id"), "copies")
    texts = source.join(broadcast_if_small(copies, IDS_SENT), "id", "left_anti")
    collisions = _collisions(_packed_keys(texts, buckets, planes), buckets)
    agree = least_agreement(least, planes)
    similar = _verified(stored(_promising(collisions, reps, agree), "candidates"), source, least)
    of_common = _similar_of_common(collisions, source, reps, agree, least)
    return members, stored(similar if of_common is None else similar.union(of_common).distinct(), "similar")


def all_pairs(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """id_a < id_b of all rows of one class or of two similar classes."""
    x, y = members.withColumnsRenamed({"id": "ia", "class": "a"}), members.withColumnsRenamed({"id": "ib", "class": "b"})
    across = pairs.join(x, "a").join(y, "b").select("ia", "ib")
    within = x.join(y, x.a == y.b).where("ia < ib").select("ia", "ib")
    return across.union(within).select(F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b"))


_TABLES = (("failures", "failure_id", "evidence_quote"), ("output_calls", "call_id", "full_commentary"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of rows with similarity of at least 0.6 within failures and within output_calls."""
    found = [all_pairs(*near_duplicates(read(spark, sf_dir, t), key, text)).select(F.lit(t).alias("table_name"), "id_a", "id_b") for t, key, text in _TABLES]
    return found[0].unionByName(found[1])


def p6_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in its compact form: each row's class (kind member: id, class) and the similar classes (kind link: class, class)."""
    parts = []
    for t, key, text in _TABLES:
        members, pairs = near_duplicates(read(spark, sf_dir, t), key, text)
        parts.append(members.select(F.lit(t).alias("table_name"), F.lit("member").alias("kind"), F.col("id").alias("x"), F.col("class").alias("y")))
        parts.append(pairs.select(F.lit(t).alias("table_name"), F.lit("link").alias("kind"), F.col("a").alias("x"), F.col("b").alias("y")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


#: The pairs in SQL: all that share a sequence, compared in full.
_SETS = """w AS (SELECT DISTINCT ON ({key}) {key} AS id, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+') AS w FROM {table} WHERE {key} IS NOT NULL AND {text} IS NOT NULL),
g AS (SELECT id, list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM w WHERE len(w) >= 12),
u AS (SELECT id, len(g) AS n, unnest(g) AS x FROM g)
SELECT '{table}' AS table_name, a.id AS id_a, b.id AS id_b FROM u a JOIN u b ON a.x = b.x AND a.id < b.id GROUP BY a.id, b.id, a.n, b.n HAVING count(*) >= 0.6 * (a.n + b.n - count(*))"""
P6_SQL = " UNION ALL ".join(f"SELECT * FROM (WITH {_SETS.format(table=t, key=k, text=x)})" for t, k, x in _TABLES)
