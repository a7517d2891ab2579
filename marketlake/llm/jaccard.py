"""N-gram Jaccard join by T-occurrence search: short inverted lists merged, long ones probed."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    arrow_map, batch, batch_rows, connected_components, counted_buckets, mix, released, stored, word_hashes, words,
)

#: Words of a shingle; similarity in hundredths.
WORDS, PERCENT = 5, 80
#: log2 of the counters that order shingles by frequency; postings of a range of shingles;
#: lists up to this length are paired in full at once; hubs of a longer list; postings of a
#: shingle in one task.
COUNTERS, RANGE, PAIRED, HUBS, HOT = 20, 400_000, 6, 4, 200_000
#: Numbers of 64 bits in a set's parity map; shingles of a block of sets, pairs of two blocks.
MAP, BLOCK, PAIRS = 8, 1 << 20, 1 << 11


def shingle_hashes(texts: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles (repeats included) and each text's offsets among them.

    Texts of fewer words are one shingle, texts without words none.
    """
    flat, offsets = words(texts)
    h = word_hashes(flat)
    n = np.diff(offsets)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    ends = np.r_[0, np.cumsum(count)]
    first = np.repeat(offsets[:-1] - ends[:-1], count) + np.arange(ends[-1])
    length = np.repeat(np.minimum(n, size), count)
    out = length.astype(np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            word = h[np.minimum(first + k, max(len(h) - 1, 0))] if len(h) else np.zeros(0, np.uint64)
            out = np.where(length > k, mix(out + word, k), out)
    return out, ends


def shingle_sets(texts: pa.Array, size: int = WORDS) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, ascending."""
    h, ends = shingle_hashes(texts, size)
    return [np.unique(h[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def signature(s: np.ndarray, renamed: frozenset[int] = frozenset()) -> tuple[int, int]:
    """Two 64-bit numbers that stand for a set; the first is made of the second where it is in `renamed`."""
    one, two = (int(mix(mix(s, k).sum(dtype=np.uint64) + np.uint64(len(s)), k).astype(np.int64)) for k in (11, 12))
    return (int(mix(np.array([two]), 14).astype(np.int64)[0]) if one in renamed else one), two


def parity_map(s: np.ndarray) -> np.ndarray:
    """64 * MAP bits: whether a set has an odd number of shingles in each of as many buckets.

    The maps of two sets differ in no more bits than the sets differ in shingles.
    """
    odd = np.bincount((mix(s, 13) % np.uint64(64 * MAP)).astype(np.int64), minlength=64 * MAP) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _least_overlap(n: np.ndarray | int, percent: int):
    """ceil(n * percent / 100): what a set shares at least with any partner."""
    return -(-n * percent // 100)


def _postings(counts: np.ndarray, ranges: int, percent: int, size: int, renamed: frozenset[int]):
    """Batches of (doc_id, text) to document rows and packed postings of their short lists.

    Document rows only pass through the shuffle, so they are dealt by id and place in the batch:
    neither copies of a text nor rows of one id meet in one task.
    """
    bits = np.uint64(64 - COUNTERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, total = [], 0
        for b in batches:
            rows = []
            for s in shingle_sets(b.column("text"), size):
                one, two = signature(s, renamed)
                rows.append((len(s), one, two, parity_map(s)))
                if len(s) and one not in seen:
                    seen.add(one)
                    # rare shingles first: their lists are the short ones
                    short = len(s) - _least_overlap(len(s), percent) + 1
                    df = np.minimum(counts[(s >> bits).astype(np.int64)], (1 << 24) - 1).astype(np.uint64)
                    key = (df << np.uint64(40)) | (mix(s, 3) >> np.uint64(24))
                    at = np.argpartition(key, short - 1)[:short] if short < len(s) else np.arange(len(s))
                    at = at[np.argsort(key[at])]
                    held.append((one, len(s), s[at], df[at]))
                    total += short
            n, one, two, maps = (np.array(x, np.int64) for x in zip(*rows, strict=True))
            own = {name: maps[:, k] for k, name in enumerate(_MAPS)}
            deal = mix(b.column("doc_id").to_numpy().astype(np.uint64) + mix(np.arange(len(n)), 5), 5)
            yield _rows("doc", len(n), key=(deal >> np.uint64(1)).astype(np.int64), doc_id=b.column("doc_id"), n=n, one=one, two=two, **own)
            if total > RANGE:
                yield _packed(held, ranges)
                seen, held, total = set(), [], 0
        if held:
            yield _packed(held, ranges)

    return run


_MAPS = [f"m{k}" for k in range(MAP)]
_NUMBERS = ["key", "salt", "doc_id", "n", "one", "two", *_MAPS]
_FIELDS = {"kind": pa.string(), **{n: pa.int64() for n in _NUMBERS}, "data": pa.binary()}
_SCHEMA = f"kind string, {', '.join(f'{n} long' for n in _NUMBERS)}, data binary"
_POSTING = np.dtype([("hash", "<u4"), ("set", "<u4"), ("pos", "<u2")])
_SET = np.dtype([("one", "<i8"), ("n", "<u4")])


def _rows(kind: str, count: int, **columns) -> pa.RecordBatch:
    full = [
        pa.array([kind] * count) if name == "kind"
        else (c if isinstance(c, pa.Array) else pa.array(c, t)) if (c := columns.get(name)) is not None
        else pa.nulls(count, t)
        for name, t in _FIELDS.items()
    ]
    return pa.RecordBatch.from_arrays(full, list(_FIELDS))


def _packed(held: list, ranges: int) -> pa.RecordBatch:
    """Postings by range of shingle hashes; lists that may be huge are dealt by set as well."""
    size = np.array([len(s) for _, _, s, _ in held])
    sets = np.array([(one, n) for one, n, _, _ in held], _SET)
    shingle = np.concatenate([s for _, _, s, _ in held])
    df = np.concatenate([d for *_, d in held]).astype(np.int64)
    of = np.repeat(np.arange(len(held)), size)
    pos = np.minimum(np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size), 65535)
    scrambled = mix(shingle, 4)
    part = (scrambled % np.uint64(ranges)).astype(np.int64)
    parts = df // HOT + 1
    salt = np.where(parts > 1, 1 + (mix(sets["one"][of], 6) % parts.astype(np.uint64)).astype(np.int64), 0)
    order = np.lexsort((salt, part))
    cut = np.flatnonzero((np.diff(part[order]) != 0) | (np.diff(salt[order]) != 0)) + 1
    key, salts, data = [], [], []
    for at in np.split(order, cut):
        own, index = np.unique(of[at], return_inverse=True)
        p = np.zeros(len(at), _POSTING)
        p["hash"], p["set"], p["pos"] = scrambled[at] >> np.uint64(32), index, pos[at]
        key.append(part[at[0]])
        salts.append(salt[at[0]])
        data.append(np.int64(len(own)).tobytes() + sets[own].tobytes() + p.tobytes())
    return _rows("postings", len(key), key=np.array(key), salt=np.array(salts), data=pa.array(data, pa.binary()))


def _possible(a, b, percent: int) -> np.ndarray:
    """Whether two postings of one list can belong to a link whose first common shingle this is."""
    na, nb = a["n"].astype(np.int64), b["n"].astype(np.int64)
    shared = 1 + np.minimum(na - a["pos"], nb - b["pos"]) - 1
    return (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & ((100 + percent) * shared >= percent * (na + nb))


_ENTRY = np.dtype([("hash", "<u4"), ("one", "<i8"), ("rank", "<u8"), ("n", "<i8"), ("pos", "<i8")])


def _merged(percent: int):
    """Merges the lists of each range: pairs of short lists and hubs, entries of longer lists.

    Rows out: kind "pair" (one, two: the sets), kind "list" (key: the list, one, n, doc_id: the position).
    Document rows pass through.
    """

    def lists(key: int, salt: int, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        found = []
        for data in blobs:
            sets = np.frombuffer(data, _SET, int(np.frombuffer(data, np.int64, 1)[0]), 8)
            p = np.frombuffer(data, _POSTING, -1, 8 + sets.nbytes)
            e = np.zeros(len(p), _ENTRY)
            e["hash"], e["one"], e["n"], e["pos"] = p["hash"], sets["one"][p["set"]], sets["n"][p["set"]], p["pos"]
            found.append(e)
        e = np.concatenate(found)
        e = e[np.argsort(e["hash"], kind="stable")]
        start = np.flatnonzero(np.r_[True, e["hash"][1:] != e["hash"][:-1]])
        count = np.diff(np.r_[start, len(e)])
        e = e[np.repeat((count > 1) | (salt > 0), count)]  # lists of one document link nothing
        if not len(e):
            return
        e["rank"] = mix(e["one"], 7)
        e = e[np.lexsort((e["rank"], e["hash"]))]
        e = e[np.r_[True, (e["hash"][1:] != e["hash"][:-1]) | (e["one"][1:] != e["one"][:-1])]]  # a set from several blocks
        start = np.flatnonzero(np.r_[True, e["hash"][1:] != e["hash"][:-1]])
        count = np.diff(np.r_[start, len(e)])
        left, right = [], []
        for k in range(2, PAIRED + 1):
            at = start[count == k]
            for i, j in zip(*np.triu_indices(k, 1), strict=True):
                left.append(at + i)
                right.append(at + j)
        long = count > PAIRED  # every set against the hubs, the sets of least rank
        begin = np.repeat(start, count)
        for k in range(HUBS):
            member = np.flatnonzero(np.repeat(long, count) & (np.arange(len(e)) - begin > k))
            left.append(begin[member] + k)
            right.append(member)
        a, b = np.concatenate(left), np.concatenate(right)
        good = _possible(e[a], e[b], percent)
        pairs = np.unique(np.stack([e["one"][a[good]], e["one"][b[good]]], axis=1), axis=0)
        if len(pairs):
            yield _rows("pair", len(pairs), one=pairs[:, 0], two=pairs[:, 1])
        kept = e[np.repeat(long | (salt > 0), count)]
        if len(kept):
            yield _rows("list", len(kept), key=kept["hash"].astype(np.int64) << 24 | key, one=kept["one"], n=kept["n"], doc_id=kept["pos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs = None, []
        for b in batches:
            docs = b.filter(pc.equal(b.column("kind"), "doc"))
            if docs.num_rows:
                yield docs
            b = b.filter(pc.equal(b.column("kind"), "postings"))
            for key, salt, data in zip(b.column("key").to_pylist(), b.column("salt").to_pylist(), b.column("data"), strict=True):
                if now != (key, salt):
                    if blobs:
                        yield from lists(*now, blobs)
                    now, blobs = (key, salt), []
                blobs.append(data.as_py())
        if blobs:
            yield from lists(*now, blobs)

    return run


def _placed(pairs: DataFrame) -> DataFrame:
    """(c, i, j, a, b): the group in which each pair (a, b, na, nb) is compared.

    A group is a component of the pairs' graph, so a set moves once for all its pairs.  The
    sets of a component with more than BLOCK shingles or PAIRS pairs are dealt over blocks by
    hash, and its pairs are grouped by their two blocks: no group holds much more than two
    blocks of sets, or about twice PAIRS pairs where they are spread evenly.
    """
    nodes = pairs.select(F.col("a").alias("node"), F.col("na").alias("n"), F.lit(1).alias("p")).union(pairs.select("b", "nb", F.lit(0)))
    nodes = nodes.groupBy("node").agg(F.max("n").alias("n"), F.sum("p").alias("p"))
    nodes = connected_components(pairs).join(nodes, "node")
    least = F.greatest(F.sum("n") / BLOCK, F.sqrt(F.sum("p") / PAIRS))
    blocks = nodes.groupBy("component").agg(F.ceil(least).alias("blocks"))
    nodes = nodes.join(blocks, "component").select("node", "component", F.pmod(F.xxhash64("node"), "blocks").alias("block"))
    nodes = stored(nodes, "blocks")
    placed = pairs.join(nodes.toDF("a", "c", "i"), "a").join(nodes.drop("component").toDF("b", "j"), "b")
    return stored(placed.select("c", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "a", "b"), "placed")


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int, size: int, renamed: frozenset[int]) -> DataFrame:
    """The pairs (a, b) of sets that reach the similarity.

    Only documents that stand for a set of some pair are shingled again; summaries of
    bounded size tell them from the others, so no text is shuffled.  The lists a pair was
    not merged from are probed by binary search: a document is in a shingle's list if its
    own sorted set holds the shingle.  Sets go to the groups of their pairs, once to each.
    """
    spark = docs.sparkSession
    first = classes.select(F.col("one").alias("a"), F.col("n").alias("na"), *[F.col(m).alias(f"a{m}") for m in _MAPS])
    second = classes.select(F.col("one").alias("b"), F.col("n").alias("nb"), *[F.col(m).alias(f"b{m}") for m in _MAPS])
    both = F.col("na") + F.col("nb")
    differ = reduce(add, [F.bit_count(F.col(f"a{m}").bitwiseXOR(F.col(f"b{m}"))) for m in _MAPS])
    # |union| - |intersection| is at least the bits that differ
    near = (100 + percent) * (both - differ) >= 2 * percent * both
    pairs = stored(pairs.join(first, "a").join(second, "b").where(near).select("a", "b", "na", "nb"), "near")
    if pairs.isEmpty():
        return pairs.select("a", "b")
    placed = _placed(pairs)
    asked = stored(placed.select("c", "i", "j", F.col("a").alias("one")).union(placed.select("c", "i", "j", "b")).distinct(), "asked")
    needed = stored(asked.select("one").distinct().join(classes.select("one", "rep"), "one"), "needed")
    count = needed.count()
    bits = min(22, max(16, count.bit_length() + 5))
    batch_rows(spark, 10_000)

    def by_id(b: pa.RecordBatch, name: str) -> np.ndarray:
        return mix(b.column(name).to_numpy().astype(np.uint64), 21)

    def by_both(ids: np.ndarray, ones: np.ndarray) -> np.ndarray:
        return mix(ids ^ ones.astype(np.uint64), 22)

    few = needed.select("rep", "one").repartition(max(1, -(-count // 500_000)))
    ids = counted_buckets(few, lambda b: by_id(b, "rep"), bits) > 0
    both = counted_buckets(few, lambda b: by_both(by_id(b, "rep"), b.column("one").to_numpy()), bits) > 0
    wanted = spark.sparkContext.broadcast((ids, both))  # 2^bits flags each

    def sets(b: pa.RecordBatch) -> pa.RecordBatch | None:
        ids, both = wanted.value
        shift = np.uint64(64 - bits)
        b = b.filter(pa.array(ids[(by_id(b, "doc_id") >> shift).astype(np.int64)]))
        if not b.num_rows:
            return None
        found = shingle_sets(b.column("text"), size)
        ones = np.array([signature(s, renamed)[0] for s in found], np.int64)
        keep = np.flatnonzero(both[(by_both(by_id(b, "doc_id"), ones) >> shift).astype(np.int64)])
        return batch(one=ones[keep], data=pa.array([found[k].tobytes() for k in keep], pa.binary()))

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}  # the sets of a group come before its pairs; a set may come twice
        for b in batches:
            links = []
            groups = zip(*(b.column(c).to_pylist() for c in ("c", "i", "j")), strict=True)
            for group, one, two, data in zip(groups, b.column("one").to_pylist(), b.column("two").to_pylist(), b.column("data"), strict=True):
                if group != now:
                    now, held = group, {}
                if two is None:
                    held[one] = np.frombuffer(data.as_py(), np.uint64)
                    continue
                x, y = sorted((held[one], held[two]), key=len)
                at = np.searchsorted(y, x)
                shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    links.append((one, two))
            if links:
                a, b = np.array(links, np.int64).T
                yield batch(a=a, b=b)

    batch_rows(spark, 256)
    moved = arrow_map(docs, sets, "one long, data binary").join(asked, "one")
    moved = moved.select("c", "i", "j", "one", F.lit(None).cast("long").alias("two"), "data")
    moved = moved.union(placed.select("c", "i", "j", "a", "b", F.lit(None).cast("binary")))
    moved = moved.repartition("c", "i", "j").sortWithinPartitions("c", "i", "j", F.asc_nulls_first("two"))
    return stored(moved.mapInArrow(released(probed), "a long, b long"), "links")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of (doc_id, text).

    A document's set is its distinct shingles of `size` lower-cased (A-Z) words; two
    documents link when 100 * |intersection| >= percent * |union|.  Texts of fewer words
    are one shingle; null and empty texts have none and link with nothing.  Repeated rows
    each give a row; a row without doc_id links with nothing and its component is null.
    An empty table gives no rows; other columns are ignored.

    T-occurrence search: a partner of a set of n shingles is in at least T = ceil(percent n / 100)
    of its n inverted lists, so it is in one of the n - T + 1 shortest.  Only those are
    built, by a shuffle of packed postings; the longer lists are probed for candidates
    alone.  Lengths are estimated by counters over all documents, and any error in them
    costs time but no link.  Equal sets are one class, named by a 64-bit number; where
    different sets get one name, the first pass runs again with other names for them.  In a list of many classes each is
    first compared with a few hubs; afterwards only classes still in different components
    are paired, and only where sizes, places in the list and parity maps allow a link, so
    a group of near copies never makes all its pairs.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    real = docs.where("doc_id is not null")
    batch_rows(spark, 256)
    counts = counted_buckets(real.select("text"), lambda b: shingle_hashes(b.column("text"), size)[0], COUNTERS)
    ranges = max(1, int(counts.sum()) * (100 - percent) // 100 // RANGE + 1)
    shared = spark.sparkContext.broadcast(np.minimum(counts, 2**31 - 1).astype(np.int32))
    renamed: frozenset[int] = frozenset()
    while True:

        def postings(batches, renamed=renamed):
            yield from _postings(shared.value, ranges, percent, size, renamed)(batches)

        packed = real.mapInArrow(released(postings), _SCHEMA).repartition("kind", "key", "salt").sortWithinPartitions("kind", "key", "salt")
        made = stored(packed.mapInArrow(released(_merged(percent)), _SCHEMA), "merged")
        rows = made.where("kind = 'doc'").select("doc_id", "n", "one", "two", *_MAPS)
        classes = rows.where("n > 0").groupBy("one").agg(
            F.min("doc_id").alias("rep"), F.min("two").alias("least"), F.max("two").alias("most"), F.max("n").alias("n"),
            *[F.min(m).alias(m) for m in _MAPS],
        )
        classes = stored(classes, "classes")
        # different sets with one first number, about N^2 / 2^65: their next names come of the second
        clashes = {r["one"] for r in classes.where("least <> most").select("one").toLocalIterator()}
        if not clashes:
            break
        renamed |= clashes
    pairs = made.where("kind = 'pair'").select(F.col("one").alias("a"), F.col("two").alias("b")).distinct()
    pairs = stored(pairs, "pairs")
    links = _verified(real, classes, pairs, percent, size, renamed)
    components = stored(connected_components(links), "components")

    # classes that share a longer list and are still apart
    entries = made.where("kind = 'list'").select("key", "one", "n", F.col("doc_id").alias("pos"))
    entries = entries.join(components.withColumnRenamed("node", "one"), "one", "left")
    entries = entries.withColumn("component", F.coalesce("component", "one"))
    mixed = entries.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1")
    entries = stored(entries.join(mixed.select("key"), "key"), "mixed")
    if not entries.isEmpty():
        sizes = entries.groupBy("key", "component").agg(F.count("*").alias("m"))
        largest = sizes.groupBy("key").agg(F.max(F.struct("m", "component"))["component"].alias("largest"))
        entries = entries.join(classes.select("one", *_MAPS), "one").join(largest, "key")
        entries = stored(entries.withColumn("outside", F.col("component") != F.col("largest")).drop("largest"), "entries")
        a, b = entries.where("outside").alias("p"), entries.alias("q")
        # a pair of two components outside the largest is met once
        apart = F.when(F.col("q.outside"), F.col("p.component") < F.col("q.component")).otherwise(F.lit(True))
        n, m = F.col("p.n"), F.col("q.n")
        shared_at_most = F.least(n - F.col("p.pos"), m - F.col("q.pos"))
        differ = reduce(add, [F.bit_count(F.col(f"p.{k}").bitwiseXOR(F.col(f"q.{k}"))) for k in _MAPS])
        possible = (
            (100 * F.least(n, m) >= percent * F.greatest(n, m))
            & ((100 + percent) * shared_at_most >= percent * (n + m))
            # |union| - |intersection| is at least the bits that differ
            & ((100 + percent) * (n + m - differ) >= 2 * percent * (n + m))
        )
        more = a.join(b, (F.col("p.key") == F.col("q.key")) & apart & possible)
        more = more.select(F.col("p.one").alias("a"), F.col("q.one").alias("b")).distinct()
        tested = pairs.union(pairs.select("b", "a"))
        more = stored(more.join(tested, ["a", "b"], "left_anti"), "pairs")
        links = links.union(_verified(real, classes, more, percent, size, renamed))
        components = stored(connected_components(links), "components")
    found = classes.join(components.withColumnRenamed("node", "one"), "one", "left")
    found = found.select("one", "rep", F.coalesce("component", "one").alias("component"))
    least = found.groupBy("component").agg(F.min("rep").alias("component_id"))
    found = found.join(least, "component").select("one", "component_id")
    out = rows.join(found, "one", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )

    def lengths(b: pa.RecordBatch) -> pa.RecordBatch:
        return batch(n=np.array([len(s) for s in shingle_sets(b.column("text"), size)], np.int64))

    nameless = arrow_map(docs.where("doc_id is null").select("text"), lengths, "n long")
    return out.union(nameless.select(F.lit(None).cast("long"), "n", F.lit(None).cast("long")))
