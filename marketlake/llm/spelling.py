"""Groups of spelling variants: generated edits, blocked Bloom filters by length, an exact join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, batch, batch_rows, drop_stored, mix, stored

#: Letters of a run: ASCII letters and the Latin-1 range from A with grave to y with diaeresis.
LETTERS = r"[A-Za-zÀ-ÿ]+"
#: Bits a word, bits set by a word, bytes of all filters at most, blocks of a built piece.
BITS, PROBES, FILTER_BYTES, PIECE = 16, 7, 1 << 25, 1024
#: Words of this many code points and more share one filter.
LONG = 64
#: Edits hashed at a time.
STEP = 1 << 20


def word_counts(docs: DataFrame, least_length: int = 6, least_count: int = 5, drop_every: int = 199) -> DataFrame:
    """(word, n): the distinct spellings in whole texts, and how often each occurs.

    A run of letters is lower-cased (A-Z only).  Where the checksum of `<doc_id>:<run>` is a
    multiple of `drop_every`, the run's code point at checksum modulo length is left out, which
    plants misspellings.  A row without doc_id has no checksum, so its runs stay as they are.
    Null and empty texts have no runs; repeated rows count each time; other columns are ignored.

    Counts are combined before the shuffle, so a word that holds a third of all runs sends one
    row a task.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"({LETTERS})"), F.lit(1))).alias("run"))
    runs = runs.where(F.length("run") >= least_length).withColumn("run", F.translate("run", upper, lower))
    runs = runs.withColumn("h", F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "run").cast("binary")))
    at = "cast(h % length(run) as int)"
    words = runs.select(
        F.expr(f"if(coalesce(h % {drop_every} = 0, false), concat(substr(run, 1, {at}), substr(run, {at} + 2)), run)").alias("word")
    )
    counts = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least_count)


def _by_length(words: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, code points as a matrix) of the words of each length."""
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        text = "".join(words.take(pa.array(at)).to_pylist())
        yield int(n), at, np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(at), int(n))


def _term(chars: np.ndarray, place: np.ndarray | int) -> np.ndarray:
    """A word's hash is the scrambled sum of one such number for each place and its character."""
    return mix(chars.astype(np.uint64) | (np.asarray(place).astype(np.uint64) << np.uint64(21)), 3)


def _hash(chars: np.ndarray) -> np.ndarray:
    return mix(_term(chars, np.arange(chars.shape[1])).sum(1, dtype=np.uint64), 5)


def _places(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The 512-bit block of each hash, and the number its bits come from."""
    return ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64), mix(h, 7)


def _bit(g: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    nine = g >> np.uint64(9 * k)
    return (nine >> np.uint64(6) & np.uint64(7)).astype(np.int64), np.uint64(1) << (nine & np.uint64(63))


def _maybe(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Indices of the hashes that the filter doesn't exclude; each probe looks at survivors only."""
    block, g = _places(h, len(bits))
    live = np.arange(len(h))
    for k in range(PROBES):
        word, mask = _bit(g, k)
        ok = (bits[block, word] & mask) != 0
        live, block, g = live[ok], block[ok], g[ok]
    return live


def bloom_filters(words: DataFrame, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    """A blocked Bloom filter for the words of each length; `sizes` are its blocks.

    Pieces of the filters are filled by tasks and only they reach the driver: FILTER_BYTES and
    a block for each length at most.
    """

    def keyed(b: pa.RecordBatch) -> pa.RecordBatch:
        shard, block, bits = (np.zeros(b.num_rows, t) for t in (np.int32, np.int64, np.uint64))
        for n, at, chars in _by_length(b.column("word")):
            shard[at] = min(n, LONG)
            block[at], bits[at] = _places(_hash(chars), sizes[min(n, LONG)])
        return batch(shard=shard, piece=(block // PIECE).astype(np.int32), block=(block % PIECE).astype(np.int32), bits=bits.astype(np.int64))

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            shard, piece, block, g = (np.asarray(c) for c in b.columns)
            for s, p in np.unique(np.column_stack([shard, piece]), axis=0):
                here = (shard == s) & (piece == p)
                rows = made.setdefault((int(s), int(p)), np.zeros((PIECE, 8), np.uint64))
                for k in range(PROBES):
                    word, mask = _bit(g[here].astype(np.uint64), k)
                    np.bitwise_or.at(rows, (block[here], word), mask)
        for (s, p), rows in made.items():
            yield batch(shard=pa.array([s], pa.int32()), piece=pa.array([p], pa.int32()), bits=pa.array([rows.tobytes()], pa.binary()))

    spread = arrow_map(words.select("word"), keyed, "shard int, piece int, block int, bits long").repartition("shard", "piece")
    out = {s: np.zeros((-(-n // PIECE) * PIECE, 8), np.uint64) for s, n in sizes.items()}
    for r in spread.mapInArrow(filled, "shard int, piece int, bits binary").toLocalIterator():
        out[r["shard"]][r["piece"] * PIECE : (r["piece"] + 1) * PIECE] = np.frombuffer(r["bits"], np.uint64).reshape(-1, 8)
    return {s: out[s][:n] for s, n in sizes.items()}


def _texts(chars: np.ndarray) -> list[str]:
    text, n = chars.astype("<u4").tobytes().decode("utf-32-le"), chars.shape[1]
    return [text[i * n : (i + 1) * n] for i in range(len(chars))]


def _replaced(chars: np.ndarray, alphabet: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(row, word) for each replacement by a greater character that the filter lets through."""
    n = chars.shape[1]
    terms = _term(chars, np.arange(n))
    total = terms.sum(1, dtype=np.uint64)
    wide = max(1, STEP // max(1, len(alphabet)))  # places of a word done together
    tall = max(1, wide // max(1, min(n, wide)))
    for r in range(0, len(chars), tall):
        for p in range(0, n, wide):
            here, places = chars[r : r + tall, p : p + wide], np.arange(p, min(n, p + wide))
            new = _term(alphabet[None, :], places[:, None])
            row, place, letter = np.nonzero(alphabet[None, None, :] > here[:, :, None])
            h = mix(total[r + row] - terms[r + row, p + place] + new[place, letter], 5)
            live = _maybe(h, bits)
            if len(live):
                edited = chars[r + row[live]]
                edited[np.arange(len(live)), p + place[live]] = alphabet[letter[live]]
                yield r + row[live], _texts(edited)


def _deleted(chars: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(row, word) for each deletion, once among equal neighbours, that the filter lets through."""
    n = chars.shape[1]
    if n == 0:
        return
    kept, moved = _term(chars, np.arange(n)), _term(chars[:, 1:], np.arange(n - 1))
    zero = np.zeros((len(chars), 1), np.uint64)
    before = np.concatenate([zero, np.cumsum(kept[:, :-1], axis=1, dtype=np.uint64)], axis=1)
    after = np.concatenate([np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1], zero], axis=1)
    row, place = np.nonzero(np.concatenate([np.ones((len(chars), 1), bool), chars[:, 1:] != chars[:, :-1]], axis=1))
    live = _maybe(mix(before[row, place] + after[row, place], 5), bits)
    for at in range(0, len(live), max(1, STEP // n)):
        rows, places = row[live[at : at + max(1, STEP // n)]], place[live[at : at + max(1, STEP // n)]]
        keep = np.arange(n)[None, :] != places[:, None]
        yield rows, _texts(chars[rows][keep].reshape(len(rows), n - 1))


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n) for all words that one inserted, deleted or replaced code point tells apart.

    The filters of all words, one for each length, are broadcast: at most FILTER_BYTES and a
    block a length, whatever the vocabulary (above that they let more through, and the join
    sorts it out).  Each word probes its deletions, and its replacements by greater
    characters; only what the filters let through is written out and meets the vocabulary in
    an exact join.  The other half of the edits, insertions and replacements by smaller
    characters, are these pairs seen from the other word, so each pair is probed once and
    returned both ways.  The alphabet is every character of the vocabulary.
    """
    spark = vocabulary.sparkSession
    length = F.least(F.length("word"), F.lit(LONG))
    counts = {r["shard"]: r["count"] for r in vocabulary.groupBy(length.alias("shard")).count().collect()}
    if not counts:
        return spark.createDataFrame([], "word string, n long, near string, near_n long")
    letters = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct()
    alphabet = np.array(sorted(ord(r["c"]) for r in letters.collect()), np.uint32)  # at most all code points
    blocks = {s: -(-n * BITS // 512) for s, n in counts.items()}
    share = min(1.0, FILTER_BYTES / 64 / sum(blocks.values()))
    batch_rows(spark, 4096)
    shared = spark.sparkContext.broadcast((alphabet, bloom_filters(vocabulary, {s: max(1, int(b * share)) for s, b in blocks.items()})))

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet, filters = shared.value
        for b in batches:
            for n, at, chars in _by_length(b.column("word")):
                words, counts = b.column("word"), np.asarray(b.column("n"))
                edits = [_replaced(chars, alphabet, filters[min(n, LONG)])]
                if min(n - 1, LONG) in filters:
                    edits.append(_deleted(chars, filters[min(n - 1, LONG)]))
                for some in edits:
                    for rows, texts in some:
                        yield batch(word=words.take(pa.array(at[rows])), n=counts[at[rows]], near=pa.array(texts, pa.string()))

    positives = vocabulary.select("word", "n").mapInArrow(probed, "word string, n long, near string")
    known = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = stored(positives.join(known, "near").select("word", "n", "near", "near_n"), "pairs")
    return pairs.union(pairs.select("near", "near_n", "word", "n"))


def variant_groups(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of (word, n); words are distinct and not null.

    form: the near word of largest n (ties: the smallest in code-point order) if that is at
    least `ratio` times the word's n, else null.  root: the last word on the way of forms, the
    word itself if it has none.  Counts grow along the way, so it has no cycles; the ways are
    halved by self-joins, a logarithmic number of rounds.  An empty table gives no rows, the
    empty word is near every word of one code point.
    """
    vocabulary = stored(words.select("word", F.col("n").cast("long")), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near")))
    near = near_pairs(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = vocabulary.join(near, "word", "left")
    formed = -F.col("best.m") >= ratio * F.col("n")
    found = found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.m")).alias("form_n"),
    )
    found = stored(found, "forms")
    ways = stored(found.where("form is not null").select("word", F.col("form").alias("root")), "ways")
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(ways.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "ways")
        drop_stored(ways)
        ways = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return found.join(ways, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
