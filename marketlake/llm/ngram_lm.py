"""Language-model scoring: n-gram tries with Elias-Fano levels and quantised counts."""

from __future__ import annotations

import mmap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, batch_rows, drop_stored, mix, stored, word_hashes, words

#: Tokens of a block, n-grams of a shard, discount of a pair's count, share of all tokens
#: from which a context's successors are dealt over all shards.
BLOCK, SHARD, DISCOUNT, HOT = 1_000_000, 1_000_000, 0.75, 0.0005
#: The hash of the end of a text, which is a word of its own.
END = np.uint64(0x0E4D0E4D0E4D0E4D)
_ONE = np.uint64(1)


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different row of the columns, in ascending order, and every row's rank among these.

    Sorting plain numbers is several times faster than sorting places by them, so a row's key
    carries its place in the low bits.  Where 64 bits don't hold both, a column's ranks stand
    for its numbers, and places are sorted as a last resort.
    """
    n = len(columns[0])
    place, rank, many = np.zeros(0, np.int64), np.zeros(n, np.int64), 1
    low = np.uint64(max(0, n - 1).bit_length())
    columns = [c.astype(np.uint64) for c in columns]
    for k, column in enumerate(columns):
        bits = int(column.max(initial=0)).bit_length()
        if k and (many - 1).bit_length() + bits + int(low) > 64:
            column = _distinct(column)[1].astype(np.uint64)
            bits = int(column.max(initial=0)).bit_length()
        key = (rank.astype(np.uint64) << np.uint64(bits)) | column if k else column
        if (many - 1).bit_length() + bits + int(low) <= 64:
            packed = (key << low) | np.arange(n, dtype=np.uint64)
            packed.sort()
            order, key = (packed & ((_ONE << low) - _ONE)).astype(np.int64), packed >> low
        else:
            order = np.argsort(key)
            key = key[order]
        new = np.ones(n, bool)
        np.not_equal(key[1:], key[:-1], out=new[1:])
        place = order[new]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        many = max(1, len(place))
    return place, rank


def _different(x: np.ndarray) -> np.ndarray:
    """The different numbers in ascending order."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def _located(held: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The place of each number in an ascending sequence that isn't empty, -1 where it isn't there."""
    if int(held[-1]) < 8 * (len(held) + len(x)):  # a table is no larger than a few such arrays
        table = np.full(int(held[-1]) + 2, -1, np.int32)
        table[held.astype(np.int64)] = np.arange(len(held), dtype=np.int32)
        return table[np.minimum(x, held[-1] + _ONE).astype(np.int64)].astype(np.int64)
    back = slice(None)
    if (x[1:] < x[:-1]).any():  # a search in order stays in the cache
        at, back = _distinct(x)
        x = x[at]
    at = np.minimum(np.searchsorted(held, x), len(held) - 1)
    return np.where(held[at] == x, at, -1)[back]


def _among(x: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Whether each hash is one of a few: most are told by their low bits alone."""
    low = np.uint64((1 << 16) - 1)
    table = np.zeros(1 << 16, bool)
    table[(few & low).astype(np.int64)] = True
    out = table[(x & low).astype(np.int64)]
    at = np.flatnonzero(out)
    out[at] = np.isin(x[at], few)
    return out


def _parted(shard: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places) of each shard that has any, both ascending."""
    order = np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")
    many = np.bincount(shard, minlength=1)
    own = np.flatnonzero(many)
    return zip(own.tolist(), np.split(order, np.cumsum(many[own])[:-1]) if len(own) else [], strict=True)


class EliasFano:
    """A monotone sequence: low bits packed, high parts in unary; arrays may be mapped memory."""

    def __init__(self, head: np.ndarray, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.l = int(head[0]), int(head[1])
        self.head, self.low, self.high, self.ones = head, low, high, ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones
        # any byte may begin a number: read eight bytes from each
        self.window = np.lib.stride_tricks.as_strided(low.view(np.uint64)[:1], (max(1, low.nbytes - 7),), (1,))

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        l = max(0, int(universe // max(1, n)).bit_length() - 1)
        values, at = values.astype(np.uint64), np.arange(l, dtype=np.uint64)
        low = [np.zeros(0, np.uint8)]
        for i in range(0, n, 1 << 14):  # whole bytes at a time
            low.append(np.packbits(((values[i : i + (1 << 14), None] >> at) & _ONE).astype(np.uint8).ravel(), bitorder="little"))
        low = np.concatenate(low)
        low = np.concatenate([low, np.zeros(16 + -len(low) % 8, np.uint8)])
        places = (values >> np.uint64(l)).astype(np.int64) + np.arange(n)
        size = (int(universe) >> l) + n + 2
        high = np.zeros(-(-size // 64) * 64, np.uint8)
        high[places] = 1
        high = np.packbits(high, bitorder="little").view(np.uint64)
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high).astype(np.int64))))
        return cls(np.array([n, l], np.int64), low, high, ones)

    def parts(self) -> list[np.ndarray]:
        return [self.head, self.low, self.high, self.ones]

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """The place of the k-th (from 0) one or zero of the high bits."""
        total = self.ones if ones else self.zeros
        at = np.searchsorted(total, k, "right") - 1
        rest = k - total[at]
        bits = self.high[at] if ones else ~self.high[at]
        place = np.zeros(len(k), np.int64)
        for width in (32, 16, 8, 4, 2, 1):  # halve the word that holds the wanted bit
            count = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            right = rest >= count
            rest = np.where(right, rest - count, rest)
            bits = np.where(right, bits >> np.uint64(width), bits)
            place += np.where(right, width, 0)
        return at * 64 + place

    def _lows(self, i: np.ndarray) -> np.ndarray:
        at = i * self.l
        return (self.window[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.l) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        high = (self._select(i, True) - i).astype(np.uint64)
        return (high << np.uint64(self.l)) | self._lows(i)

    def all(self) -> np.ndarray:
        """The whole sequence, read in order."""
        i = np.arange(self.n)
        high = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little").view(bool)) - i
        return (high.astype(np.uint64) << np.uint64(self.l)) | self._lows(i)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The place of each value, -1 where it isn't there: successor search by high part, then low bits."""
        values = values.astype(np.uint64)
        if not self.n:
            return np.full(len(values), -1)
        high = (values >> np.uint64(self.l)).astype(np.int64)
        want = values & np.uint64((1 << self.l) - 1)
        known = high < int(self.zeros[-1])  # beyond the last high part nothing can be
        high = np.where(known, high, 0)
        begin = np.where(high > 0, self._select(np.maximum(high - 1, 0), False) + 1 - high, 0)
        end = self._select(high, False) - high
        last = end.copy()
        while (live := np.flatnonzero(begin < end)).size:
            middle = (begin[live] + end[live]) >> 1
            less = self._lows(middle) < want[live]
            begin[live] = np.where(less, middle + 1, begin[live])
            end[live] = np.where(less, end[live], middle)
        there = known & (begin < last)
        there[there] = self._lows(begin[there]) == want[there]
        return np.where(there, begin, -1)


#: Codes of counts: exact to 4096, then in steps of 1/500, far beyond any count.
CODES = np.concatenate([np.arange(4097.0), 4096 * 1.002 ** np.arange(1, 20_000)])


class Trie:
    """The n-grams of a shard: levels of contexts over its words, and under each context its successors.

    Word numbers are replaced by their places among the shard's words.  Every level is one
    monotone sequence: a word is stored relative to the n-gram before it, as that n-gram's
    place * words + word place.  Pointers (monotone) give each context its range of
    successors, and two bytes a successor code its count: exact to 4096, on a log scale
    beyond.
    """

    def __init__(self, vocabulary: EliasFano, contexts: list[EliasFano], pointers: EliasFano, successors: EliasFano, codes: np.ndarray):
        self.vocabulary, self.contexts, self.pointers, self.successors, self.codes = vocabulary, contexts, pointers, successors, codes

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, count: np.ndarray) -> Trie:
        """From distinct n-grams in ascending order: numbers of the context's words (one row a word), successor, count."""
        columns = [*np.atleast_2d(context), word]
        vocabulary = _different(np.concatenate(columns).astype(np.uint64))
        size, last = max(1, len(vocabulary)), int(vocabulary[-1]) + 1 if len(vocabulary) else 1
        at, above, levels = np.zeros(len(word), np.int64), 1, []
        for column in columns:
            key = at * size + (_located(vocabulary, column.astype(np.uint64)) if len(column) else 0)
            new = np.r_[True, key[1:] != key[:-1]][: len(key)]
            start = np.flatnonzero(new)
            levels.append(EliasFano.of(key[start], above * size))
            parents, at, above = at[start], np.cumsum(new) - 1, max(1, len(start))
        many = np.bincount(parents, minlength=levels[-2].n) if len(word) else np.zeros(0, np.int64)
        codes = np.searchsorted(CODES, count * 1.0, "right") - 1
        pointers = EliasFano.of(np.concatenate(([0], np.cumsum(many))), len(word) + 1)
        return cls(EliasFano.of(vocabulary, last), levels[:-1], pointers, levels[-1], codes.astype(np.uint16))

    def to_bytes(self) -> bytes:
        levels = [self.vocabulary, self.pointers, self.successors, *self.contexts]
        parts = [p for level in levels for p in level.parts()] + [self.codes]
        parts = [np.ascontiguousarray(p).view(np.uint8) for p in parts]
        parts = [np.concatenate([p, np.zeros(-len(p) % 8, np.uint8)]) for p in parts]
        sizes = np.array([len(parts), *map(len, parts)], np.int64)
        return b"".join([sizes.tobytes(), *(p.tobytes() for p in parts)])

    @classmethod
    def mapped(cls, data: bytes | mmap.mmap) -> Trie:
        """Read in place: nothing is copied out of the mapped levels."""
        n = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, n, 8)
        ends = np.cumsum(sizes) + sizes.nbytes + 8
        parts = [np.frombuffer(data, np.uint8, n, e - n) for n, e in zip(sizes, ends, strict=True)]
        levels = []
        for k in range(0, n - 1, 4):
            head, low, high, ones = parts[k : k + 4]
            levels.append(EliasFano(head.view(np.int64), low, high.view(np.uint64), ones.view(np.int64)))
        return cls(levels[0], levels[3:], levels[1], levels[2], parts[-1].view(np.uint16))

    def _places(self, context: np.ndarray) -> np.ndarray:
        """The place of each context on the last level of contexts, -1 where it isn't there."""
        at = np.zeros(np.atleast_2d(context).shape[1], np.int64)
        for level, column in zip(self.contexts, np.atleast_2d(context), strict=True):
            at = self._below(level, at, column)
        return at

    def _below(self, level: EliasFano, at: np.ndarray, column: np.ndarray) -> np.ndarray:
        """The successor search: the place on `level` of a word after the n-gram at place `at`."""
        word = _found(self.vocabulary, column)
        known = np.flatnonzero((at >= 0) & (word >= 0))
        out = np.full(len(at), -1)
        out[known] = _found(level, at[known] * max(1, self.vocabulary.n) + word[known])
        return out

    def counts(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The code of each n-gram; 0 where the trie doesn't hold it."""
        return self._codes(self._places(context), word)

    def branching(self, context: np.ndarray) -> np.ndarray:
        """How many successors each context has."""
        return self._widths(self._places(context))

    def answer(self, context: np.ndarray, each: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Successors of each context, and codes of its n-grams: `each` words follow one context."""
        at = self._places(context)
        return self._widths(at), self._codes(np.repeat(at, each), word)

    def _codes(self, at: np.ndarray, word: np.ndarray) -> np.ndarray:
        found = self._below(self.successors, at, word)  # holds the context's place: it can't be another's
        out, known = np.zeros(len(word), np.uint16), np.flatnonzero(found >= 0)
        out[known] = self.codes[found[known]]
        return out

    def _widths(self, at: np.ndarray) -> np.ndarray:
        begin = self.pointers.get(np.arange(self.pointers.n)).astype(np.int64) if len(at) > self.pointers.n else None
        out, known = np.zeros(len(at), np.int64), np.flatnonzero(at >= 0)
        at = at[known]
        if begin is None:
            out[known] = self.pointers.get(at + 1).astype(np.int64) - self.pointers.get(at).astype(np.int64)
        else:
            out[known] = begin[at + 1] - begin[at]
        return out


def _found(level: EliasFano, x: np.ndarray) -> np.ndarray:
    """The place of each number, -1 where it isn't there; for many numbers the level is read once, in order."""
    if not level.n or 8 * len(x) < level.n:
        own, back = np.unique(x, return_inverse=True)
        return level.find(own)[back]
    return _located(level.all(), x.astype(np.uint64))


def _planes(x: np.ndarray, width: int) -> bytes:
    """The low `width` bytes of each number, byte by byte: leading bytes compress well."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _numbers(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel()


def _squeezed(*parts: bytes) -> bytes:
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _opened(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


_BLOCK = "block long, doc_id array<long>, held array<boolean>, size array<int>, tokens binary, words binary, counts binary"


def _blocks(docs: DataFrame) -> DataFrame:
    """Blocks of whole texts: each token's place among the block's words, their hashes and learned counts."""

    def made(held: list, seq: int) -> pa.RecordBatch:
        ids = pa.concat_arrays([h[0] for h in held])
        out = np.concatenate([h[1] for h in held])
        flat, n = pa.concat_arrays([h[2] for h in held]), np.concatenate([h[3] for h in held])
        coded = flat.dictionary_encode()
        token = coded.indices.to_numpy().astype(np.int64)
        hashes = np.append(word_hashes(coded.dictionary), END)
        ends = np.cumsum(n + 1) - 1
        full = np.full(len(token) + len(n), len(hashes) - 1, np.int64)
        inner = np.ones(len(full), bool)
        inner[ends] = False
        full[inner] = token
        train = np.repeat(~out, n + 1)
        order = np.argsort(-np.bincount(full, minlength=len(hashes)), kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        counts = np.bincount(full[train], minlength=len(hashes))[order]
        block = TaskContext.get().partitionId() << 32 | seq
        return batch(
            block=[block], doc_id=pa.array([ids.to_pylist()], pa.list_(pa.int64())), held=pa.array([out.tolist()]),
            size=pa.array([(n + 1).tolist()], pa.list_(pa.int32())), tokens=[_squeezed(_planes(place[full], 4))],
            words=[hashes[order].tobytes()], counts=[_squeezed(_planes(counts, 4))],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total, seq = [], 0, 0
        for b in batches:
            flat, offsets = words(b.column("text"))
            held.append((b.column("doc_id"), b.column("held").to_numpy(zero_copy_only=False).astype(bool), flat, np.diff(offsets)))
            total += len(flat) + b.num_rows
            if total >= BLOCK:
                yield made(held, seq)
                held, total, seq = [], 0, seq + 1
        if held:
            yield made(held, seq)

    return docs.mapInArrow(run, _BLOCK)


def _dealt(hashes: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places) of a block's words, by ascending shard."""
    return _parted((mix(hashes, 1) % np.uint64(shards)).astype(np.int64), shards)


_ASKED = "shard int, block long, kind string, data binary"


def _asked(shard, block, kind, data) -> pa.RecordBatch:
    return batch(
        shard=pa.array(shard, pa.int32()), block=pa.array([block] * len(shard) if isinstance(block, int) else block, pa.int64()),
        kind=pa.array(kind, pa.string()), data=pa.array(data, pa.binary()),
    )


def _runs(batches: Iterator[pa.RecordBatch], answer) -> Iterator[pa.RecordBatch]:
    """`answer(shard, kind, blocks, data)` of each run of rows of one shard and kind."""
    now, blocks, data = None, [], []
    for b in batches:
        columns = (b.column(c).to_pylist() for c in ("shard", "block", "kind"))
        for shard, block, kind, d in zip(*columns, b.column("data"), strict=True):
            if now != (shard, kind):
                if now:
                    yield from answer(*now, blocks, data)
                now, blocks, data = (shard, kind), [], []
            blocks.append(block)
            data.append(d.as_py())
    if now:
        yield from answer(*now, blocks, data)


def _number_words(blocks: DataFrame, shards: int) -> DataFrame:
    """(shard, block, kind, data): each block's words' learned counts in all blocks and their numbers.

    A shard numbers its words by falling count and leaves room for the other shards'
    numbers, so frequent words have small numbers and no two words share one.  A row of
    kind `size` holds how many of a shard's words were learned.
    """

    def asking(batches):
        for b in batches:
            for row in b.to_pylist():
                hashes, counts = np.frombuffer(row["words"], np.uint64), _opened_numbers(row["counts"], 4)
                found = list(_dealt(hashes, shards))
                data = [hashes[at].tobytes() + _planes(counts[at], 4) for _, at in found]
                yield _asked([s for s, _ in found], row["block"], ["word"] * len(found), data)

    def answer(shard, kind, blocks, data):
        parts = [len(d) // 12 for d in data]
        hashes = np.concatenate([np.frombuffer(d, np.uint64, n) for d, n in zip(data, parts, strict=True)])
        counts = np.concatenate([_numbers(d[n * 8 :], 4) for d, n in zip(data, parts, strict=True)])
        own, back = np.unique(hashes, return_inverse=True)
        total = np.bincount(back, counts.astype(np.float64), len(own)).astype(np.uint64)
        number = np.empty(len(own), np.uint64)
        number[np.argsort(-total.astype(np.int64), kind="stable")] = np.arange(len(own), dtype=np.uint64) * np.uint64(shards) + np.uint64(shard)
        yield _asked([shard], [-1], ["size"], [np.int64((total > 0).sum()).tobytes()])
        each = np.split(back, np.cumsum(parts)[:-1])
        yield _asked([shard] * len(blocks), blocks, [kind] * len(blocks), [_squeezed(_planes(number[x], 6), _planes(total[x], 6)) for x in each])

    batch_rows(blocks.sparkSession, 1)
    asked = blocks.select("block", "words", "counts").mapInArrow(asking, _ASKED)
    asked = asked.repartition("shard").sortWithinPartitions("shard", "kind", "block")
    return asked.mapInArrow(lambda batches: _runs(batches, answer), _ASKED)


def _opened_numbers(data: bytes, width: int) -> np.ndarray:
    return _numbers(_opened(data), width)


def _renumbered(row: dict, answers: list[bytes], shards: int) -> pa.RecordBatch:
    """A block whose words are in the order of their numbers, with their counts over all blocks."""
    hashes = np.frombuffer(row["words"], np.uint64)
    number, count = np.zeros(len(hashes), np.uint64), np.zeros(len(hashes), np.uint64)
    for (_, at), data in zip(_dealt(hashes, shards), answers, strict=True):
        data = _opened(data)
        number[at], count[at] = _numbers(data[: len(at) * 6], 6), _numbers(data[len(at) * 6 :], 6)
    order = np.argsort(number)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    token = place[_opened_numbers(row["tokens"], 4).astype(np.int64)]
    end = place[np.flatnonzero(hashes == END)]
    return batch(
        block=[row["block"]], doc_id=pa.array([row["doc_id"]], pa.list_(pa.int64())), held=pa.array([row["held"]], pa.list_(pa.bool_())),
        size=pa.array([row["size"]], pa.list_(pa.int32())), tokens=[_squeezed(_planes(np.append(end, token), 4))],
        words=[_squeezed(_planes(number[order], 6))], counts=[_squeezed(_planes(count[order], 6))],
    )


def _together(blocks: DataFrame, answers: DataFrame, kinds: list[str], made, schema: str) -> DataFrame:
    """`made(block, answers by kind)` of each block and its answers, which come by ascending shard."""

    def run(batches):
        block, found = None, {}
        for b in batches:
            for row in b.to_pylist():
                if row["kind"] == "":
                    if block is not None:
                        yield made(block, found)
                    block, found = row, {kind: [] for kind in kinds}
                else:
                    found[row["kind"]].append(row["data"])
        if block is not None:
            yield made(block, found)

    names = [f.name for f in blocks.schema if f.name != "block"]
    nothing = [F.lit(None).cast(blocks.schema[n].dataType).alias(n) for n in names]
    own = blocks.select("block", F.lit("").alias("kind"), F.lit(-1).alias("shard"), *names, F.lit(None).cast("binary").alias("data"))
    back = answers.where("block >= 0").select("block", "kind", "shard", *nothing, "data")
    return own.union(back).repartition("block").sortWithinPartitions("block", "kind", "shard").mapInArrow(run, schema)


def _gram_hashes(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(mix(context, 5) ^ word, 6)


class _Level:
    """The n-grams of one length in a block in ascending order, and the order in which shards are asked for them.

    `first` is the place of an n-gram's context among the n-grams one shorter, whose words'
    numbers are `columns` and whose hashes are `own`; hashes only choose a shard and name
    the few hot contexts.
    """

    def __init__(self, context: np.ndarray, token: np.ndarray, valid: np.ndarray, own: np.ndarray, columns: list, words: np.ndarray, shards: int, hot: np.ndarray):
        where = np.flatnonzero(valid)
        self.columns, self.words, self.own = columns, words, own
        at, inverse = _distinct(context[where], token[where])
        self.place = np.full(len(token), -1, np.int32)
        self.place[where] = inverse
        self.at = where[at].astype(np.int32)  # a place of each n-gram
        self.first, self.second = context[self.at].astype(np.int32), token[self.at].astype(np.int32)
        self.hashes = _gram_hashes(own[self.first], words[self.second])
        self.hot = _among(own, hot)
        one = np.where(self.hot[self.first], mix(self.hashes, 2), own[self.first])
        self.shards, self.shard = shards, (mix(one, 1) % np.uint64(shards)).astype(np.int64)

    def __len__(self) -> int:
        return len(self.at)

    def of_shards(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(shard, contexts, how many n-grams each has, n-grams) asked of each shard that has any."""
        for s, at in _parted(self.shard, self.shards):
            first = self.first[at]  # ascending, as the n-grams are
            start = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
            yield s, first[start], np.diff(start, append=len(first)), at

    def longer(self) -> tuple[np.ndarray, np.ndarray, list]:
        """Context of each token, hashes and columns for the n-grams one longer."""
        return np.roll(self.place, 1), self.hashes, [*(c[self.first] for c in self.columns), self.words[self.second]]


class _Block:
    """A numbered block's tokens, and its n-grams of each length."""

    def __init__(self, row: dict):
        self.ids, self.held, self.size = row["doc_id"], np.array(row["held"], bool), np.array(row["size"], np.int64)
        tokens = _opened_numbers(row["tokens"], 4).astype(np.int64)
        self.token, self.words = tokens[1:], _opened_numbers(row["words"], 6)
        starts = np.cumsum(self.size) - self.size
        self.start, self.before = np.arange(len(self.token)) - np.repeat(starts, self.size), np.roll(self.token, 1)
        self.before[starts] = tokens[0]  # a text begins after an end
        self.train = np.repeat(~self.held, self.size)

    def levels(self, shards: list[int], hot: np.ndarray) -> Iterator[tuple[int, _Level]]:
        """The n-grams of each length, made one after another: a caller holds those of one length."""
        context, own, columns = self.before, mix(self.words, 9), [self.words]
        for n, many in enumerate(shards, 2):  # a text's first words have no context longer than its start
            level = _Level(context, self.token, self.start >= n - 2, own, columns, self.words, many, hot)
            yield n, level
            context, own, columns = level.longer()
            del level

    def frequent(self, order: int, share: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(hashes, counts) of the contexts with at least this share of the block's tokens."""
        own, number, valid = mix(self.words, 9), self.token, np.ones(len(self.token), bool)
        context = self.before
        for n in range(1, order):  # a context is no more frequent than its parts
            counts = np.bincount(number[valid], minlength=len(own))
            some = counts > share * len(self.token)
            yield own[some], counts[some]
            if n == order - 1 or not some.any():
                return
            if n == 1:
                words = some
                valid = some[context] & some[self.token]
            else:
                valid &= some[np.where(valid, number, 0)]
                context, valid = np.roll(number, 1), np.roll(valid, 1) & words[self.token] & (self.start >= n - 1)
            grams, inverse = np.unique(context[valid] * len(self.words) + self.token[valid], return_inverse=True)
            own = _gram_hashes(own[grams // len(self.words)], self.words[grams % len(self.words)])
            number = np.zeros(len(self.token), np.int64)
            number[valid] = inverse

    def questions(self, block: int, shards: list[int], hot: np.ndarray) -> Iterator[pa.RecordBatch]:
        for n, level in self.levels(shards, hot):
            seen = np.bincount(level.place[self.train & (level.place >= 0)], minlength=len(level))
            shard, data = [], []
            for s, contexts, many, at in level.of_shards():  # a context once, with the number of its n-grams
                columns = [c[contexts] for c in level.columns]
                columns[0] = np.diff(columns[0], prepend=np.uint64(0))  # they ascend
                head = np.array([len(contexts), len(at)], np.int64).tobytes()
                shard.append(s)
                data.append(_squeezed(head, *(_planes(c, 6) for c in columns), _planes(many, 4), _planes(level.words[level.second[at]], 6), _planes(seen[at], 4)))
            del level
            yield _asked(shard, block, [f"gram{n}"] * len(shard), data)


def _question(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts (a row for each word), n-grams of each, their last words, how often they were learned."""
    data = _opened(data)
    many, grams = (int(x) for x in np.frombuffer(data, np.int64, 2))
    at = 16 + many * 6 * (n - 1)
    contexts = np.stack([_numbers(data[16 + many * 6 * k : 16 + many * 6 * (k + 1)], 6) for k in range(n - 1)])
    contexts[0] = np.cumsum(contexts[0])
    each, at = _numbers(data[at : at + many * 4], 4).astype(np.int64), at + many * 4
    return contexts, each, _numbers(data[at : at + grams * 6], 6), _numbers(data[at + grams * 6 :], 4)


def _gram_answers(hot: np.ndarray):
    """Sums a shard's counts over all blocks, builds its trie and answers every block from it.

    A row of kind `hot` holds the hot contexts of the shard with the successors they have in it.
    """

    def answer(shard, kind, blocks, data):
        asked = [_question(d, int(kind[4:])) for d in data]
        data.clear()
        contexts, each, word, seen = (np.concatenate([a[k] for a in asked], -1) for k in range(4))
        ends = [np.cumsum([len(a[k]) for a in asked])[:-1] for k in (1, 2)]
        asked.clear()
        # many blocks ask for the same: each context and n-gram is looked for once
        at, context = _distinct(*contexts)
        contexts, under = contexts[:, at], np.repeat(context, each)
        at, gram = _distinct(under, word)
        word, under = word[at], under[at]
        count = np.bincount(gram, seen, len(at)).astype(np.int64)
        new = np.flatnonzero(count)
        levels = Trie.build(contexts[:, under[new]], word[new], count[new]).to_bytes()
        memory = mmap.mmap(-1, len(levels))
        memory.write(levels)
        trie = Trie.mapped(memory)
        own = mix(contexts[0], 9)
        for column in contexts[1:]:
            own = _gram_hashes(own, column)
        many = np.bincount(under[new], minlength=len(own))
        names = np.flatnonzero(_among(own, hot) & (many > 0))
        if len(names):
            yield _asked([shard], [-1], ["hot"], [own[names].tobytes() + many[names].astype(np.int64).tobytes()])
        widths, codes = trie.answer(contexts, np.bincount(under, minlength=len(own)), word)
        widths, codes = np.split(widths[context], ends[0]), np.split(codes[gram], ends[1])
        for block, w, c in zip(blocks, widths, codes, strict=True):
            yield _asked([shard], [block], [kind], [_squeezed(_planes(w, 4), _planes(c, 2))])

    return answer


def score(docs: DataFrame, discount: float = DISCOUNT, order: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for (doc_id, text, held).

    Rows that aren't held out are learned from; all are scored over their whole texts.
    Tokens are the lower-cased (A-Z) words and one end a text; null texts are empty.  The
    base is additive smoothing of word counts, p1 = (c + 0.5) / (N + 0.5 (V + 1)).  The model
    is absolute discounting, p = (max(c(uv) - d, 0) + d T(u) p1(v)) / c(u), where T(u) is the
    number of different successors of u; after a word never learned it is p1.  The first
    word follows an end.  With an `order` above 2 the same rule goes on: the context is the
    n-gram before a word, as far as its text has one, and what p1 is to a pair the
    probability with the context's first word left out is to a longer n-gram.  Counts of
    n-grams come from the tries, exact to 4096 and within 1/500 beyond.  Words are told apart
    by 64-bit hashes, n-grams by the numbers of their words.  A null held flag counts as
    false.  Repeated rows count each time.  An empty table gives no rows.

    Blocks of tokens are stored once.  First their words get counts and numbers, small for
    frequent words, and the blocks are stored with them.  Then each asks the shards for its
    distinct n-grams; a shard sums the counts of all blocks, builds its trie and answers from
    it; the answers meet their block again.  Everything is a shuffle of packed arrays of
    bounded size.  The n-grams of the few most frequent contexts are dealt over all shards;
    how many successors these contexts have is summed once and handed to all tasks.
    """
    spark = docs.sparkSession
    batch_rows(spark, 256)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("held", F.lit(False)).alias("held"))
    blocks = stored(_blocks(docs), "tokens")
    lengths = F.aggregate("size", F.lit(0).cast("long"), lambda s, x: s + x)
    kept = F.aggregate(
        F.zip_with("size", "held", lambda n, h: F.when(h, 0).otherwise(n)), F.lit(0).cast("long"), lambda s, x: s + x
    )
    total, train = blocks.select(lengths.alias("n"), kept.alias("t")).agg(F.sum("n"), F.sum("t")).first()
    if not total:
        return spark.createDataFrame([], _SCORES)
    word_shards = total * 2 // 3 // SHARD + 1
    # most pairs of a block come several times, longer n-grams seldom
    shards = [total * 2 // 3 // SHARD + 1] + [total * 3 // 2 // SHARD + 1] * (order - 2)
    answers = stored(_number_words(blocks, word_shards), "words")
    sizes = answers.where("kind = 'size'").select("data").mapInArrow(_sizes, "n long").agg(F.sum("n")).first()[0]
    vocabulary, train = int(sizes or 0), int(train)
    batch_rows(spark, 4)
    blocks_before, words_before = blocks, answers
    blocks = stored(_together(blocks, answers, ["word"], lambda row, found: _renumbered(row, found["word"], word_shards), _BLOCK), "blocks")
    drop_stored(blocks_before)
    drop_stored(words_before)

    def frequent(batches):
        for b in batches:
            for row in b.to_pylist():
                for own, counts in _Block(row).frequent(order, HOT / 2):
                    yield batch(word=own.astype(np.int64), n=counts)

    # contexts of at least the share HOT of all tokens: 1 / HOT of each length at most
    batch_rows(spark, 1)
    tally = blocks.mapInArrow(frequent, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    hot = np.array([r["word"] for r in tally.where(F.col("n") >= HOT / 2 * total).select("word").collect()], np.int64).astype(np.uint64)

    def asking(batches):
        for b in batches:
            for row in b.to_pylist():
                yield from _Block(row).questions(row["block"], shards, hot)

    answer = _gram_answers(hot)
    asked = blocks.mapInArrow(asking, _ASKED).repartition("shard", "kind").sortWithinPartitions("shard", "kind", "block")
    answers = stored(asked.mapInArrow(lambda batches: _runs(batches, answer), _ASKED), "answers")
    successors = answers.where("kind = 'hot'").select("data").mapInArrow(_successors, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    many = {r["word"]: r["n"] for r in successors.collect()}  # those of `hot` at most
    many = np.array([many.get(h, 0) for h in hot.astype(np.int64).tolist()], np.int64)
    batch_rows(spark, 4)

    def scored(row, found):
        return _scored(row, found, shards, hot, many, train, vocabulary, discount)

    return _together(blocks, answers, [f"gram{n}" for n in range(2, order + 1)], scored, _SCORES)


def _sizes(batches):
    for b in batches:
        yield batch(n=[int(np.frombuffer(d.as_py(), np.int64)[0]) for d in b.column("data")])


def _successors(batches):
    for b in batches:
        for d in b.column("data"):
            word, n = np.frombuffer(d.as_py(), np.int64).reshape(2, -1)
            yield batch(word=word, n=n)


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scored(row: dict, found: dict, shards: list[int], hot: np.ndarray, many: np.ndarray, train: int, vocabulary: int, discount: float) -> pa.RecordBatch:
    """Scores of a block's texts from the shards' answers, which come by ascending shard."""
    block = _Block(row)
    count = _opened_numbers(row["counts"], 6).astype(np.float64)
    p1 = (count + 0.5) / (train + 0.5 * (vocabulary + 1))
    n_known = (count[block.token] > 0).astype(np.int64)
    shorter, p = count, p1[block.token]  # counts of the n-grams one shorter, probability of each token
    by_hash = np.argsort(hot)
    for n, level in block.levels(shards, hot):
        gram, branching = np.zeros(len(level)), np.zeros(len(level.own))
        for data, (_, contexts, _, at) in zip(found[f"gram{n}"], level.of_shards(), strict=True):
            data = _opened(data)
            branching[contexts] = _numbers(data[: len(contexts) * 4], 4)
            gram[at] = CODES[_numbers(data[len(contexts) * 4 :], 2).astype(np.int64)]
        spread = np.flatnonzero(level.hot)
        branching[spread] = many[by_hash][np.searchsorted(hot[by_hash], level.own[spread])]
        context = shorter[level.first]
        rest = np.where(context > 0, discount * branching[level.first], 1.0)
        own = (np.maximum(gram - discount, 0) + rest * p[level.at]) / np.maximum(context, 1)
        p = np.where(level.place >= 0, np.minimum(own, 1.0)[level.place], p) if len(own) else p
        shorter = gram
        del level
    starts = np.cumsum(block.size) - block.size
    sums = lambda x: np.add.reduceat(x, starts)
    return batch(
        doc_id=pa.array(block.ids, pa.int64()), held_out=block.held, n_tokens=block.size,
        n_known=sums(n_known), train_tokens=np.full(len(block.size), train, np.int64),
        base_score=sums(np.log10(p1)[block.token]), score=sums(np.log10(p)),
    )
