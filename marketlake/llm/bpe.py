"""Byte-level BPE: frequent words from a minimal acyclic transducer, exact merges for the rest."""

from __future__ import annotations

import hashlib
import json
import mmap
import re
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, batch, batch_rows, drop_stored, new_path, released, stored

#: Words that the lexicon holds at most, words a task remembers before it starts afresh, texts of a batch.
LEXICON, REMEMBERED, ROWS = 65_536, 400_000, 256
#: The byte-level splitting pattern that the tokenizer file's `use_regex` stands for (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NO_RANK = np.int64(2**62)


def _byte_alphabet() -> list[str]:
    """The character that stands for each byte in the tokenizer file: itself if printable, else from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        out[b], spare = (chr(b), spare) if b in plain else (chr(spare), spare + 1)
    return out


def load_tokenizer(path: str) -> dict:
    """Byte ids, ranked merges and token bytes of a byte-level BPE file, as arrays."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    alphabet, vocab = _byte_alphabet(), spec["model"]["vocab"]
    back = {c: b for b, c in enumerate(alphabet)}
    merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
    order = np.argsort(keys, kind="stable")
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    token = [b""] * (max([*vocab.values(), *added.values()]) + 1)
    for text, i in {**vocab, **added}.items():
        token[i] = b"".join(bytes([back[c]]) if c in back else c.encode() for c in text)
    return {
        "byte": np.array([vocab[c] for c in alphabet], np.int64), "keys": keys[order], "rank": order.astype(np.int64),
        "merged": np.array([vocab[a + b] for a, b in merges], np.int64), "token": _table(token),
        "number": _table([f"{i},".encode() for i in range(len(token))]), "added": added,
    }


def _table(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all values, start and length of each."""
    length = np.array([len(v) for v in values], np.int64)
    return np.frombuffer(b"".join(values), np.uint8), np.cumsum(length) - length, length


def gather(table: tuple[np.ndarray, np.ndarray, np.ndarray], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen values of a table one after another, and where each ends."""
    data, start, length = table
    n = length[index]
    ends = np.cumsum(n)
    return data[np.repeat(start[index] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)], ends


def merge_words(model: dict, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, length of each word): the tokenizer's merges, exactly, for all words at once.

    Each round merges, in every word, the pair of least rank, at all its places from the
    left.  Words without a mergeable pair leave the working set.
    """
    length = np.array([len(w) for w in words], np.int64)
    out_length, out = length.copy(), [np.zeros(0, np.int64)] * len(words)
    sym = model["byte"][np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), length)
    done_sym, done_word = [], []

    def ranks(at):
        if not len(at):
            return np.zeros(0, np.int64)
        key = (sym[at] << 32) | sym[np.minimum(at + 1, len(sym) - 1)]
        place = np.minimum(np.searchsorted(model["keys"], key), len(model["keys"]) - 1)
        good = (at + 1 < len(sym)) & (word[np.minimum(at + 1, len(sym) - 1)] == word[at]) & (model["keys"][place] == key)
        return np.where(good, model["rank"][place], _NO_RANK)

    rank = ranks(np.arange(len(sym)))
    while len(sym):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        count = np.diff(np.r_[first, len(sym)])
        least = np.repeat(np.minimum.reduceat(rank, first), count)
        over = least == _NO_RANK
        if over.any():
            done_sym.append(sym[over])
            done_word.append(word[over])
            sym, word, rank, least = sym[~over], word[~over], rank[~over], least[~over]
            continue
        at = np.flatnonzero(rank == least)
        # a run of one symbol pairs with itself: every other place from the left
        run = np.r_[True, np.diff(at) != 1]
        at = at[(np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]) % 2 == 0]
        sym[at] = model["merged"][rank[at]]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        at = at - np.searchsorted(at, at)  # each earlier merge took one place away
        sym, word, rank = sym[keep], word[keep], rank[keep]
        near = np.unique(np.r_[at, np.maximum(at - 1, 0)])
        rank[near] = ranks(near)
    if done_sym:
        all_sym, all_word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(all_word, kind="stable")
        return all_sym[order], np.bincount(all_word, minlength=len(words))
    return np.zeros(0, np.int64), out_length * 0


def build_lexicon(words: list[bytes]) -> dict[str, np.ndarray]:
    """The minimal acyclic automaton of sorted words; outputs along a path add up to a word's number.

    States with equal continuations are shared as soon as their last word is in, so common
    suffixes are stored once.
    """
    register: dict[tuple, int] = {}
    arcs: list[tuple] = []  # of each registered state: (final, (label, target), ...)
    path: list[list] = [[False, []]]  # the open states along the last word: final, [(label, target)]
    last = b""

    def close(depth):
        while len(path) > depth + 1:
            final, out = path.pop()
            key = (final, tuple(out))
            state = register.get(key)
            if state is None:
                state = register[key] = len(arcs)
                arcs.append(key)
            path[-1][1][-1] = (path[-1][1][-1][0], state)

    for w in words:
        shared = 0
        while shared < min(len(w), len(last)) and w[shared] == last[shared]:
            shared += 1
        close(shared)
        for b in w[shared:]:
            path[-1][1].append((b, -1))
            path.append([False, []])
        path[-1][0] = True
        last = w
    close(0)
    arcs.append((path[0][0], tuple(path[0][1])))  # the root is the last state
    accepted = np.zeros(len(arcs), np.int64)
    key, target, output = [], [], []
    for state, (final, out) in enumerate(arcs):  # targets come before their sources
        number = int(final)
        for label, to in out:
            key.append(state << 8 | label)
            target.append(to)
            output.append(number)
            number += int(accepted[to])
        accepted[state] = number
    return {
        "key": np.array(key, np.int64), "target": np.array(target, np.int64), "output": np.array(output, np.int64),
        "final": np.array([a[0] for a in arcs], np.int64), "root": np.array([len(arcs) - 1], np.int64),
    }


def find_words(lexicon: dict[str, np.ndarray], words: list[bytes]) -> np.ndarray:
    """The number of each word in the lexicon, -1 where it isn't there: all words walk a step at a time."""
    length = np.array([len(w) for w in words], np.int64)
    data, start = np.frombuffer(b"".join(words), np.uint8), np.cumsum(length) - length
    state = np.full(len(words), lexicon["root"][0])
    number, live, step = np.zeros(len(words), np.int64), np.arange(len(words)), 0
    if not len(lexicon["key"]):
        return np.full(len(words), -1)
    while len(live := live[length[live] > step]):
        key = state[live] << 8 | data[start[live] + step]
        at = np.minimum(np.searchsorted(lexicon["key"], key), len(lexicon["key"]) - 1)
        there = lexicon["key"][at] == key
        state[live[~there]] = -1
        live, at = live[there], at[there]
        number[live] += lexicon["output"][at]
        state[live] = lexicon["target"][at]
        step += 1
    return np.where((state >= 0) & (lexicon["final"][state] == 1), number, -1)


_PARTS = ("key", "target", "output", "final", "root", "ids", "starts")


def _write_parts(parts: dict[str, np.ndarray]) -> bytes:
    """One file: the parts' lengths, then their 64-bit numbers."""
    head = np.array([len(parts[p]) for p in _PARTS], np.int64)
    return b"".join([head.tobytes(), *(np.ascontiguousarray(parts[p], np.int64).tobytes() for p in _PARTS)])


def _map_parts(path: str) -> dict[str, np.ndarray]:
    with open(path, "rb") as f:
        whole = np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), np.int64)
    ends = np.cumsum(whole[: len(_PARTS)]) + len(_PARTS)
    return {p: whole[e - n : e] for p, n, e in zip(_PARTS, whole[: len(_PARTS)], ends, strict=True)}


def frequent_words(docs: DataFrame, size: int = LEXICON) -> list[bytes]:
    """At most `size` of the most frequent words of letters over all whole texts, as the splitter sees them after a blank.

    Words of one count come all or none, so the choice does not depend on the partitions.
    """
    batch_rows(docs.sparkSession, 1024)

    def counted(batches):
        held, rows = [], 0
        for b in batches:
            flat = pc.list_flatten(pc.ascii_split_whitespace(pc.fill_null(b.column("text").cast(pa.large_string()), "")))
            held.append(flat.filter(pc.utf8_is_alpha(flat)))
            rows += len(held[-1])
            if rows > 2_000_000:
                yield tallied(held)
                held, rows = [], 0
        if rows:
            yield tallied(held)

    def tallied(held):
        tally = pa.concat_arrays(held).value_counts()
        return batch(word=tally.field("values").cast(pa.string()), n=tally.field("counts"))

    tally = docs.select("text").mapInArrow(released(counted), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    tally = stored(tally, "words")
    # the least count that leaves at most `size` words, from how many words have each count
    left, least = size, None
    for n, words in tally.groupBy("n").agg(F.count("*")).orderBy(F.col("n").desc()).limit(size).collect():
        if words > left:
            break
        left, least = left - words, n
    top = [] if least is None else tally.where(F.col("n") >= least).select("word").collect()  # `size` words at most
    drop_stored(tally)
    return sorted(b" " + r["word"].encode() for r in top)


def publish_lexicon(spark: SparkSession, model: dict, words: list[bytes]) -> str:
    """Compile the words, with their ids, into a file that Spark hands to every executor; returns its name."""
    ids, length = merge_words(model, words)
    parts = build_lexicon(words) | {"ids": ids, "starts": np.r_[0, np.cumsum(length)]}
    name = f"lexicon-{uuid.uuid4().hex}"
    path = new_path(spark, name)
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(_write_parts(parts)))
    out.close()
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]


class _Seen(dict):
    """Word numbers of a task; a new word gets the next number and is noted."""

    def __init__(self):
        self.new = []

    def __missing__(self, word):
        self[word] = n = len(self)
        self.new.append(word)
        return n


def encode(
    docs: DataFrame,
    path: str,
    lexicon: int = LEXICON,
    finish: Callable[[dict, pa.RecordBatch], pa.RecordBatch] | None = None,
    schema: str = "",
) -> DataFrame:
    """`docs` (text and others) with `ids`, the token ids of each whole text.

    Ids equal those of the tokenizer file without special tokens added around a text; the
    strings of its added tokens inside a text get their ids.  Null and empty texts get an
    empty list.  Rows are independent: nulls, repeated rows and clashing names pass
    through; a column named `ids` is replaced.

    The frequent words of all texts, counted on Spark, are compiled once into a transducer
    that tasks map into memory.  A task looks up every word it has not met; what the
    transducer doesn't hold is merged exactly, many words at a time.  `finish` works on
    each encoded batch in the same task (with the tokenizer's arrays) and gives the rows
    of `schema`: one Python worker then does both.
    """
    spark = docs.sparkSession
    docs = docs.drop("ids")
    model = load_tokenizer(path)
    name = publish_lexicon(spark, model, frequent_words(docs, lexicon))
    shared = spark.sparkContext.broadcast(model)
    kinds = docs.dtypes

    def run(batches):
        model, known = shared.value, _map_parts(SparkFiles.get(name))
        split = regex.compile(SPLIT).findall
        special = re.compile("|".join(map(re.escape, sorted(model["added"], key=len, reverse=True))) or r"(?!)")
        fresh = lambda: (_Seen(), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        seen, ids, start, length = fresh()
        for b in batches:
            if len(seen) > REMEMBERED:
                seen, ids, start, length = fresh()
            numbers, counts = [], []
            for text in b.column("text").to_pylist():
                count = 0
                for k, part in enumerate(_around(special, text or "")):
                    found = split(part) if k % 2 == 0 else [("", part)]
                    numbers.append(np.fromiter(map(seen.__getitem__, found), np.int64, len(found)))
                    count += len(found)
                counts.append(count)
            if seen.new:
                more, n = _ids_of(model, known, seen.new)
                start = np.r_[start, len(ids) + np.cumsum(n) - n]
                ids, length = np.r_[ids, more], np.r_[length, n]
                seen.new = []
            index = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
            flat, ends = gather((ids, start, length), index)
            offsets = np.r_[0, ends][np.r_[0, np.cumsum(counts)]].astype(np.int32)
            made = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))
            out = pa.RecordBatch.from_arrays([*b.columns, made], [*b.schema.names, "ids"])
            yield finish(model, out) if finish else out

    batch_rows(spark, ROWS)
    return docs.mapInArrow(released(run), schema or ", ".join([*(f"`{c}` {t}" for c, t in kinds), "ids array<int>"]))


def _around(special: re.Pattern, text: str) -> list[str]:
    """Plain text and added tokens in turn, beginning with plain text."""
    out, at = [], 0
    for m in special.finditer(text):
        out += [text[at : m.start()], m.group()]
        at = m.end()
    return [*out, text[at:]]


def _ids_of(model: dict, known: dict, words: list) -> tuple[np.ndarray, np.ndarray]:
    """(ids, length of each) of new words; a tuple holds an added token."""
    added = [isinstance(w, tuple) for w in words]
    plain = [b"" if a else w.encode("utf-8") for w, a in zip(words, added, strict=True)]
    number = find_words(known, plain)
    length = np.zeros(len(words), np.int64)
    there = np.flatnonzero(number >= 0)
    length[there] = known["starts"][number[there] + 1] - known["starts"][number[there]]
    rest = np.flatnonzero((number < 0) & ~np.array(added, bool))
    merged, length[rest] = merge_words(model, [plain[i] for i in rest])
    length[added] = 1
    out = np.zeros(int(length.sum()), np.int64)
    begin = np.cumsum(length) - length

    def put(at, values):
        n = length[at]
        ends = np.cumsum(n)
        out[np.repeat(begin[at] - ends + n, n) + np.arange(len(values))] = values

    table = (known["ids"], known["starts"][:-1], np.diff(known["starts"]))
    put(there, gather(table, number[there])[0])
    put(rest, merged)
    put(np.flatnonzero(added), np.array([model["added"][w[1]] for w, a in zip(words, added, strict=True) if a], np.int64))
    return out, length


def decode_batch(model: dict, lists: pa.Array) -> list[str]:
    """The text of each list of ids; bytes that aren't UTF-8 become U+FFFD."""
    offsets = lists.offsets.to_numpy()
    flat = np.asarray(lists.values)[offsets[0] : offsets[-1]]
    data, ends = gather(model["token"], flat)
    ends = np.r_[0, ends][offsets - offsets[0]]
    data = data.tobytes()
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """`encoded` with `text`, decoded from `ids` (null: empty); special tokens are kept."""
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(load_tokenizer(path))
    rows = encoded.drop("text").withColumn("ids", F.coalesce("ids", F.array().cast("array<int>")))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = pa.array(decode_batch(shared.value, b.column("ids")), pa.string())
        return pa.RecordBatch.from_arrays([*b.columns, texts], [*b.schema.names, "text"])

    batch_rows(spark, ROWS)
    return arrow_map(rows, run, ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes), "text string"]))


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def digest_batch(model: dict, b: pa.RecordBatch) -> pa.RecordBatch:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded documents."""
    lists = b.column("ids")
    offsets = lists.offsets.to_numpy()
    flat = np.asarray(lists.values)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    data, ends = gather(model["number"], flat)
    data, ends = data.tobytes(), np.r_[0, ends][offsets]
    sha = lambda x: hashlib.sha256(x).hexdigest()
    numbers = [sha(data[a : max(a, e - 1)]) for a, e in zip(ends[:-1], ends[1:], strict=True)]
    texts = [sha(t.encode("utf-8")) for t in decode_batch(model, lists)]
    return batch(doc_id=b.column("doc_id"), n_tokens=np.diff(offsets).astype(np.int64), ids_sha256=numbers, decoded_sha256=texts)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded, and decoded again from its ids."""
    docs = docs.select("doc_id", "text")
    return encode(docs, path, finish=digest_batch, schema=f"doc_id {dict(docs.dtypes)['doc_id']}, {DIGESTS}")


def decoded_batch(model: dict, b: pa.RecordBatch) -> pa.RecordBatch:
    """An encoded batch whose text is the one that its ids decode to."""
    at = b.schema.names.index("text")
    return b.set_column(at, "text", pa.array(decode_batch(model, b.column("ids")), b.schema.field(at).type))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """`docs` with `ids`, and with `text` replaced by what the ids decode to."""
    docs = docs.drop("ids")
    schema = ", ".join([*(f"`{c}` {t}" for c, t in docs.dtypes), "ids array<int>"])
    return encode(docs, path, finish=decoded_batch, schema=schema)
