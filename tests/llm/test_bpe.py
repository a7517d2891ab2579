import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketlake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def model():
    return bpe.load_tokenizer(PATH)


def test_merges_are_the_librarys(library, model):
    rng = random.Random(4)
    letters = [chr(c) for c in [*range(0x250), 0x3000, 0x2028, 0x1F600, 0x85, 0x1680, 0x301, 0x4E2D, 0x660, 0xFEFF]]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(1500)]
    texts += ["a" * 501, " " * 300, "aaa   bbb", "don't we'LL", "\r\n\r\n x", "ab" * 4000]
    split = regex.compile(bpe.SPLIT).findall
    for text in texts:
        found = [w.encode() for w in split(text)]
        ids, length = bpe.merge_words(model, found)
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert length.sum() == len(ids)


def test_lexicon_is_minimal_and_exact():
    words = sorted({w.encode() for w in "walk walks walked walking talk talks talked talking é a".split()})
    lexicon = bpe.build_lexicon(words)
    assert bpe.find_words(lexicon, words).tolist() == list(range(len(words)))
    assert (bpe.find_words(lexicon, [b"", b"wal", b"walke", b"talkss", b"b", b"walkings"]) == -1).all()
    # the endings are shared: far fewer arcs than letters
    assert len(lexicon["key"]) < sum(map(len, words)) / 2
    assert (bpe.find_words(bpe.build_lexicon([]), [b"a", b""]) == -1).all()


def test_automaton_has_no_two_equal_states():
    words = sorted({bytes(random.Random(k).choices(b"abc", k=random.Random(k).randint(1, 6))) for k in range(200)})
    lexicon = bpe.build_lexicon(words)
    states = {}
    for key, target in zip(lexicon["key"].tolist(), lexicon["target"].tolist(), strict=True):
        states.setdefault(key >> 8, []).append((key & 255, target))
    shapes = [(int(lexicon["final"][s]), tuple(states.get(s, ()))) for s in range(len(lexicon["final"]) - 1)]
    assert len(set(shapes)) == len(shapes)


@pytest.mark.parametrize("remembered", [400_000, 10])
def test_round_trip(spark, sf_dir, library, monkeypatch, remembered):
    monkeypatch.setattr(bpe, "REMEMBERED", remembered)
    monkeypatch.setattr(bpe, "ROWS", 16)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    encoded = bpe.encode(docs, PATH, 200)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = bpe.decode(encoded, PATH).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["ids"] == library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["text"] == texts[r["doc_id"]]


def test_awkward_rows(spark, awkward_docs, no_docs, library):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    wanted = []
    for r in awkward_docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        wanted.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    clash = awkward_docs.withColumn("ids", F.lit("x")).withColumn("n", F.lit(1))
    found = [tuple(r) for r in bpe.digests(clash, PATH).collect()]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert bpe.digests(no_docs, PATH).count() == 0
    back = bpe.round_trip(awkward_docs, PATH).select("doc_id", "text").collect()
    assert sorted(map(repr, back)) == sorted(repr(r) for r in awkward_docs.fillna("", ["text"]).select("doc_id", "text").collect())
    assert len(bpe.frequent_words(awkward_docs, 3)) <= 3


def test_bytes_that_are_no_text(spark, library):
    odd = [[255 - 33, 188], [50256, 0], [], [220] * 3]
    rows = spark.createDataFrame([(k, ids) for k, ids in enumerate(odd)] + [(9, None)], "doc_id long, ids array<int>")
    found = {r["doc_id"]: r["text"] for r in bpe.decode(rows, PATH).collect()}
    assert found == {**{k: library.decode(ids, skip_special_tokens=False) for k, ids in enumerate(odd)}, 9: ""}
    assert np.all(bpe.load_tokenizer(PATH)["byte"] >= 0)
