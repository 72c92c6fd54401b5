import hashlib
import json
import random

import pytest
from tokenizers import Tokenizer

from folio.llm import bpe


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(bpe.tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def test_whole_table_equals_library(spark, library, small_docs):
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.op1_bpe(spark, "/root/testdata/sf0.001").collect()}
    assert got == {d["doc_id"]: digests(library, d["text"]) for d in small_docs}


def test_odd_strings_equal_library(library):
    own = bpe.PairIndexBpe(json.load(open(bpe.tokenizer_path(), encoding="utf-8")))
    r = random.Random(3)
    pools = ["abc '’\n\t", "'s're've'm'll'd'T x", "ΣσςİıßÅé", "\x1c\x85\xa0 ​ ab\x00", "0½²Ⅷ٣二", "<|endoftext|>|< ", "😀👩‍👧🏽가각", "aaaabbbb!!..--"]
    for i in range(2000):
        s = "".join(r.choice(r.choice(pools) if r.random() < 0.3 else pools[i % len(pools)]) for _ in range(r.randint(0, 40)))
        s += r.choice(["", "", "<|startoftext|>" + s, chr(r.choice([0x323B0, 0x1C89, 0xA7DA]))])
        ids = library.encode(s, add_special_tokens=False).ids
        assert own.encode(s) == ids, repr(s)
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_memory_is_bounded_and_does_not_change_results(library, small_docs, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_WORDS", 50)
    own = bpe.PairIndexBpe(json.load(open(bpe.tokenizer_path(), encoding="utf-8")))
    for d in small_docs[:20]:
        assert own.encode(d["text"]) == library.encode(d["text"], add_special_tokens=False).ids


def test_edge_rows(spark, library):
    long_text = "word " * 60_000 + "x" * 30_000
    rows = [(1, None, "a"), (2, "", "b"), (None, "hello", "c"), (3, "same", "d"), (3, "same", "d"), (4, long_text, "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.encode_documents(df).collect()))
    assert got == sorted((i or -1, *digests(library, t)) for i, t, _ in rows)
    assert bpe.encode_documents(df.filter("false")).count() == 0


def test_round_trip_of_ids(spark, library):
    df = spark.createDataFrame([(1, "Hello, World's <|endoftext|> 12"), (2, None)], "doc_id long, text string")
    ids = {r["doc_id"]: r["ids"] for r in bpe.encode_ids(df).collect()}
    assert ids == {1: library.encode("Hello, World's <|endoftext|> 12", add_special_tokens=False).ids, 2: []}
    back = {r["doc_id"]: r["text"] for r in bpe.decode_ids(bpe.encode_ids(df)).collect()}
    assert back == {1: library.decode(ids[1], skip_special_tokens=False), 2: ""}


def test_worker_holds_one_vocabulary(monkeypatch):
    """The library's tokenizer is made for its normaliser alone, and what an operator held goes back before the next is built."""
    import json

    import tokenizers

    from folio.llm import bpe, common

    read = []
    make = tokenizers.Tokenizer.from_str
    monkeypatch.setattr(bpe.tokenizers, "Tokenizer", type("T", (), {"from_str": staticmethod(lambda s: read.append(len(s)) or make(s))}))
    with open(bpe.tokenizer_path(), encoding="utf-8") as f:
        spec = f.read()
    mine = bpe.PairIndexBpe(json.loads(spec))
    assert max(read) < 100_000 < len(spec)
    whole = make(spec).normalizer.normalize_str
    for text in ("ÀB́ Σς ΑΣ ß İ ﬁ", "<|endoftext|> A", "ẞ\U0001e921 x"):
        assert mine.library_norm(text) == whole(text)
    freed = []
    monkeypatch.setattr(common, "_resident", {"a": 1})
    monkeypatch.setattr(common, "_give_back", lambda: freed.append(dict(common._resident)))
    assert common.resident("b", lambda: 2) == 2 and common.resident("b", lambda: 3) == 2
    assert freed == [{}]


def test_a_word_is_remembered_as_its_ids_alone(library, small_docs):
    own = bpe.PairIndexBpe(json.load(open(bpe.tokenizer_path(), encoding="utf-8")))
    texts = ["Hello, World's <|endoftext|> hello", None, ""] + [d["text"] for d in small_docs[:5]]
    assert list(bpe._digests(own, texts)) == [digests(library, t) for t in texts]
    assert own.memory and all(type(ids) is str for ids in own.memory.values())
