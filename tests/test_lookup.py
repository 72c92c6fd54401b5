"""Lookups that read little: titles by range (S3), indexed search (B11), sentences by fingerprints (T4)."""

import random
import re

import pytest
from pyspark.sql import functions as F

from folio.operators import sentences as S
from folio.operators import trigram_index as X
from folio.sources import title_index as TI
from folio.sources.corpus_io import DOCS_SCHEMA

PAGES = "doc_id long, page int, page_text string"


def test_a_title_is_read_from_one_file_of_many(spark, tmp_path):
    root = str(tmp_path / "c")
    rows = [(f"t{i:03d}", p, f"{i} {p}", "2024", None, f"t{i:03d}", f"p{i}") for i in range(160) for p in range(5)]
    rows += [(None, p, "untitled", "2024", None, None, "short") for p in range(3)]
    with pytest.raises(ValueError, match="holds no corpus"):
        TI.read_titles(spark, root, ["t001"])
    TI.write_by_title(spark.createDataFrame(rows, DOCS_SCHEMA), root, files=16)
    everything = len(spark.read.parquet(*[f"{root}/by_title/{f}" for f in TI.Snapshots(spark, root).names("by_title")]).inputFiles())
    assert everything >= 12
    one = TI.read_titles(spark, root, ["t077"])
    assert sorted((r.page, r.page_content) for r in one.collect()) == [(p, f"77 {p}") for p in range(5)]
    assert 1 <= len(one.inputFiles()) <= 2  # a title on a border lies in two
    singles = [len(TI.read_titles(spark, root, [f"t{i:03d}"]).inputFiles()) for i in (0, 40, 80, 120)]
    assert min(singles) == 1 and "PushedFilters" in one._jdf.queryExecution().executedPlan().toString()
    assert [r.page_content for r in TI.read_title_page(spark, root, "t005", 3).collect()] == ["5 3"]
    assert sorted(r.page_content for r in TI.read_titles(spark, root, [None, "t000", "nothing"]).collect()) == ["0 0", "0 1", "0 2", "0 3", "0 4"] + ["untitled"] * 3
    assert TI.read_titles(spark, root, ["zzz"]).collect() == []
    TI.write_by_title(spark.createDataFrame(rows[:5], DOCS_SCHEMA), root)
    assert TI.read_titles(spark, root, ["t077"]).count() == 0 and TI.read_titles(spark, root, ["t077"], snapshot=0).count() == 5
    TI.expire_by_title(spark, root)
    assert TI.read_titles(spark, root, ["t000"]).count() == 5


@pytest.mark.parametrize(
    ("pattern", "needs"),
    [
        ("ent[a-z]*ion", ("and", ("ent", "ion"))),
        ("Word", ("and", ("wor", "ord"))),
        ("ab", True),
        ("a.c", True),
        ("(?:abc|xyz)d", ("or", ("abc", "xyz"))),
        ("(abc|x)def", "def"),
        ("(abcd)+e", ("and", ("abc", "bcd"))),
        ("(abcd)?efg", "efg"),
        ("ab(cd)ef", ("and", ("abc", "bcd", "cde", "def"))),
        (r"\bthe\b end$", ("and", ("the", "he ", "e e", " en", "end"))),
        ("(?i)ABC", "abc"),
        ("abc(?=xyz)", "abc"),
        ("abc(?!xyz)", "abc"),
        ("abc{2,3}d", True),
        ("(abc){2}", "abc"),
        (r"\p{L}abc", True),
        (r"\Qabc\E", True),
        (r"abc\v", True),
        ("(?<name>abc)", True),
        ("(?iu)abc", True),
        ("[abc", True),
        ("한국어", "한국어"),
    ],
)
def test_what_a_pattern_requires(pattern, needs):
    assert X.required(pattern) == needs


def test_indexed_search_equals_a_scan(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(X, "BLOCK_BITS", 4)  # common trigrams are split into many rows
    rng = random.Random(3)
    words = ["Entertaining", "the", "THE", "한국어", "é", "K", "K", "mention", "x\ny", "pension", "a", "ab", "function"]
    rows = [(i, p, " ".join(rng.choices(words, k=rng.randint(0, 9)))) for i in range(120) for p in range(3)] + [(900, 0, None), (901, 0, ""), (901, 0, ""), (None, 0, "the mention")]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    path = str(tmp_path / "index")
    X.write_index(pages, path)
    lists = spark.read.parquet(f"{path}/postings")
    assert lists.select(F.max(F.size("page_nos"))).first()[0] <= 16
    assert lists.where("trigram = 'the'").count() > 3
    order = lambda rows: sorted(map(tuple, rows), key=repr)
    for pattern, case in [("ent[a-z]*ion", True), ("(pen|men)[st]ion", True), ("THE", False), ("the", True), ("k", True), ("한국어 the", False), (r"x\sy", True), ("nowhere", True), ("", True), ("(function){2}|ab a", True)]:
        hit, n, first = X.search("page_text", pattern, case)
        want = pages.where(hit).withColumn("n_matches", n.cast("long")).withColumn("first_match", first)
        assert order(X.search_index(spark, path, pattern, case).collect()) == order(want.collect()), pattern
    with monkeypatch.context() as m:  # more candidates than are listed
        m.setattr(X, "LISTED_PAGES", 5)
        assert X.search_index(spark, path, "mention").count() == pages.where("page_text rlike '(?i)mention'").count()
    assert X.search_index(spark, path, "nowhere to be seen").count() == 0
    X.write_index(pages.limit(0), str(tmp_path / "empty"))
    assert X.search_index(spark, str(tmp_path / "empty"), "the").collect() == []
    # a rare pattern leaves few pages to be read
    assert X.candidates(spark, path, "한국어 한국어 한국어").count() < 0.2 * len(rows)


def dropped(rows, sentences):
    """Left to right, the first sentence of the table at each word; by plain loops."""
    table = [(no, s.split()) for no, s in sorted(sentences) if s and s.split()]
    out = []
    for doc, page, text in rows:
        if text is None:
            out.append((doc, page, None, 0))
            continue
        spans = [m.span() for m in re.finditer(r"\S+", text)]
        w = [text[a:b] for a, b in spans]
        at, keep, n, i = 0, [], 0, 0
        while i < len(w):
            hit = next((s for _, s in table if w[i : i + len(s)] == s), None)
            if hit:
                keep.append(text[at : spans[i][0]])
                at, i, n = spans[i + len(hit) - 1][1], i + len(hit), n + 1
            else:
                i += 1
        out.append((doc, page, "".join(keep) + text[at:], n))
    return sorted(out, key=repr)


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_sentences_equal_a_plain_loop(spark, monkeypatch, broadcast):
    monkeypatch.setattr(S, "BROADCAST_SENTENCES", broadcast)
    rng = random.Random(9)
    letters = ["a", "b", "c", "d.", "e", "F"]
    sentences = list({" ".join(rng.choices(letters, k=rng.choice([1, 2, 3, 5, 7]))) for _ in range(400)} - {"a", "b", "c"})
    table = [(i, s) for i, s in enumerate(sentences)] + [(9000, sentences[0]), (9001, None), (9002, " \n"), (9003, "a  b\tc")]
    blank = [" ", "  ", "\n", " \t"]
    rows = [(i, 0, "".join(rng.choice(blank) + rng.choice(letters) for _ in range(rng.randint(0, 60))) + rng.choice(["", " ", "\n\n"])) for i in range(150)]
    rows += [(500, 0, None), (501, 0, ""), (502, 0, "  "), (503, 0, "a b c"), (503, 0, "a b c"), (503, 0, "other text"), (None, None, "a b c a b c"), (504, 0, "x " * 20_000 + "a b c")]
    assert len(sentences) > 200
    got = S.drop_sentences(spark.createDataFrame(rows, PAGES), spark.createDataFrame(table, "sentence_no long, sentence string"))
    assert sorted(((r.doc_id, r.page, r.page_text, len(r.dropped)) for r in got.collect()), key=repr) == dropped(rows, table)


def test_no_sentences_or_no_pages(spark):
    pages, none = spark.createDataFrame([(1, 0, "a  b ")], PAGES), spark.createDataFrame([], "sentence_no long, sentence string")
    assert [(r.page_text, r.dropped) for r in S.drop_sentences(pages, none).collect()] == [("a  b ", [])]
    assert S.drop_sentences(pages.limit(0), none).collect() == []
