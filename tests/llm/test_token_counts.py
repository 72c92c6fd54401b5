import random

import pytest

from folio.llm import token_counts as tc


@pytest.fixture(scope="module")
def counts():
    with open(tc.tokenizer_path(), "rb") as f:
        return tc.Counts(f.read(), tc.pattern())


def whole(counts, text):
    return len(counts.encoding.encode_ordinary(text))


def test_random_edits_equal_full_count(counts):
    r = random.Random(4)
    alphabet = ["the ", "don't", "'ll", "'", "  ", "\n\n", "12", "é", "!?", " x", "\t", "we're", " ", "漢字", "word"]
    for _ in range(150):
        tree = tc.DocumentTree("".join(r.choice(alphabet) for _ in range(r.choice([0, 3, 40, 600]))), counts)
        assert tree.n_tokens == whole(counts, tree.text)
        for _ in range(12):
            place, gone = r.randint(0, len(tree.text) + 3), r.choice([0, 1, 5, 200])
            new = "".join(r.choice(alphabet) for _ in range(r.choice([0, 1, 4, 500])))
            want = tree.text[: min(place, len(tree.text))] + new + tree.text[min(place, len(tree.text)) + gone :]
            tree.edit(place, gone, new)
            assert tree.text == want
            assert tree.n_tokens == whole(counts, want)
            assert "".join(counts.split.findall(want)) == want and tree.n_pre_tokens == len(counts.split.findall(want))


def test_an_edit_recounts_its_region_only(counts):
    tree = tc.DocumentTree("some plain words here. " * 2000, counts)
    tree.edit(20_000, 5, "other")
    assert tree.recounted < 15


def test_query_equals_full_encoding(spark, counts):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    source = {r["doc_id"]: (r["text"], r["edits"]) for r in tc.derived_edits(docs).collect()}
    rows = tc.op3_token_counts(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(source)
    for r in rows:
        text, edits = source[r["doc_id"]]
        assert r["n_tokens_before"] == whole(counts, text)
        assert r["n_edits"] == -(-len(text) // tc.EDIT_EVERY)
        for e in sorted(enumerate(edits), key=lambda x: (x[1]["place"], x[0]), reverse=True):
            p = min(e[1]["place"], len(text))
            text = text[:p] + e[1]["inserted"] + text[p + e[1]["removed"] :]
        assert r["n_tokens"] == whole(counts, text)


def test_edge_rows(spark, counts):
    edit = "array<struct<place:long,removed:long,inserted:string>>"
    rows = [(1, None, None), (2, "", [(0, 0, "new")]), (None, "abc", [(9, 5, None), None]), (3, "abc def", [(None, 3, "x")]), (4, "a " * 50_000, [(50_000, 10, "zz")])]
    got = {r["doc_id"]: r for r in tc.count_edited(spark.createDataFrame(rows, f"doc_id long, text string, edits {edit}")).collect()}
    assert (got[1]["n_tokens_before"], got[1]["n_tokens"], got[1]["n_edits"]) == (0, 0, 0)
    assert got[2]["n_tokens"] == whole(counts, "new")
    assert (got[None]["n_tokens"], got[None]["n_edits"]) == (whole(counts, "abc"), 1)
    assert got[3]["n_tokens"] == whole(counts, "x def")
    text = "a " * 50_000
    assert got[4]["n_tokens"] == whole(counts, text[:50_000] + "zz" + text[50_010:])
    assert tc.count_edited(spark.createDataFrame([], f"doc_id long, text string, edits {edit}")).count() == 0
