import pytest
from test_decontaminate import brute as leaks
from test_jaccard_join import brute as duplicates
from test_bpe import digests
from tokenizers import Tokenizer

import corpus_pipeline as cp
from folio.llm import bpe, langid, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stage = dict(cp.STAGES)
    assert list(stage) == ["language", "toxicity", "near_duplicates", "decontamination", "bpe"]
    rows = lambda df: sorted((r["doc_id"], r["text"]) for r in df.collect())

    first = cp.written(stage["language"](spark, docs, SF), "t1")
    gone = {r["doc_id"] for r in langid.identify(docs, langid.fit(docs)).filter("rejected").collect()}
    assert first.columns == docs.columns
    assert rows(first) == [r for r in rows(docs) if r[0] not in gone]

    second = cp.written(stage["toxicity"](spark, first, SF), "t2")
    machine = toxicity.fit(first, spark.read.parquet(f"{SF}/labels.parquet"))
    gone = {r["doc_id"] for r in toxicity.score_toxicity(first, machine).filter("predicted = 1").collect()}
    assert second.columns == docs.columns
    assert rows(second) == [r for r in rows(first) if r[0] not in gone]

    third = cp.written(stage["near_duplicates"](spark, second, SF), "t3")
    kept = {d for d, c, _, _ in duplicates(rows(second)) if d == c}
    assert third.columns == docs.columns
    assert rows(third) == [r for r in rows(second) if r[0] in kept] and len(kept) < second.count()

    fourth = cp.written(stage["decontamination"](spark, third, SF), "t4")
    held = {x[0] for x in leaks(rows(third), items)}
    assert fourth.columns == docs.columns
    assert rows(fourth) == [r for r in rows(third) if r[0] not in held]

    library = Tokenizer.from_file(bpe.tokenizer_path())
    want = sorted((i, *digests(library, t)) for i, t in rows(fourth))
    got = lambda df: sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in df.collect())
    assert got(stage["bpe"](spark, fourth, SF)) == want
    assert got(cp.run(spark, SF)) == want


@pytest.mark.parametrize("name", ["language", "toxicity", "near_duplicates", "decontamination"])
def test_stages_on_odd_rows(spark, name):
    text = "the and of that in a the and of that in a the"
    rows = [(1, text), (1, text), (2, text + " more"), (None, text), (None, None), (3, None), (4, ""), (5, "123"), (6, "short"), (6, "quite different words are in here")]
    df = spark.createDataFrame([(i, t, "en", "s", 1, "extra") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, node string")
    out = dict(cp.STAGES)[name](spark, df, SF)
    assert out.columns == df.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert all(r in rows for r in kept) and (1, text) in kept
    if name == "near_duplicates":
        assert kept.count((1, text)) == 1 and (None, text) not in kept and (2, text + " more") not in kept
        assert len([i for i, _ in kept if i == 6]) == 2  # one id, two different texts: judged each by itself
    if name == "language":
        assert not {(None, None), (3, None), (4, ""), (5, "123")} & set(kept) and (None, text) in kept
    if name in ("toxicity", "decontamination"):
        assert sorted(map(str, kept)) == sorted(map(str, rows))
    assert dict(cp.STAGES)[name](spark, df.filter("false"), SF).count() == 0


@pytest.mark.parametrize("name", ["language", "toxicity", "near_duplicates", "decontamination", "bpe"])
def test_stages_with_any_columns_and_long_texts(spark, name):
    """Columns of any name and type, among them maps and names that joins use; a very long text."""
    text = "the and of that in a the and of that in a the"
    rows = [(1, text), (2, text), (3, "and the of in that " * 200_000), (None, text + " but it was not the same as that")]
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string").selectExpr(
        "doc_id", "text", "'en' as lang", "1 as _id", "2L as row", "3L as _row", "map('k', 'v') as class_id", "named_struct('a', 1) as id", "array(1) as item_id", "'s' as node"
    )
    out = dict(cp.STAGES)[name](spark, df, SF)
    if name != "bpe":
        assert out.dtypes == df.dtypes
    kept = sorted(str(r["doc_id"]) for r in out.collect())
    assert kept == (["1", "3", "None"] if name == "near_duplicates" else ["1", "2", "3", "None"])


def test_stages_without_labels_or_items(spark, tmp_path):
    text = "the and of that in a the and of that in a the"
    df = spark.createDataFrame([(i, text + f" {i}" * 9, "en") for i in range(4)], "doc_id long, text string, lang string")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name in ("toxicity", "decontamination"):
        assert dict(cp.STAGES)[name](spark, df, str(tmp_path)).count() == 4


def test_rows_of_one_id_are_judged_each_by_itself(spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    df = spark.createDataFrame([(1, items[0]["text"]), (1, "a clean text of a few words that no item holds"), (2, "another clean text")], "doc_id long, text string")
    out = cp.decontaminated(spark, df, SF).collect()
    assert sorted(r["text"][:7] for r in out) == ["a clean", "another"]
