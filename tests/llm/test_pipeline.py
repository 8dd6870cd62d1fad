"""Each stage of the pipeline on what the one before left, and on awkward rows."""

import corpus_pipeline
from tabproof.llm.exact_dedup import exact_duplicates
from tabproof.llm.mixing import mix_sources
from tabproof.llm.near_dedup import near_duplicates
from tabproof.llm.quality import classify_quality

SF = "/root/testdata/sf0.001"


def test_stages_apply_their_decisions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "exact_dedup", "near_dedup", "mixing", "bpe"]
    decided = {
        "quality": lambda d: classify_quality(d).where("kept"),
        "exact_dedup": lambda d: exact_duplicates(d).where("kept"),
        "near_dedup": lambda d: near_duplicates(d).where("kept"),
    }
    for name, stage in corpus_pipeline.STAGES[:3]:
        left = stage(spark, docs, SF)
        assert left.columns == docs.columns
        left.write.parquet(str(tmp_path / name))
        expected = sorted(r["doc_id"] for r in decided[name](docs).collect())
        docs = spark.read.parquet(str(tmp_path / name))
        assert sorted(r["doc_id"] for r in docs.collect()) == expected
    copies = {r["doc_id"]: r["copies"] for r in mix_sources(docs).collect() if r["copies"]}
    corpus_pipeline.STAGES[3][1](spark, docs, SF).write.parquet(str(tmp_path / "mix"))
    mixed = spark.read.parquet(str(tmp_path / "mix"))
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == copies
    tokens = corpus_pipeline.STAGES[4][1](spark, mixed, SF)
    assert tokens.count() == sum(copies.values())


def test_rows_are_judged_by_their_own_text(spark, words):
    """A bad text under the id of a good one goes, as does one without id; good ones stay."""
    good = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").join(
        spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1"), "doc_id").orderBy("doc_id").limit(40).collect()]
    bad = ["@@@ ### $$$ !!! %%% &&& " * 20, "1 2 3 4 5 6 7 8 9 " * 30]
    rows = [(i if i % 2 else None, t, "en", "a", 1) for i, t in enumerate(good)]
    rows += [(1, bad[0], "en", "a", 1), (None, bad[1], "en", "a", 1), (3, None, "en", "a", 1), (5, "", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    scores = {}
    for r, (_, text, *_) in zip(classify_quality(docs.coalesce(1)).collect(), rows, strict=True):
        scores[text] = r["kept"]
    assert sorted(r["text"] for r in kept.collect()) == sorted(t for _, t, *_ in rows if scores[t])
    assert not any(scores[t] for t in (*bad, None, ""))


def test_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = empty
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0, name
    rows = [(1, "the same text in every row of this table", "en", "a", 1)] * 4
    docs = spark.createDataFrame(rows, empty.schema)
    assert corpus_pipeline.STAGES[1][1](spark, docs, SF).count() == 1
