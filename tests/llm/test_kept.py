"""The size of what op3 leaves, in the unit of the documents' own size."""

from __future__ import annotations

from salesmart.llm.suffix_dedup import op3_suffix_dedup


def test_kept_characters_are_those_of_documents(spark, tmp_path):
    passage = " ".join(f"Stück{k} für alle" for k in range(60))
    texts = ["Ünïcode für sich", passage + " eins", "zwei " + passage, "", None]
    rows = [(k, t, None if t is None else len(t)) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in op3_suffix_dedup(spark, str(tmp_path)).collect()}
    assert [found[k]["n_kept"] for k in range(5)] == [len(texts[0]), len(" eins"), len("zwei "), 0, 0]
    assert found[0]["n_bytes"] == len(texts[0].encode()) and found[0]["n_removed"] == 0


def test_the_text_that_is_left_is_returned(spark, tmp_path):
    passage = " ".join(f"Stück{k} für alle" for k in range(60))
    short = " ".join(f"w{k}" for k in range(60))
    texts = ["Ünïcode für sich", passage + " eins", "zwei " + passage, short + " a", short + " b", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r["text"] for r in op3_suffix_dedup(spark, str(tmp_path)).collect()}
    # 60 words that repeat but take fewer than 400 bytes stay.
    assert [found[k] for k in range(7)] == [texts[0], " eins", "zwei ", texts[3], texts[4], "", None]
