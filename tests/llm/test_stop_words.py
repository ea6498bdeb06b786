"""The stop-word ratio counts every occurrence and is one of words."""

from drillspark.llm import quality


def test_stop_word_occurrences_of_all_words(spark):
    texts = [" ".join([f"word{i}" for i in range(200)] + ["the", "of"]), " ".join([f"word{i}" for i in range(200)] + ["the", "of", "The", "and", "the"]), " ".join([f"word{i}" for i in range(96)] + ["the one", "the two"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = {r["doc_id"]: (r["n_stop_words"], r["kept"]) for r in quality.quality(docs).collect()}
    assert out == {0: (2, False), 1: (5, True), 2: (2, True)}
