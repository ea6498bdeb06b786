"""Languages with few spared texts reject too."""

import random

import numpy as np
from drillspark.llm import language


def test_few_spared_texts_still_reject(spark):
    rnd = random.Random(1)
    words = {"en": ["the", "and", "thing", "with", "house"], "fr": ["le", "eau", "qui", "dans", "été"]}
    known = [(i, " ".join(rnd.choice(words[x]) for _ in range(60)), x) for i, x in enumerate(["en"] * 400 + ["fr"] * 60)]
    model = language.learn(spark.createDataFrame(known, "doc_id bigint, text string, lang string"))
    assert model.langs == ["en", "fr"] and np.isfinite(model.bounds).all()
    junk = spark.createDataFrame([(1, "éqxj kvéw " * 50), (2, "zqxj kvwy " * 50), (3, known[-1][1])], "doc_id bigint, text string")
    assert {r["doc_id"]: r["rejected"] for r in language.identify(junk, model).collect()} == {1: True, 2: True, 3: False}
