"""Kneser-Ney models against a naive one, shards against one model, and accuracy on held-out documents."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from drillspark.llm import language
from drillspark.llm.common import unpacked

WORDS = {"en": ["the", "and", "thing", "with", "house", "other"], "fr": ["le", "eau", "qui", "dans", "été", "même"]}


@pytest.fixture(scope="module")
def train(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(WORDS[x]) for _ in range(40)), x) for i, x in enumerate(["en", "fr", "en"] * 60)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


class Naive:
    """Interpolated Kneser-Ney over dictionaries."""

    def __init__(self, texts, symbols):
        grams = Counter(s[i : i + 4] for s in texts for i in range(len(s) - 3))
        self.counts, self.base = {4: grams}, 1 / symbols
        for m in (3, 2, 1):
            self.counts[m] = Counter(g[1:] for g in self.counts[m + 1])
        self.discount, self.total, self.kinds = {}, defaultdict(float), Counter()
        for m, own in self.counts.items():
            ones, twos = (sum(n == k for n in own.values()) for k in (1, 2))
            self.discount[m] = ones / (ones + 2 * twos) if ones and twos else 0.5
            for g, n in own.items():
                self.total[m, g[:-1]] += n
                self.kinds[m, g[:-1]] += 1

    def p(self, gram):
        m = len(gram)
        if not m:
            return self.base
        lower, context = self.p(gram[1:]), (m, gram[:-1])
        if context not in self.total:
            return lower
        return (max(self.counts[m][gram] - self.discount[m], 0) + self.discount[m] * self.kinds[context] * lower) / self.total[context] if gram in self.counts[m] else self.discount[m] * self.kinds[context] / self.total[context] * lower


def shown(text):
    return "   " + text + " "


def test_models_equal_naive_ones(spark, train):
    model = language.learn(train)
    cfg = language.LanguageModel()
    learned = language._learnable(train, cfg).where("pmod(xxhash64(doc_id), 8) != 0").collect()
    texts = {x: [shown(r["text"]) for r in learned if r["lang"] == x] for x in ("en", "fr")}
    symbols = len({c for t in texts.values() for s in t for c in s[3:]}) + 1
    naive = {x: Naive(t, symbols) for x, t in texts.items()}
    probes = ["the house", "été dans", "qx zz thé", "le thing"]
    total, chars, _ = unpacked(model.shards[0]).entropies(pa.array(probes))
    for text, row, n in zip(probes, total, chars):
        s = shown(text)
        assert n == len(s) - 3
        for j, lang in enumerate(model.langs):
            assert row[j] == pytest.approx(-sum(math.log2(naive[lang].p(s[i : i + 4])) for i in range(len(s) - 3)), rel=1e-4)


def test_shards_change_nothing(spark, train, docs):
    whole, cut = language.learn(train), language.learn(train, language.LanguageModel(shard_bytes=1500))
    assert len(whole.shards) == 1 and len(cut.shards) > 3 and np.allclose(whole.bounds, cut.bounds)
    rows = docs.select("doc_id", "text").union(train.select("doc_id", "text"))
    key = lambda r: (str(r["doc_id"]), r["lang_pred"], r["rejected"], round(r["score"], 6))
    assert sorted(map(key, language.identify(rows, whole).collect())) == sorted(map(key, language.identify(rows, cut).collect()))


def test_known_language_keeps_columns(spark, train, docs):
    wide = train.selectExpr("doc_id", "text", "lang", "'x' AS sums", "1 AS doc", "2 AS score")
    out = language.known_language(wide)
    assert out.columns == wide.columns and out.count() == 180 and {r["sums"] for r in out.collect()} == {"x"}
    assert language.known_language(docs.where("lang is null")).count() == 0


def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.identify(docs, language.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null and lang_pred != 'und'")
    n = out.count()
    assert n > 150 and out.where("lang = lang_pred").count() >= 0.98 * n
