"""Pairs that meet only in buckets of two, of documents that have looser versions with smaller ids."""

import random

from drillspark.llm import near_dedup


def family(rnd, f, versions, loose, close):
    """Looser versions of a text first, then a close one, then the text: 200 shingles each."""
    text = [f"f{f}w{i}" for i in range(204)]

    def edited(n, tag):
        new = [f"{tag}{i}" for i in range(n)]
        return new + text[n:] if rnd.random() < 0.5 else text[:-n] + new

    return [edited(loose, f"f{f}v{j}x") for j in range(versions)] + [edited(close, f"f{f}u"), text]


def test_links_beyond_the_first_leaders(spark):
    rnd = random.Random(5)
    texts = [w for f in range(60) for w in family(rnd, f, 5, 65, 26)]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in texts]
    least = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i - i % 7, i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = least[i], least[j]
                least = [min(a, b) if x in (a, b) else x for x in least]
    assert sum(i != x for i, x in enumerate(least)) >= 60
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id bigint, text string")
    out = {r["doc_id"]: r["component_id"] for r in near_dedup.near_dedup(docs).collect()}
    assert out == dict(enumerate(least))
