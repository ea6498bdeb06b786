"""The label model against a naive one, and toxicity on held-out documents."""

import math

import numpy as np
from drillspark.llm import toxicity


def naive(fires, votes, balance, weights, rounds):
    """Expectation and maximisation with plain loops; weights are given, for they do not change here."""
    n, m = len(fires), len(votes)
    lead = range(m - len(toxicity.PATTERNS), m) if m > len(toxicity.PATTERNS) else range(m)
    post = [0.9 if sum((1 if votes[j] else -1) for j in lead if fires[i][j]) > 0 else 0.1 for i in range(n)]
    for _ in range(rounds):
        odds = []
        for j in range(m):
            one = (sum(post[i] for i in range(n) if fires[i][j]) + 0.5) / (sum(post) + 1)
            zero = (sum(1 - post[i] for i in range(n) if fires[i][j]) + 0.5) / (n - sum(post) + 1)
            x = max(-4.0, min(4.0, math.log(one / zero)))
            odds.append(max(x, 0) if votes[j] else min(x, 0))
        z = [math.log(balance / (1 - balance)) + sum(weights[j] * odds[j] for j in range(m) if fires[i][j]) for i in range(n)]
        post = [1 / (1 + math.exp(-max(-30, min(30, v)))) for v in z]
    return post


def test_label_model_is_the_naive_one():
    rng = np.random.default_rng(4)
    y = rng.random(200) < 0.3
    votes = np.array([1, 1, 1, 0, 0])
    fires = np.column_stack([rng.random(200) < np.where(y, p, q) for p, q in ((0.8, 0.1), (0.5, 0.05), (0.4, 0.3), (0.1, 0.7), (0.2, 0.5))])
    posterior, accuracy, weights = toxicity.label_model(fires, votes, 0.3, rounds=5)
    assert np.allclose(posterior, naive(fires.tolist(), votes.tolist(), 0.3, weights.tolist(), 5), atol=1e-9)
    assert ((posterior >= 0.5) == y).mean() > 0.9 and accuracy[0] > accuracy[2]


def test_repeated_voters_share_one_vote():
    rng = np.random.default_rng(0)
    y = rng.random(2000) < 0.3
    good = rng.random(2000) < np.where(y, 0.9, 0.1)
    fires = np.column_stack([good, good, good, rng.random(2000) < np.where(y, 0.6, 0.05), rng.random(2000) < np.where(y, 0.1, 0.8)])
    posterior, _, weights = toxicity.label_model(fires, np.array([1, 1, 1, 1, 0]), 0.3)
    assert weights[0] < 0.5 < weights[3] and ((posterior > 0.5) == y).mean() > 0.85


def test_recall_and_precision_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out")
    counts = {(r["toxic"], r["predicted"]): r["count"] for r in out.groupBy("toxic", "predicted").count().collect()}
    right = counts[1, 1]
    assert right >= 0.9 * (right + counts[1, 0]) and right >= 0.95 * (right + counts.get((0, 1), 0))
