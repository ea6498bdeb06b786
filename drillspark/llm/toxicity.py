"""Operator 7, toxicity by weak supervision.

Many voters speak for or against a text: a lexicon (words, each a voter), stems that words begin with, and patterns of how often
such words occur. Labelled rows only say which words and stems a voter may look for, and so which way it votes. A generative
label model then estimates from votes alone how accurate each voter is and which ones repeat each other, and a linear
classifier is trained on its posterior labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, ship, store, text_slices, unpacked, words_of


@dataclass(frozen=True)
class Toxicity:
    #: Labels of rows whose crc32(doc_id) has this remainder are never read.
    folds: int = 3
    held_out: int = 1
    #: About so many labelled texts are learned from; this bounds what is broadcast and what comes to the driver.
    sample: int = 20_000
    #: So many words and stems have a voter: those that cover most labelled texts.
    voters: int = 400
    stems: tuple[int, ...] = (3, 4, 5, 6, 7, 8)
    least_texts: int = 3
    #: Of the labelled texts that a word or stem of a voter stands in, at least this share are toxic.
    precision: float = 0.5
    threshold: float = 0.7


#: Words that are insults wherever they stand; each is a voter without any labelled text.
LEXICON = (
    "idiot moron imbecile stupid dumb fool loser clown scum trash garbage vermin worthless pathetic disgusting "
    "connard salaud ordure abruti crétin débile minable pourriture "
    "idiotisch dummkopf trottel abschaum widerlich erbärmlich wertlos schwachkopf "
    "imbécil estúpido basura escoria patético asqueroso inútil cretino"
).split()


@dataclass(frozen=True)
class Pattern:
    """A voter on how many words of a text are in the lexicon or begin with a stem: ``vote`` is 1 or 0 where the share lies in [least, below)."""

    vote: int
    least: float
    below: float = 2.0


#: Voters of words and stems abstain where such words are a smaller share of the text, for in passing they say nothing.
PASSING = 0.006
#: Shares of words.
PATTERNS = (Pattern(0, 0.0, 1e-9), Pattern(0, 1e-9, 0.004), Pattern(0, 0.004, 0.008), Pattern(1, 0.012, 0.02), Pattern(1, 0.02, 0.03), Pattern(1, 0.03))


def _bare(word: str) -> str:
    word = word.lower()
    a, b = 0, len(word)
    while a < b and not word[a].isalpha():
        a += 1
    while b > a and not word[b - 1].isalpha():
        b -= 1
    return word[a:b]


def _signs(word: str, stems: tuple[int, ...]) -> list[str]:
    """What voters may look for in a word: the whole word, or a stem that it begins with."""
    word = _bare(word)
    return [f"={word}", *(f"^{word[:k]}" for k in stems if len(word) >= k)] if word else []


def _signs_of(cfg: Toxicity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            words, offsets = words_of(part.column("text"))
            coded = words.dictionary_encode()
            signs, codes = [_signs(w, cfg.stems) for w in coded.dictionary.to_pylist()], coded.indices.to_numpy()
            lists = [sorted({s for c in np.unique(codes[a:b]).tolist() for s in signs[c]}) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(lists, pa.list_(pa.string()))], ["toxic", "signs"])

    return run


def _fired(texts: pa.Array, voters: dict[str, int], stems: tuple[int, ...]) -> tuple[list[list[int]], np.ndarray]:
    """For each text the voters of words and stems that fire, and the share of its words that made one fire."""
    words, offsets = words_of(texts)
    out: list[list[int]] = [[] for _ in range(len(texts))]
    if not len(words) or not voters:
        return out, np.zeros(len(texts))
    coded = words.dictionary_encode()
    hits = [[voters[s] for s in _signs(w, stems) if s in voters] for w in coded.dictionary.to_pylist()]
    codes = coded.indices.to_numpy()
    places = np.flatnonzero(np.fromiter(map(bool, hits), bool, len(hits))[codes])
    docs = np.searchsorted(offsets, places, "right") - 1
    found: dict[int, set[int]] = {}
    for d, c in zip(docs.tolist(), codes[places].tolist(), strict=True):
        found.setdefault(d, set()).update(hits[c])
    share = np.bincount(docs, minlength=len(texts)) / np.maximum(np.diff(offsets), 1)
    for d, s in found.items():
        if share[d] >= PASSING:
            out[d] = sorted(s)
    return out, share


def _vote(shared, cfg: Toxicity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            fired, share = _fired(part.column("text"), unpacked(shared), cfg.stems)
            yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(fired, pa.list_(pa.int32())), pa.array(share)], ["toxic", "votes", "share"])

    return run


def patterns_of(share: np.ndarray) -> np.ndarray:
    """Which pattern voters fire, a column for each."""
    return np.column_stack([(share >= p.least) & (share < p.below) for p in PATTERNS])


def label_model(fires: np.ndarray, votes: np.ndarray, balance: float, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior labels, voters' accuracies (how often what a voter says is so) and their weights, from votes alone.

    ``votes`` has for each column of ``fires`` the label that it speaks for; a voter that does not fire abstains, which says
    nothing. ``balance`` is the share of texts with label 1, which votes cannot tell. Expectation and maximisation start at the
    mean vote of the patterns (or of all voters where there are none). Voters whose votes are correlated given the label share
    one vote.
    """
    n, m = fires.shape
    x = fires.astype(np.float64)
    signed = np.where(votes == 1, 1.0, -1.0)
    lead = np.arange(m) >= m - len(PATTERNS) if m > len(PATTERNS) else np.ones(m, bool)
    posterior = np.where(x[:, lead] @ signed[lead] > 0, 0.9, 0.1)
    weights, accuracy = np.ones(m), np.full(m, 0.5)
    for turn in range(rounds):
        # how often a voter fires where the label is 1, and where it is 0
        one = (posterior @ x + 0.5) / (posterior.sum() + 1)
        zero = ((1 - posterior) @ x + 0.5) / ((1 - posterior).sum() + 1)
        if turn % 5 == 0:
            weights = 1.0 / np.maximum(1.0, _related(x, posterior, one, zero).sum(1))
        odds = np.clip(np.log(one / zero), -4, 4)
        # a voter speaks for its label or not at all
        odds = np.where(votes == 1, np.maximum(odds, 0), np.minimum(odds, 0))
        logit = np.log(balance / (1 - balance)) + x @ (weights * odds)
        posterior = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    fired = x.sum(0)
    right = np.where(votes == 1, posterior @ x, (1 - posterior) @ x)
    accuracy = (right + 0.5) / (fired + 1)
    return posterior, accuracy, weights


def _related(x: np.ndarray, posterior: np.ndarray, one: np.ndarray, zero: np.ndarray) -> np.ndarray:
    """How much of each other's variance voters share once the label is known; a voter all of its own."""
    rest = x - posterior[:, None] * one - (1 - posterior)[:, None] * zero
    cov = rest.T @ rest
    scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    related = np.clip(cov / np.outer(scale, scale), 0, 1) ** 2
    np.fill_diagonal(related, 1.0)
    return related


def _features(signs: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Votes of words and stems, votes of patterns, how many words speak, and one."""
    return np.column_stack([signs, patterns_of(share), np.minimum(share, 0.05) * 100, np.ones(len(share))]).astype(np.float64)


def linear_classifier(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Logistic regression on soft labels by Newton's method."""
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty) + 1e-9 * np.eye(len(w)), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass(frozen=True)
class Scorer:
    voters: dict
    weights: np.ndarray
    accuracies: np.ndarray
    stems: tuple[int, ...]
    #: Share of labelled texts on which the label model, which has seen no label, says what their label says.
    agreement: float = 0.0

    def score(self, texts: pa.Array) -> np.ndarray:
        fired, share = _fired(texts, self.voters, self.stems)
        m = len(self.voters)
        z = np.fromiter((self.weights[f].sum() for f in fired), np.float64, len(fired)) + _features(np.empty((len(fired), 0)), share) @ self.weights[m:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def learn(docs: DataFrame, labels: DataFrame, cfg: Toxicity = Toxicity()) -> Scorer:
    """Voters, label model and classifier from labelled rows outside the held-out fold."""
    spark = docs.sparkSession
    bounded_batches(spark)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % cfg.folds
    known = labels.where(F.col("toxic").isNotNull() & (fold != cfg.held_out)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    every = -(-known.count() // cfg.sample) or 1
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    rows = store(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "labelled")
    sizes = rows.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    n, n_toxic = sizes[0], sizes[1] or 0
    if not n_toxic or n_toxic == n:
        return Scorer({}, np.array([0.0] * (len(PATTERNS) + 1) + [-4.0]), np.empty(0), cfg.stems)
    least = max(cfg.least_texts, n_toxic // 50)
    signs = rows.mapInArrow(_signs_of(cfg), "toxic int, signs array<string>").select("toxic", F.explode("signs").alias("sign"))
    found = signs.groupBy("sign").agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("all")).where((F.col("bad") >= least) & (F.col("bad") >= F.col("all") * cfg.precision))
    # the voters that cover most; ties by name, so every run has the same
    best = found.orderBy(F.desc(F.col("bad") * F.col("bad") / F.col("all")), "sign").limit(cfg.voters).collect()
    names = dict.fromkeys([*(f"={w}" for w in LEXICON), *(r["sign"] for r in best)])
    voters = {sign: i for i, sign in enumerate(names)}
    votes = rows.mapInArrow(_vote(ship(spark, voters), cfg), "toxic int, votes array<int>, share double").toArrow().to_pydict()
    share, gold = np.array(votes["share"]), np.array(votes["toxic"])
    fires = np.zeros((n, len(voters)), bool)
    for i, v in enumerate(votes["votes"]):
        fires[i, v] = True
    said = np.array([1] * len(voters) + [p.vote for p in PATTERNS])
    posterior, accuracies, _ = label_model(np.column_stack([fires, patterns_of(share)]), said, n_toxic / n)
    agreement = float(((posterior >= 0.5) == (gold == 1)).mean())
    return Scorer(voters, linear_classifier(_features(fires, share), posterior), accuracies, cfg.stems, agreement)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(unpacked(shared).score(part.column("text")))], ["doc_id", "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, cfg: Toxicity = Toxicity()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text), learned from ``labels`` (doc_id, toxic).

    A null or empty text has no votes and the score of such texts. Several labels of one document count as the worst. Without
    usable labels every score is low. Repeated rows have repeated results; a row without doc_id counts as held out.
    """
    shared = ship(docs.sparkSession, learn(docs, labels, cfg))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % cfg.folds
    out = docs.select("doc_id", "text").mapInArrow(_score(shared), "doc_id bigint, score double")
    return out.select("doc_id", F.coalesce(fold == cfg.held_out, F.lit(True)).alias("held_out"), "score", (F.col("score") >= cfg.threshold).cast("int").alias("predicted"))
