"""Operator 8, language ID: interpolated Kneser-Ney character models, one a language, stored in sorted hash arrays.

N-grams of all training texts are counted by Spark, and none is pruned; discounts and continuation counts come from all of
them. The models' keys are sorted by hash, so a bucket of the hash's leading bits leads to a key in a few vectorised probes.
Models beyond a size are cut into shards, which documents pass one after another. The language with the lowest cross-entropy
per character wins; a calibrated bound, wider for short texts, rejects what none of the models fits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_string, bounded_batches, giving_back, mix64, ship, store, text_slices, unpacked


@dataclass(frozen=True)
class LanguageModel:
    #: Texts whose crc32(doc_id) has this remainder are never learned from.
    folds: int = 4
    held_out: int = 2
    #: About so many bytes of n-grams are broadcast at once. Larger models have more shards; results are the same.
    shard_bytes: int = 128_000_000
    #: One learnable text in so many is kept out of the counts; these set the bounds of rejection.
    spared: int = 8
    slack: float = 1.4
    #: Shorter texts are too little evidence to reject.
    evidence: int = 20


ORDER = 4
GRAMS = "lang string, gram bigint, n bigint"
_BLOCK = 1 << 16
#: Bytes of text taken at once: a character takes some 40 bytes meanwhile.
_SLICE = 1_000_000
_letters: list[np.ndarray] = []


def _letter_ids() -> np.ndarray:
    """For each code point 16 bits that stand for it: 0 for all but letters."""
    if not _letters:
        points = np.arange(0x32400, dtype=np.uint32)
        letter = np.fromiter((chr(i).isalpha() for i in points.tolist()), bool, len(points))
        folded = np.where(points < 0x10000, points, (points * np.uint32(2654435761)) >> np.uint32(16) | 1)
        _letters.append(np.where(letter, folded, 0).astype(np.uint16))
    return _letters[0]


def coded_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts as letters in lower case with single blanks between: ids with ORDER - 1 blanks before each text, its offsets, and its letters' number."""
    lower = pc.utf8_lower(as_string(texts))
    points = np.frombuffer("".join(lower.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    ids = np.where(points < 0x32400, _letter_ids()[np.minimum(points, 0x323FF)], 0).astype(np.uint16)
    ends = np.concatenate([[0], np.cumsum(pc.utf8_length(lower).to_numpy())]).astype(np.int64)
    doc = np.repeat(np.arange(len(ends) - 1, dtype=np.int32), np.diff(ends))
    # a blank stays only after a letter of the same text
    keep = (ids > 0) | np.concatenate([[False], (ids[:-1] > 0) & (doc[1:] == doc[:-1])])[: len(ids)]
    letters = np.bincount(doc[ids > 0], minlength=len(ends) - 1)
    ids, doc = ids[keep], doc[keep]
    sizes = np.bincount(doc, minlength=len(ends) - 1) + ORDER  # and a blank at the end
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(offsets[-1], np.uint16)
    out[np.arange(len(ids)) + doc.astype(np.int64) * ORDER + (ORDER - 1)] = ids
    return out, offsets, letters


def _grams(ids: np.ndarray) -> np.ndarray:
    """The run of ORDER ids that ends at each place from ORDER - 1 on, packed into 64 bits."""
    out = ids[: len(ids) - ORDER + 1].astype(np.uint64)
    for i in range(1, ORDER):
        out = out << np.uint64(16) | ids[i : len(ids) - ORDER + 1 + i]
    return out


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}
    for part in text_slices(batches, most=_SLICE):
        ids, offsets, _ = coded_texts(part.column("text"))
        langs = part.column("lang").to_pylist()
        for lang in set(langs):
            runs = [_grams(ids[offsets[i] : offsets[i + 1]]) for i, x in enumerate(langs) if x == lang]
            codes = np.sort(np.concatenate(runs))
            first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            found = (codes[first], np.diff(np.append(first, len(codes))))
            old = held.get(lang)
            held[lang] = _summed(np.concatenate([old[0], found[0]]), np.concatenate([old[1], found[1]])) if old else found
    for lang, (keys, n) in held.items():
        yield from pa.table({"lang": pa.array([lang] * len(keys)), "gram": keys.view(np.int64), "n": n.astype(np.int64)}).to_batches(max_chunksize=100_000)


#: Shards hold whole slots; the slot of an n-gram is that of its second and third character, which all it is discounted against share.
SLOTS = 1021


def _slot(codes: np.ndarray) -> np.ndarray:
    return ((codes >> np.uint64(16)) & np.uint64(0xFFFFFFFF)) % np.uint64(SLOTS)


class KneserNey:
    """One language's interpolated model over packed grams: for each order sorted grams with probabilities, sorted contexts with back-off weights.

    ``grams`` are sorted and may be those of a shard; ``pairs`` are all runs of two with their continuation counts.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray, pairs: np.ndarray, pair_counts: np.ndarray, discounts: dict[int, float], symbols: int):
        self.levels = []
        # lower orders count in how many contexts a run of characters has been seen
        three = _summed(grams & np.uint64((1 << 48) - 1), np.ones(len(grams)))
        one = _summed(pairs & np.uint64(0xFFFF), np.ones(len(pairs)))
        self.base = 1.0 / symbols
        for m, (keys, n) in enumerate((one, (pairs, pair_counts.astype(np.float64)), three, (grams, counts.astype(np.float64))), 1):
            context = keys >> np.uint64(16)
            contexts, total = _summed(context, n)
            kinds = _summed(context, np.ones(len(n)))[1]
            gamma = discounts[m] * kinds / total
            at = np.searchsorted(contexts, context)
            lower = self.probability(keys & np.uint64((1 << 16 * (m - 1)) - 1), m - 1)
            self.levels.append((keys, np.maximum(n - discounts[m], 0) / total[at] + gamma[at] * lower, contexts, gamma))

    def probability(self, codes: np.ndarray, m: int = ORDER) -> np.ndarray:
        if m == 0:
            return np.full(len(codes), self.base)
        keys, p, contexts, gamma = self.levels[m - 1]
        if not len(keys):
            return self.probability(codes & np.uint64((1 << 16 * (m - 1)) - 1), m - 1)
        lower = self.probability(codes & np.uint64((1 << 16 * (m - 1)) - 1), m - 1)
        context = codes >> np.uint64(16)
        c = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
        out = np.where(contexts[c] == context, gamma[c], 1.0) * lower
        k = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
        return np.where(keys[k] == codes, p[k], out)


class Shard:
    """All languages' models over some slots; known grams have their log-probabilities in one array sorted by hash."""

    def __init__(self, models: list[KneserNey], first: int, end: int):
        self.models, self.first, self.end = models, first, end
        known = np.unique(np.concatenate([m.levels[-1][0] for m in models]))
        hashes = mix64(known)
        order = np.argsort(hashes)
        self.hashes, known = hashes[order], known[order]
        self.bits = max(1, int(len(known)).bit_length())
        self.buckets = np.searchsorted(self.hashes, np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)).astype(np.int64)
        self.deepest = int(np.diff(np.append(self.buckets, len(known))).max(initial=0))
        self.bits_of = np.stack([-np.log2(m.probability(known)) for m in self.models], 1).astype(np.float32)

    def bits_for(self, codes: np.ndarray) -> np.ndarray:
        hashes = mix64(codes)
        at = self.buckets[(hashes >> np.uint64(64 - self.bits)).astype(np.int64)]
        for _ in range(self.deepest):
            short = self.hashes[np.minimum(at, len(self.hashes) - 1)] < hashes
            if not short.any():
                break
            at = at + short
        at = np.minimum(at, len(self.hashes) - 1)
        out = self.bits_of[at]
        unknown = np.flatnonzero(self.hashes[at] != hashes)
        if len(unknown):
            distinct, back = np.unique(codes[unknown], return_inverse=True)
            out[unknown] = np.stack([-np.log2(m.probability(distinct)) for m in self.models], 1).astype(np.float32)[back]
        return out

    def entropies(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bits of each text's characters in this shard's slots by language, the text's characters, and its letters."""
        ids, offsets, letters = coded_texts(texts)
        n = len(offsets) - 1
        total = np.zeros((n, len(self.models)))
        doc = np.repeat(np.arange(n, dtype=np.int32), np.diff(offsets))
        for a in range(0, len(ids), _BLOCK):
            # ORDER - 1 ids before the block give its first contexts
            block = ids[max(0, a - ORDER + 1) : a + _BLOCK]
            own = doc[max(0, a - ORDER + 1) + ORDER - 1 : a + _BLOCK]
            if len(block) < ORDER:
                continue
            codes = _grams(block)
            inside = np.arange(max(0, a - ORDER + 1) + ORDER - 1, max(0, a - ORDER + 1) + ORDER - 1 + len(codes)) - offsets[own] >= ORDER - 1
            if self.end - self.first < SLOTS:
                slot = _slot(codes)
                inside &= (slot >= self.first) & (slot < self.end)
            codes, own = codes[inside], own[inside]
            bits = self.bits_for(codes)
            low = int(own[0]) if len(own) else 0
            for j in range(len(self.models)):
                part = np.bincount(own - low, bits[:, j])
                total[low : low + len(part), j] += part
        return total, np.diff(offsets) - (ORDER - 1), letters


@dataclass
class Languages:
    """What ``learn`` gives: languages, their packed shards, and their bounds of rejection."""

    langs: list[str]
    shards: list
    bounds: np.ndarray
    evidence: int = 0


def decide(langs: list[str], bounds: np.ndarray, evidence: int, total: np.ndarray, chars: np.ndarray, letters: np.ndarray):
    """Language or und, a confidence from 0 to 1, the winner's cross-entropy, and whether it is rejected."""
    n = len(chars)
    if not langs:
        return ["und"] * n, np.zeros(n), np.full(n, np.nan), np.ones(n, bool)
    bits = total / np.maximum(chars, 1)[:, None]
    best = bits.argmin(1)
    least = bits[np.arange(n), best]
    # evidence of a few characters counts in full, then the confidence saturates
    odds = np.exp2(-(bits - least[:, None]) * np.minimum(chars, 40)[:, None])
    score = np.where(letters > 0, 1.0 / odds.sum(1), 0.0)
    level, width = bounds[best, 0], bounds[best, 1]
    rejected = (letters == 0) | (chars >= evidence) & (least > level + width / np.sqrt(np.maximum(chars, 1)))
    return [langs[b] if x else "und" for b, x in zip(best.tolist(), letters.tolist(), strict=True)], score, least, rejected


def _learnable(docs: DataFrame, cfg: LanguageModel) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % cfg.folds
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold != cfg.held_out)).select("doc_id", "text", "lang")


def learn(docs: DataFrame, cfg: LanguageModel = LanguageModel()) -> Languages:
    """Models from the learnable rows of ``docs`` (doc_id, text, lang)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = _learnable(docs, cfg).withColumn("_spared", F.pmod(F.xxhash64("doc_id"), F.lit(cfg.spared)) == 0)
    slot = F.shiftrightunsigned("gram", 16).bitwiseAND(F.lit(0xFFFFFFFF)) % SLOTS
    counts = rows.where("not _spared").select("text", "lang").mapInArrow(giving_back(_count), GRAMS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = store(counts.withColumn("slot", slot.cast("int")), "grams")
    # how often runs of three, two and one have been continued to the left
    shorter = lambda df, m: df.groupBy("lang", F.col("gram").bitwiseAND(F.lit((1 << 16 * m) - 1)).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    threes = shorter(counts, 3)
    pairs = store(shorter(threes, 2), "grams-of-two")
    orders = {4: counts, 3: threes, 2: pairs, 1: shorter(pairs, 1)}
    discounts: dict[str, dict[int, float]] = {}
    for m, df in orders.items():
        for r in df.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).collect():
            discounts.setdefault(r["lang"], {})[m] = r["ones"] / (r["ones"] + 2 * r["twos"]) if r["ones"] and r["twos"] else 0.5
    model = Languages(sorted(discounts), [], np.full((len(discounts), 2), np.inf))
    if not model.langs:
        return model
    two = _by_language(pairs)
    symbols = len(np.unique(np.concatenate([keys & np.uint64(0xFFFF) for keys, _ in two.values()]))) + 1
    for first, end in _shards(counts, len(model.langs), cfg.shard_bytes):
        found = _by_language(counts.where(F.col("slot").between(first, end - 1)))
        none = np.empty(0, np.uint64), np.empty(0, np.int64)
        model.shards.append(ship(spark, Shard([KneserNey(*found.get(x, none), *two[x], discounts[x], symbols) for x in model.langs], first, end)))
    seen = _pass(rows.where("_spared").select("doc_id", "text", "lang"), model, ["doc_id", "lang"], f"doc_id bigint, lang string, {APPLIED}")
    _calibrate(model, store(seen.where("lang = lang_pred").select("lang", "bits", "chars"), "spared"), cfg)
    return model


def _by_language(counts: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Sorted grams and their counts."""
    found = counts.select("lang", "gram", "n").toArrow()
    langs, keys, n = np.array(found.column("lang").to_pylist(), object), found.column("gram").to_numpy().view(np.uint64), found.column("n").to_numpy()
    out = {}
    for lang in dict.fromkeys(langs.tolist()):
        own = langs == lang
        order = np.argsort(keys[own])
        out[lang] = (keys[own][order], n[own][order])
    return out


def _shards(counts: DataFrame, langs: int, most: int) -> list[tuple[int, int]]:
    """Runs of slots, as [first, end), that hold about ``most`` bytes each; one slot at least."""
    sizes = np.zeros(SLOTS, np.int64)
    for r in counts.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[r["slot"]] = r["n"] * (56 + 4 * langs)
    out, first, held = [], 0, 0
    for slot, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            out.append((first, slot))
            first, held = slot, 0
        held += size
    return [*out, (first, SLOTS)]


def _calibrate(model: Languages, seen: DataFrame, cfg: LanguageModel) -> None:
    """A language's bound on bits per character: a level from long texts, and what short ones need above it.

    All of ``seen`` (lang, bits, chars) counts. Bits are rounded for the level, so a language has few values of them. A language
    with under 20 texts has the bound of all languages' texts together, or its own texts' if that is wider.
    """
    model.evidence = cfg.evidence
    rounded, long = F.round("bits", 3), F.col("chars") >= 200
    of = F.when(F.count_if(long) >= 20, F.percentile(F.when(long, rounded), F.lit(0.999))).otherwise(F.percentile(rounded, F.lit(0.999)))
    # the pool is the row without a language
    levels = seen.groupingSets([["lang"], []], "lang").agg(F.count(F.lit(1)).alias("n"), of.alias("level")).collect()
    level = {r["lang"]: r["level"] for r in levels if r["n"]}
    if not level:
        return
    over = lambda x: F.max((F.col("bits") - F.lit(level[x])) * F.sqrt("chars"))
    pooled = (level[None], max(seen.agg(over(None)).first()[0], 1.0))
    own = F.try_element_at(F.create_map(*[F.lit(x) for p in level.items() if p[0] is not None for x in p]), F.col("lang"))
    widths = {r["lang"]: max(r["w"], 1.0) for r in seen.groupBy("lang").agg(F.max((F.col("bits") - own) * F.sqrt("chars")).alias("w")).collect()}
    enough = {r["lang"] for r in levels if r["n"] >= 20}
    for j, lang in enumerate(model.langs):
        bound = (level[lang], widths[lang]) if lang in widths else pooled
        if lang not in enough:
            bound = tuple(max(x, y) for x, y in zip(bound, pooled, strict=True))
        model.bounds[j] = bound[0] * cfg.slack, bound[1] * cfg.slack


APPLIED = "lang_pred string, score double, rejected boolean, bits double, chars bigint"
_SUMS = "array<double>"


def _sums(part: pa.RecordBatch, shared):
    """The texts' bits so far and in this shard, their characters and letters."""
    total, chars, letters = unpacked(shared).entropies(part.column("text"))
    before = part.column("sums")
    if len(before) > before.null_count:
        total += before.flatten().to_numpy().reshape(total.shape)
    return total, chars, letters


def _through(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, most=_SLICE):
            total = _sums(part, shared)[0]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(total) + 1, dtype=np.int32) * total.shape[1]), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("text"), lists], ["doc", "text", "sums"])

    return run


def _finish(shared, langs, bounds, evidence, keep: list[str] | None, schema):
    """With ``keep`` these columns and what was decided; else the documents themselves that are not rejected, in their schema."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, most=_SLICE):
            if shared is None:
                _, offsets, letters = coded_texts(part.column("text"))
                total, chars = np.zeros((part.num_rows, 0)), np.diff(offsets) - (ORDER - 1)
            else:
                total, chars, letters = _sums(part, shared)
            lang, score, bits, rejected = decide(langs, bounds, evidence, total, chars, letters)
            doc = part.column("doc")
            field = lambda c: doc.field(doc.type.get_field_index(c))
            if keep is not None:
                yield pa.RecordBatch.from_arrays([*(field(c) for c in keep), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected), pa.array(bits), pa.array(chars, pa.int64())], [*keep, "lang_pred", "score", "rejected", "bits", "chars"])
            else:
                columns = [pa.array(lang, pa.string()) if c == "lang" else part.column("text") if c == "text" else field(c) for c in schema]
                yield pa.RecordBatch.from_arrays(columns, schema).filter(pa.array(~np.asarray(rejected)))

    return run


def _pass(docs: DataFrame, model: Languages, keep: list[str] | None, schema) -> DataFrame:
    """``docs`` through all shards; what the shards but the last have summed is written between them."""
    # the document's own columns travel in a struct, so none can clash with a name used here
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(F.lit(0).alias("_"), *others).alias("doc"), "text", F.lit(None).cast(_SUMS).alias("sums"))
    for shared in model.shards[:-1]:
        rows = store(rows.mapInArrow(giving_back(_through(shared)), rows.schema), "language-sums")
    last = _finish(model.shards[-1] if model.shards else None, model.langs, model.bounds, model.evidence, keep, docs.columns)
    return rows.mapInArrow(giving_back(last), schema)


def identify(docs: DataFrame, model: Languages, cfg: LanguageModel = LanguageModel()) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected, bits (cross-entropy per character) for every row of ``docs`` (doc_id, text).

    A null text, or one without letters, is ``und`` with score 0, and rejected. Without learnable rows all texts are ``und``.
    Rows without doc_id are learned from by nobody. Repeated rows have repeated results.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % cfg.folds
    out = _pass(docs.select("doc_id", "text"), model, ["doc_id"], f"doc_id bigint, {APPLIED}")
    return out.select("doc_id", F.coalesce(fold == cfg.held_out, F.lit(True)).alias("held_out"), "lang_pred", "score", "rejected", "bits")


def known_language(docs: DataFrame, cfg: LanguageModel = LanguageModel()) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, with ``lang`` as identified; all columns stay, no shuffle.

    A null text, or one without letters, is rejected; a short text is not. Repeated rows have one verdict. Without learnable
    rows none is known, so nothing stays.
    """
    return _pass(docs, learn(docs, cfg), None, docs.schema)
