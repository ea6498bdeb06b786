"""Operator 9, MinHash near-dedup.

Circulant MinHash: one permutation scatters the shingles, a second one, circularly shifted by k, gives coordinate k of the
signature. Bands of the signature make buckets; links are confirmed by exact Jaccard similarity on full shingle sets.
Identical sets are one class from the start. Buckets are not expanded into all pairs: members meet the leaders of their
buckets, and only buckets that still mix components go on: those of two as the pair they are, larger ones over their rarest
shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, deal_lookup, giving_back, gram_hashes, mix64, spread_lookup, store, text_slices, total_of, word_hashes, words_of
from .components import components


@dataclass(frozen=True)
class MinHash:
    """A pair at similarity s meets in no bucket with probability (1 - s ** rows) ** bands: 2e-6 at 0.75."""

    words: int = 5
    percent: int = 75
    rows: int = 5
    bands: int = 48
    #: Each class is compared with so many leaders of its buckets before the rest is looked at.
    leaders: int = 3
    #: So many bands are looked at for that.
    settling: int = 8


SIGNED = "doc_id bigint, n_shingles bigint, fp binary, bands array<bigint>"
SETS = "rep bigint, items array<bigint>"
_BLOCK = 1 << 16
#: Sets with a shingle in common are compared in blocks of about so many.
LIST_BLOCK = 2048


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, end to end, and their offsets."""
    found, offsets = words_of(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    hashes = word_hashes(found)
    grams = gram_hashes(hashes, words)
    sets, n = [], len(offsets) - 1
    for i in range(n):
        a, b = offsets[i], offsets[i + 1]
        if b - a >= words:
            sets.append(np.unique(grams[a : b - words + 1]))
        elif b > a:
            sets.append(gram_hashes(hashes[a:b], int(b - a)) ^ np.uint64(b - a))
        else:
            sets.append(hashes[:0])
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if n else np.empty(0, np.uint64)), ends


def signatures(items: np.ndarray, ends: np.ndarray, k: int) -> np.ndarray:
    """Circulant MinHash signatures of sets that have items: coordinate j is the least value of the second permutation, shifted by j."""
    first = (mix64(items) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(ends) - 1, k), np.uint32)
    a = 0
    while a < len(ends) - 1:
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + _BLOCK, "right")) - 1)
        part, starts = first[ends[a] : ends[b]], ends[a:b] - ends[a]
        y, t = np.empty_like(part), np.empty_like(part)
        for j in range(k):
            np.subtract(part, np.uint32(j), out=y)
            np.multiply(y, np.uint32(0x7FEB352D), out=y)
            np.right_shift(y, np.uint32(15), out=t)
            np.bitwise_xor(y, t, out=y)
            np.multiply(y, np.uint32(0x846CA68B), out=y)
            np.right_shift(y, np.uint32(16), out=t)
            np.bitwise_xor(y, t, out=y)
            out[a:b, j] = np.minimum.reduceat(y, starts)
        a = b
    return out


def _sign(cfg: MinHash):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            items, ends = shingle_sets(part.column("text"), cfg.words)
            sizes, ids = np.diff(ends), part.column("doc_id")
            full = np.flatnonzero(sizes)
            # a text without words has a fingerprint of its own, so it meets no other
            fps = [xxhash.xxh3_128_digest(items[ends[i] : ends[i + 1]].tobytes()) if sizes[i] else f"-{ids[i]}".encode() for i in range(len(sizes))]
            keys = np.zeros((len(sizes), cfg.bands), np.uint64)
            if len(full):
                sig = signatures(items, np.concatenate([[0], np.cumsum(sizes[full])]), cfg.rows * cfg.bands).astype(np.uint64)
                for band in range(cfg.bands):
                    h = np.full(len(full), band + 1, np.uint64)
                    for r in range(cfg.rows):
                        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, band * cfg.rows + r])
                    keys[full, band] = h
            offsets = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * cfg.bands)
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes), pa.array(fps, pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel().view(np.int64)))], ["doc_id", "n_shingles", "fp", "bands"])

    return run


def _full_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            items, ends = shingle_sets(part.column("text"), words)
            # rows that share a doc_id with another text drop out by their fingerprint
            fits = [i for i, fp in enumerate(part.column("fp").to_pylist()) if xxhash.xxh3_128_digest(items[ends[i] : ends[i + 1]].tobytes()) == fp]
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(items.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(fits, pa.int64())), lists.take(pa.array(fits, pa.int64()))], ["rep", "items"])

    return run


class _Linker:
    """Candidate pairs of class representatives in, confirmed links out."""

    def __init__(self, docs: DataFrame, classes: DataFrame, cfg: MinHash):
        self.docs, self.classes, self.cfg, self.sets = docs.select("doc_id", "text"), classes.select("rep", "fp"), cfg, None

    def read(self, wanted: DataFrame) -> None:
        """Make the full sets of the classes ``wanted`` (rep), as far as they are not there."""
        new = wanted if self.sets is None else wanted.join(self.sets.select("rep"), "rep", "left_anti")
        ids = new.join(self.classes, "rep").select(F.col("rep").alias("doc_id"), "fp")
        found = store(self.docs.join(ids, "doc_id").mapInArrow(giving_back(_full_sets(self.cfg.words)), SETS), "shingle-sets")
        self.sets = found if self.sets is None else self.sets.union(found)

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """Of ``pairs`` (u, v), a written table, those whose sets reach the similarity. Leaders of many pairs are dealt to many tasks."""
        a, b = self.sets.select(F.col("rep").alias("v"), F.col("items").alias("b")), self.sets.select(F.col("rep").alias("u"), F.col("items").alias("a"))
        met = deal_lookup(deal_lookup(pairs, a, "v", F.col("u"), pairs), b, "u", F.col("v"), pairs)
        met = met.select("u", "v", F.size("a").alias("na"), F.size("b").alias("nb"), F.size(F.array_intersect("a", "b")).alias("both"))
        return store(met.where(F.lit(100) * F.col("both") >= F.lit(self.cfg.percent) * (F.col("na") + F.col("nb") - F.col("both"))).select("u", "v"), "links")

    def rare_pairs(self, reps: DataFrame, alike) -> DataFrame:
        """Candidate pairs (u, v) across components of ``reps`` (rep, n, component), none that is alike left out.

        Two sets that reach the similarity share one of the (1 - similarity) * n + 1 rarest shingles of each, so passages that
        many documents share make no candidates. Shingles of a single document only use up that number; as they cannot be
        shared, how many there are also bounds the similarity of a pair. Of shingles that the same sets have, one is enough. A
        pair is bound once more by where its first common shingle stands in both. A shingle's sets are compared block by block
        with each other, so a long list is the work of many tasks; only pairs that pass every bound leave the join.
        """
        items = reps.join(self.sets.dropDuplicates(["rep"]), "rep").select("rep", "n", "component", F.explode("items").alias("item"))
        often = store(items.groupBy("item").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared-items")
        held = spread_lookup(items, often, "item", "df", total_of(often, "df"), F.col("rep"))
        ranked = held.groupBy("rep", "n", "component").agg(F.array_sort(F.collect_list(F.struct("df", "item"))).alias("shared"))
        own, share = F.size("shared"), self.cfg.percent
        needed = F.col("n") - F.ceil(F.col("n") * share / 100) + 1 - (F.col("n") - own)
        first = ranked.where(needed > 0).select("rep", "n", "component", own.alias("s"), F.posexplode(F.slice("shared", F.lit(1), needed.cast("int"))).alias("_p", "_r"))
        rare = store(first.select("rep", "n", "component", (F.col("s") - F.col("_p")).alias("s"), F.col("_r.df").alias("df"), F.col("_r.item").alias("item")), "rare-items")
        # which sets a list has: two independent sums of 64-bit hashes
        sums = [F.sum(F.xxhash64("rep", F.lit(turn)).cast("decimal(38,0)")).alias(f"h{turn}") for turn in (1, 2)]
        lists = rare.groupBy("item").agg(F.count(F.lit(1)).alias("k"), *sums, F.min("component").alias("_a"), F.max("component").alias("_b"), F.first("df").alias("df"))
        one_each = lists.where("_a != _b").groupBy("k", "h1", "h2").agg(F.min(F.struct("df", "item"))["item"].alias("item")).select("item", "k")
        one_each = store(one_each, "rare-lists")
        kept = spread_lookup(rare, one_each, "item", "k", total_of(one_each, "k"), F.col("rep"))
        blocks = F.ceil(F.col("k") / LIST_BLOCK).cast("int")
        kept = store(kept.select("rep", "n", "component", "s", "item", blocks.alias("blocks"), F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("block")), "rare-kept")
        every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        side = lambda x: [F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("s").alias(f"s{x}"), F.col("component").alias(f"c{x}")]
        left = kept.select("item", *side("u"), F.col("block").alias("_i"), every.alias("_j"))
        right = kept.select("item", *side("v"), every.alias("_i"), F.col("block").alias("_j"))
        both = F.least("su", "sv")
        bound = F.lit(100) * both >= F.lit(share) * (F.col("nu") + F.col("nv") - both)
        return left.join(right, ["item", "_i", "_j"]).where((F.col("u") < F.col("v")) & (F.col("cu") != F.col("cv")) & alike(F.col("nu"), F.col("nv")) & bound).select("u", "v").distinct()


def _labelled(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Classes with their component; a class without links is its own."""
    return classes.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def near_dedup(docs: DataFrame, cfg: MinHash = MinHash()) -> DataFrame:
    """Near-duplicate components of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Words are runs of other characters than ASCII white space after A-Z are lower-cased; a null text has none and, like any
    text without words, is linked with nothing and stays. Texts with fewer words than a shingle are one shingle. Repeated rows
    of a doc_id share a verdict. A row without doc_id stays only if nothing with a doc_id is like it; then component_id is null.
    """
    bounded_batches(docs.sparkSession)
    alike = lambda a, b: F.lit(100) * F.least(a, b) >= F.lit(cfg.percent) * F.greatest(a, b)
    signed = store(docs.select("doc_id", "text").mapInArrow(giving_back(_sign(cfg)), SIGNED), "signed")
    classes = store(signed.where("n_shingles > 0").groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "classes")
    linked = classes.where("rep is not null")
    linker = _Linker(docs, linked, cfg)

    # first each class with the least leaders of its buckets of a few bands, which settles groups of copies without looking at all pairs
    few = linked.select("rep", "n", F.explode(F.slice("bands", 1, cfg.settling)).alias("key"))
    leads = store(few.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("rep", "n")).alias("lead")).where("size > 1"), "leads")
    met = spread_lookup(few, leads, "key", "size", total_of(leads, "size"), F.col("rep")).where("rep != lead.rep").where(alike(F.col("n"), F.col("lead.n")))
    star = met.groupBy("rep").agg(F.slice(F.array_sort(F.collect_set("lead.rep")), 1, cfg.leaders).alias("leads"))
    star = store(star.select(F.explode("leads").alias("u"), F.col("rep").alias("v")), "star-pairs")
    linker.read(star.select(F.explode(F.array("u", "v")).alias("rep")).distinct())
    labels = store(components(linker.confirm(star)), "labels")

    # then every band: only buckets that still hold two components matter, and counts alone say which those are
    entries = _labelled(linked, labels).select("rep", "n", "component", F.explode("bands").alias("key"))
    ends = [f(F.struct("rep", "n")).alias(name) for f, name in ((F.min, "low"), (F.max, "high"))]
    mixed = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("_a"), F.max("component").alias("_b"), *ends).where("_a != _b")
    mixed = store(mixed.select("key", "size", "low", "high"), "mixed")
    # a bucket of two is the pair of its ends
    twos = mixed.where("size = 2").where(alike(F.col("low.n"), F.col("high.n"))).select(F.col("low.rep").alias("u"), F.col("high.rep").alias("v")).distinct()
    twos = store(twos.join(star, ["u", "v"], "left_anti"), "twos")
    # larger ones are paired over the rarest shingles
    many = store(mixed.where("size > 2").select("key", "size"), "mixed-many")
    open_ = store(spread_lookup(entries, many, "key", "size", total_of(many, "size"), F.col("rep")).select("rep", "n", "component").distinct(), "open")
    linker.read(open_.select("rep").union(twos.select(F.explode(F.array("u", "v")))).distinct())
    pairs = store(linker.rare_pairs(open_, alike).union(twos).distinct(), "pairs")
    across = linker.confirm(pairs)

    # links between components join these
    of = lambda x: labels.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    named = deal_lookup(deal_lookup(across, of("u"), "u", F.col("v"), across, "left"), of("v"), "v", F.col("u"), across, "left")
    joined = store(components(named.select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))), "joined")
    moved = joined.select(F.col("node").alias("component"), F.col("component").alias("_to"))
    verdicts = deal_lookup(_labelled(classes.select("fp", "copies", "rep"), labels), moved, "component", F.col("fp"), labels.select("component"), "left")
    verdicts = store(verdicts.select("fp", "copies", F.coalesce("_to", "component").alias("component")), "verdicts")
    out = spread_lookup(signed.select("doc_id", "n_shingles", "fp"), verdicts, "fp", "copies", total_of(verdicts, "copies"), F.col("doc_id"), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
