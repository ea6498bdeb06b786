"""Operator 6, substring dedup: repeated-phrase automata.

Anchors (window minimizers) tell which passages can recur; their windows are confirmed by counts over all documents. Confirmed
passages are compiled into Aho-Corasick automata, sharded with the documents that hold them, and every such document is
streamed through its shard's automaton to locate all occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_string, bounded_batches, drop_stored, gram_hashes, mix64, spread_lookup, store, text_slices, total_of, wide_word_hashes, words_of


@dataclass(frozen=True)
class Phrases:
    words: int = 35  # a window: so many words that recur are removed
    anchor: int = 8  # words of an anchor; each window has one, its least by hash


SCANNED = "doc_id bigint, row bigint, n_words bigint, kept_sha256 string, anchors array<struct<gram:bigint,passage:bigint,other:bigint,at:int>>"
WINDOWS = "doc bigint, row bigint, window bigint, other bigint, at int"
REMOVED = "doc bigint, row bigint, n_removed bigint, kept_sha256 string"


def _places(hashes: np.ndarray, offsets: np.ndarray, cfg: Phrases):
    """For each anchor: its place, the first and the last window that have it (all as places in ``hashes``), and its document."""
    none = np.empty(0, np.int64)
    n_windows = len(hashes) - cfg.words + 1
    if n_windows <= 0:
        return none, none, none, none, np.empty(0, np.uint64)
    grams = mix64(gram_hashes(hashes, cfg.anchor))
    span = cfg.words - cfg.anchor + 1
    least = np.empty(n_windows, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, span)
    for a in range(0, n_windows, 65_536):
        part = view[a : a + 65_536]
        least[a : a + len(part)] = np.argmin(part, axis=1) + np.arange(a, a + len(part))
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n_windows]
    windows = np.flatnonzero(np.arange(n_windows) + cfg.words <= offsets[1:][doc])
    anchor, doc = least[windows], doc[windows]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])) if len(windows) else none
    last = np.concatenate([new[1:] - 1, [len(windows) - 1]]) if len(windows) else none
    return anchor[new], windows[new], windows[last], doc[new], grams


def _spans_hash(hashes: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the words in [first, end), by prefix sums of a polynomial with an odd base and its inverse powers."""
    base = 0xD1342543DE82EF95
    powers = _powers(base, len(hashes))
    prefix = np.concatenate([[np.uint64(0)], np.cumsum(mix64(hashes) * powers[:-1], dtype=np.uint64)])
    # shifted back to exponent 0, so that equal words have one hash wherever they stand
    return mix64((prefix[end] - prefix[first]) * _powers(pow(base, -1, 1 << 64), len(hashes))[first])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _scan(cfg: Phrases):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            words, offsets = words_of(part.column("text"))
            both = wide_word_hashes(words)
            at, lo, hi, doc, grams = _places(both[0], offsets, cfg)
            end = hi + cfg.words
            # a passage also says where its anchor stands in it and how many windows it has
            spot = mix64(((at - lo) * 64 + (hi - lo)).astype(np.uint64))
            passage, other = ((mix64(_spans_hash(h, lo, end) + spot) if len(at) else np.empty(0, np.uint64)).view(np.int64) for h in both)
            cells = pa.StructArray.from_arrays([pa.array(grams[at].view(np.int64)), pa.array(passage), pa.array(other), pa.array((at - offsets[doc]).astype(np.int32))], ["gram", "passage", "other", "at"])
            starts = np.searchsorted(doc, np.arange(part.num_rows + 1))
            n = np.diff(offsets)
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), words), pa.scalar(" ", words.type)).to_pylist()
            shas = [hashlib.sha256(t.encode()).hexdigest() for t in joined]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row"), pa.array(n), pa.array(shas), pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), cells)], ["doc_id", "row", "n_words", "kept_sha256", "anchors"])

    return run


def _marked_windows(cfg: Phrases):
    """Windows of anchors that recur in unlike surroundings (``part`` holds their places)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            words, offsets = words_of(part.column("text"))
            both = wide_word_hashes(words)
            at, lo, hi, doc, _ = _places(both[0], offsets, cfg)
            lists = part.column("part")
            wanted = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)) << 32 | lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            chosen = np.flatnonzero(np.isin(doc << 32 | (at - offsets[doc]), wanted))
            lo, hi, doc = lo[chosen], hi[chosen], doc[chosen]
            counts = hi - lo + 1
            starts = np.repeat(lo, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            doc = np.repeat(doc, counts)
            window, other = ((gram_hashes(h, cfg.words)[starts] if len(starts) else np.empty(0, np.uint64)).view(np.int64) for h in both)
            own = pa.array(doc)
            columns = [part.column("doc").take(own), part.column("row").take(own), pa.array(window), pa.array(other), pa.array((starts - offsets[doc]).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "row", "window", "other", "at"])

    return run


def _runs(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Windows at these places as maximal passages of consecutive ones."""
    starts = np.unique(starts)
    cuts = np.flatnonzero(np.diff(starts) > 1) + 1
    return [(int(p[0]), int(p[-1]) + width) for p in np.split(starts, cuts) if len(p)]


def _locate(cfg: Phrases):
    """Compile the passages of a shard of documents and stream the shard through the automaton."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            words, offsets = words_of(part.column("text"))
            at, lo, hi, doc, _ = _places(wide_word_hashes(words)[0], offsets, cfg)
            coded = words.dictionary_encode()
            codes, passages = coded.indices.to_numpy(), []
            full, single = part.column("full").to_pylist(), part.column("windows").to_pylist()
            bounds = np.searchsorted(doc, np.arange(part.num_rows + 1))
            for d in range(part.num_rows):
                a, b = bounds[d], bounds[d + 1]
                sure = np.isin(at[a:b] - offsets[d], np.array(full[d] or [], np.int64))
                wide = [np.arange(x, y + 1) for x, y in zip(lo[a:b][sure] - offsets[d], hi[a:b][sure] - offsets[d], strict=True)]
                passages.append(_runs(np.concatenate([*wide, np.array(single[d] or [], np.int64)]).astype(np.int64), cfg.words))
            automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
            for d, found in enumerate(passages):
                for s, e in found:
                    automaton.add_word(tuple(codes[offsets[d] + s : offsets[d] + e].tolist()), e - s)
            automaton.make_automaton()
            texts = words.to_pylist()
            removed, shas = [], []
            for d in range(part.num_rows):
                own = codes[offsets[d] : offsets[d + 1]]
                edge = np.zeros(len(own) + 1, np.int64)
                if len(automaton):
                    for last, n in automaton.iter(tuple(own.tolist())):
                        edge[last + 1 - n] += 1
                        edge[last + 1] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                removed.append(int(gone.sum()))
                shas.append(hashlib.sha256(" ".join(texts[offsets[d] + i] for i in np.flatnonzero(~gone)).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("row"), pa.array(removed, pa.int64()), pa.array(shas)], ["doc", "row", "n_removed", "kept_sha256"])

    return run


def substring_dedup(docs: DataFrame, cfg: Phrases = Phrases()) -> DataFrame:
    """Words of ``docs`` (doc_id, text) outside recurring passages: doc_id, n_words, n_removed, kept_sha256.

    A word goes if a window of ``words`` consecutive words over it occurs a second time, in any document. A null text has no
    words. Repeated rows are occurrences of each other. Windows are counted by 128-bit hashes and located by their words. No
    documents give no rows.
    """
    bounded_batches(docs.sparkSession)
    # rows are told apart by doc_id and a hash of both columns, so repeated rows have repeated results and tasks can run again
    row, key = F.xxhash64("doc_id", "text").alias("row"), ["doc", "row"]
    own = F.coalesce("doc_id", F.lit(0)).alias("doc")
    texts = docs.select("doc_id", row, F.coalesce("text", F.lit("")).alias("text"))
    scanned = store(texts.mapInArrow(_scan(cfg), SCANNED), "scanned")
    anchors = scanned.select(own, "row", F.inline("anchors"))
    passage = F.struct("passage", "other")
    grams = anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), (F.min(passage) == F.max(passage)).alias("alike")).where("n > 1")
    grams = store(grams, "grams")
    marked = spread_lookup(anchors.select(*key, "gram", "at"), grams, "gram", "n", total_of(grams, "n"), F.xxhash64("row", "at"))
    marks = marked.groupBy(*key).agg(F.collect_set(F.when(F.col("alike"), F.col("at"))).alias("full"), F.collect_set(F.when(~F.col("alike"), F.col("at"))).alias("part"))
    # repeated rows stand for themselves in the counts above; one of each is enough from here on
    held = store(texts.select(own, "row", "text").join(marks, key).dropDuplicates(key), "held-texts")
    times = scanned.groupBy(own, "row").agg(F.count(F.lit(1)).alias("times"))
    windows = store(held.where(F.size("part") > 0).select(*key, "text", "part").mapInArrow(_marked_windows(cfg), WINDOWS), "windows")
    counted = windows.join(times, key).groupBy("window", "other").agg(F.sum("times").alias("n"), F.count(F.lit(1)).alias("rows")).where("n > 1")
    counted = store(counted.select("window", F.col("other").alias("_other"), "rows"), "recurring")
    # the second hash is compared by the join's side, so its key is one column
    found = spread_lookup(windows, counted, "window", "rows", total_of(counted, "rows"), F.xxhash64("row", "at")).where(F.col("other") == F.col("_other"))
    single = found.groupBy(*key).agg(F.collect_set("at").alias("windows"))
    shards = held.select(*key, "text", "full").join(single, key, "left")
    removed = store(shards.mapInArrow(_locate(cfg), REMOVED), "removed")
    out = scanned.select("doc_id", own, "row", "n_words", F.col("kept_sha256").alias("_all")).join(removed, key, "left")
    out = out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("kept_sha256", "_all").alias("kept_sha256"))
    drop_stored(grams, held, windows, counted)
    return out
