"""Operator 5, best-fit packing: hierarchical residual packing.

Each task tokenizes its documents and best-fits the pieces into bins. Nearly full bins are done; underfull ones become items of
the next round, where groups of a bounded number of them are best-fit again, until a round gains next to nothing.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, giving_back, store, text_slices, words_of


@dataclass(frozen=True)
class Packing:
    tokenizer: str  # path of a tokenizers file that drops white space between words
    capacity: int = 4096
    end_id: int = 1
    #: A bin is done when fewer tokens than this are free.
    slack: int = 16
    #: Underfull bins that meet in one task of a later round.
    group: int = 50_000
    rounds: int = 6


PACKED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, bin bigint, at bigint, fill int"
#: Distinct pre-tokens whose ids a task keeps.
_CACHE_WORDS = 200_000
#: Words of ASCII and Latin-1 letters are lower-cased and cut here as the tokenizer does it; all others go to it as they are.
_SAFE = "^[\\x21-\\x7E\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+$"
_CUT = "('s|'t|'re|'ve|'m|'ll|'d|[a-z\u00DF-\u00F6\u00F8-\u00FF]+|[0-9]|[^a-z\u00DF-\u00F6\u00F8-\u00FF0-9]+)"
_TOGETHER = 100


def _tokenizer(path: str):
    """The tokenizer of this file, loaded once a process: the library's threads keep memory of each one that has been used."""
    import tokenizers

    # this package goes to workers by value, with new globals for each task, so what is to last is kept at the library's module
    _loaded = tokenizers.__dict__.setdefault("_drillspark_loaded", {})
    at = os.stat(path)
    key = path, at.st_mtime_ns, at.st_size
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = tokenizers.Tokenizer.from_file(path)
        _loaded[key].no_padding()
        _loaded[key].no_truncation()
    return _loaded[key]


class WordTokenizer:
    """Ids of whole texts, with every distinct pre-token tokenized once. Only for tokenizers that drop white space, lower-case,
    and cut words into letters, single digits and other signs."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self._forget()

    def _forget(self) -> None:
        # pre-tokens, their ids end to end, and where each one's begin
        self.known = pa.array([], pa.large_string())
        self.flat, self.starts = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def _learn(self, plain: list[str], odd: list[str]) -> None:
        for a in range(0, len(plain), 64 * _TOGETHER):
            groups = [plain[i : i + _TOGETHER] for i in range(a, min(len(plain), a + 64 * _TOGETHER), _TOGETHER)]
            found = self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)
            sizes = [np.bincount(np.array(e.word_ids), minlength=len(g)) for e, g in zip(found, groups, strict=True)]
            self._add(np.concatenate([np.array(e.ids, np.uint32) for e in found]), np.concatenate(sizes))
        if odd:
            found = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)]
            self._add(np.concatenate(found), np.array([len(x) for x in found]))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and each text's offsets into them."""
        words, offsets = words_of(texts)
        if not len(words):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        safe = pc.and_not(pc.match_substring_regex(distinct, _SAFE), pc.match_substring(distinct, "<|"))
        cut = pc.utf8_rtrim(pc.replace_substring_regex(pc.utf8_lower(distinct), _CUT, "\\1\n"), "\n")
        # a blank in front keeps a word that is left whole apart from pre-tokens that look the same
        whole = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), distinct, pa.scalar(" ", pa.large_string()))
        parts = pc.split_pattern(pc.if_else(safe, cut, whole), "\n")
        pieces = parts.flatten().dictionary_encode()
        number = self._numbers(pieces.dictionary)
        ids, ends = _gathered(self.flat, self.starts, number[pieces.indices.to_numpy()])
        # of distinct words, then of all words in their order
        ids, word_ends = _gathered(ids, ends[parts.offsets.to_numpy()], coded.indices.to_numpy())
        pa.default_memory_pool().release_unused()
        return ids, word_ends[offsets]

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """The place of each of these distinct pre-tokens among the known ones; new ones are tokenized and get the next places."""
        at = pc.index_in(pieces, value_set=self.known)
        if len(self.known) + at.null_count > _CACHE_WORDS and len(self.known):
            self._forget()
            at = pa.nulls(len(pieces), pa.int32())
        number = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(number < 0)
        if len(new):
            fresh = pieces.take(pa.array(new))
            odd = pc.starts_with(fresh, " ").to_numpy(zero_copy_only=False)
            # words that are left whole come last
            order = np.argsort(odd, kind="stable")
            number[new[order]] = len(self.known) + np.arange(len(new))
            fresh, plain = fresh.take(pa.array(order)), len(new) - int(odd.sum())
            words = fresh.to_numpy(zero_copy_only=False).tolist()
            self._learn(words[:plain], words[plain:])
            self.known = pa.concat_arrays([self.known, fresh])
        return number


def _gathered(flat: np.ndarray, starts: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs flat[starts[i]:starts[i + 1]] for every i of ``index``, end to end, and where they end (0 first)."""
    sizes = np.diff(starts)[index]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return flat[np.repeat(starts[:-1][index] - ends[:-1], sizes) + np.arange(ends[-1])], ends


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best-fit decreasing: for each item its bin and its place there; the fill of each bin. Ties go to the latest bin, so equal input gives equal bins."""
    bin_of, at = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fills = 0, []  # bit r of rooms: some bin has exactly r free
    for i in np.argsort(-sizes, kind="stable").tolist():
        n = int(sizes[i])
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            stack = by_room[room]
            b = stack.pop()
            if not stack:
                rooms ^= 1 << room
        else:
            b, room = len(fills), capacity
            fills.append(0)
        bin_of[i], at[i] = b, fills[b]
        fills[b] += n
        left = room - n
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bin_of, at, fills


def _tokenize_and_pack(cfg: Packing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, parts = WordTokenizer(cfg.tokenizer), []
        for part in text_slices(batches):
            ids, offsets = encode(part.column("text"))
            ends = offsets[1:] + np.arange(1, part.num_rows + 1)
            ids = np.insert(ids, offsets[1:], cfg.end_id).astype("<u4")
            sizes = np.diff(np.concatenate([[0], ends]))
            pieces = -(-sizes // cfg.capacity)
            doc = np.repeat(np.arange(part.num_rows), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * cfg.capacity
            length = np.minimum(sizes[doc] - start, cfg.capacity)
            first = (ends - sizes)[doc] + start
            view = memoryview(ids.view(np.uint8))
            crc = [zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist(), strict=True)]
            parts.append(pa.table({"doc_id": part.column("doc_id").take(pa.array(doc)), "piece": pa.array(piece.astype(np.int32)), "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64())}))
        if not parts:
            return
        whole = pa.concat_tables(parts).combine_chunks()
        bin_of, at, fills = best_fit(whole.column("length").to_numpy(), cfg.capacity)
        base = TaskContext.get().partitionId() << 36
        out = whole.append_column("bin", pa.array(bin_of + base)).append_column("at", pa.array(at)).append_column("fill", pa.array(np.array(fills, np.int32)[bin_of]))
        yield from out.to_batches(max_chunksize=100_000)

    return run


def _pack_bins(cfg: Packing):
    """A task's underfull bins as items: (bin, fill) to (bin, parent, shift, parent_fill)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches), pa.schema([("bin", pa.int64()), ("fill", pa.int32())])).sort_by("bin")
        if not rows.num_rows:
            return
        names = rows.column("bin").to_numpy()
        bin_of, at, fills = best_fit(rows.column("fill").to_numpy().astype(np.int64), cfg.capacity)
        # a new bin bears the name of the first item in it
        heads = np.empty(len(fills), np.int64)
        heads[bin_of[at == 0]] = names[at == 0]
        yield from pa.table({"bin": names, "parent": heads[bin_of], "shift": at, "parent_fill": np.array(fills, np.int32)[bin_of]}).to_batches(max_chunksize=100_000)

    return run


def pack(docs: DataFrame, cfg: Packing) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) and their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document's ids are the tokenizer's, then ``end_id``, so a null or empty text is one piece of one token. Only documents
    longer than the capacity are cut. Repeated rows and null doc_ids are packed like any row. No documents give no rows.
    A task holds some 50 bytes a piece of its partition, and a later round ``group`` bins a task.
    """
    bounded_batches(docs.sparkSession)
    placed = store(docs.select("doc_id", "text").mapInArrow(giving_back(_tokenize_and_pack(cfg)), PACKED), "pieces")
    moves = None  # (bin, to, by): where underfull bins of the first round have gone
    open_bins = store(placed.where((F.col("at") == 0) & (F.col("fill") <= cfg.capacity - cfg.slack)).select("bin", "fill"), "open-bins")
    count = open_bins.count()
    for turn in range(cfg.rounds):
        if count < 2:
            break
        groups = -(-count // cfg.group)
        # hashed anew in every round, so other bins meet
        dealt = open_bins.repartition(groups, F.xxhash64("bin", F.lit(turn)))
        step = store(dealt.mapInArrow(giving_back(_pack_bins(cfg)), "bin bigint, parent bigint, shift bigint, parent_fill int"), "merges")
        if moves is None:
            moves = step.select("bin", F.col("parent").alias("to"), F.col("shift").alias("by"))
        else:
            on = step.select(F.col("bin").alias("to"), "parent", "shift")
            moves = moves.join(on, "to", "left").select("bin", F.coalesce("parent", "to").alias("to"), (F.col("by") + F.coalesce("shift", F.lit(0))).alias("by"))
        moves = store(moves, "moves")
        open_bins = step.where((F.col("bin") == F.col("parent")) & (F.col("parent_fill") <= cfg.capacity - cfg.slack)).select("bin", F.col("parent_fill").alias("fill"))
        merged = step.where("bin != parent").count()
        left = open_bins.count()
        # one group has met whole; and bins that no longer fit together stay as they are
        if groups == 1 or merged * 1000 < count:
            break
        count = left
    out = placed.select("doc_id", "piece", "start", "length", "ids_crc32", "bin", "at")
    if moves is None:
        return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))
    out = out.join(moves, "bin", "left")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("to", "bin").alias("sequence_id"), (F.col("at") + F.coalesce("by", F.lit(0))).alias("offset"))
