"""Operator 4, SentencePiece encoding and decoding, vectorised with numpy.

Distinct words of a batch are grouped by length and advance together. Hashes of substrings probe the sorted keys of the
pieces; at every position the best predecessor is a vectorised maximum, kept as a back pointer (Viterbi). For BPE models the
ids that merging gives, which are the library's, can be had as well: there the best-ranked pair of every word is merged, for
all words of the group at once. Long words take time in proportion to their length either way.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_string, bounded_batches, mix64, text_slices

BLANK = "\u2581"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_KNOWN_WORDS = 300_000
#: Longer words are encoded one by one.
_LONG = 64


class Pieces:
    """A model's pieces: kind, scores, and keys by hash of their code points."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        with open(path, "rb") as f:
            proto = pb.ModelProto.FromString(f.read())
        self.bpe = proto.trainer_spec.model_type == pb.TrainerSpec.BPE
        self._fill([(p.piece, p.score, p.type) for p in proto.pieces], proto.normalizer_spec.add_dummy_prefix, proto.trainer_spec.byte_fallback)
        if proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces:
            # such models change texts first; the library's own normalizer does it
            processor = sentencepiece.SentencePieceNormalizer(model_file=path)
            self.normalize = processor.normalize

    def _fill(self, pieces: list[tuple[str, float, int]], prefix: bool, fallback: bool) -> None:
        self.normalize, self.prefix = None, prefix
        self.text = [p for p, _, _ in pieces]
        self.scores = np.array([s for _, s, _ in pieces])
        kinds = np.array([t for _, _, t in pieces])
        usable = np.flatnonzero((kinds == 1) | (kinds == 4))
        self.unknown = int(np.flatnonzero(kinds == 2)[0])
        self.bytes = {int(self.text[i][3:5], 16): int(i) for i in np.flatnonzero(kinds == 6)} if fallback else {}
        self.is_byte = kinds == 6
        self.silent = np.isin(kinds, [3, 5])
        hashes = np.array([self._hash(self.text[i]) for i in usable], np.uint64)
        order = np.argsort(self._bit(hashes), kind="stable")
        self.keys, self.ids = hashes[order], usable[order]
        self.longest = max(len(self.text[i]) for i in usable)
        # one bit of a million for each key: most substrings are no piece, and few of those are looked for
        bits = self._bit(self.keys)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[bits] = True
        # keys of one bit stand side by side, from first on
        self.first = np.zeros(1 << 20, np.int32)
        self.first[bits[::-1]] = np.arange(len(bits), dtype=np.int32)[::-1]
        self.crowd = int(np.bincount(bits).max())

    @classmethod
    def of(cls, pieces: list[tuple[str, float, int]], bpe: bool, prefix: bool = True, fallback: bool = False) -> Pieces:
        out = cls.__new__(cls)
        out.bpe = bpe
        out._fill(pieces, prefix, fallback)
        return out

    @staticmethod
    def _hash(piece: str) -> np.uint64:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return np.uint64(h)

    @staticmethod
    def _bit(hashes: np.ndarray) -> np.ndarray:
        return ((hashes * _SPREAD) >> np.uint64(44)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece ids by hash, -1 where there is none."""
        out = np.full(hashes.size, -1, np.int64)
        flat = hashes.reshape(-1)
        bits = self._bit(flat)
        here = np.flatnonzero(self.maybe[bits])
        found, at = flat[here], self.first[bits[here]]
        for _ in range(self.crowd):
            hit = self.keys[at] == found
            out[here[hit]] = self.ids[at[hit]]
            rest = ~hit
            here, found, at = here[rest], found[rest], np.minimum(at[rest] + 1, len(self.keys) - 1)
        return out.reshape(hashes.shape)


class Codec:
    def __init__(self, pieces: Pieces):
        #: Places of words, and for each way that is asked for all words' ids end to end and where each one's begin.
        self.pieces, self.places, self._asked, self._held = pieces, {}, (), []

    # words

    def _single(self, points: np.ndarray) -> np.ndarray:
        return self.pieces.find(points.astype(np.uint64) + np.uint64(1))

    def _spelled(self, point: int) -> list[int]:
        """A code point without a piece: its bytes, or the unknown piece."""
        if not self.pieces.bytes:
            return [self.pieces.unknown]
        return [self.pieces.bytes[b] for b in chr(point).encode("utf-8", "replace")]

    def _laid(self, ids: np.ndarray, rows: np.ndarray, points: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words end to end and how many each has, by ids in any order of words; where one is negative, the code point at its place is spelled."""
        order = np.argsort(rows, kind="stable")
        ids, rows = ids[order].astype(np.int32), rows[order]
        bare = np.flatnonzero(ids < 0)
        if len(bare):
            spelled = [self._spelled(c) for c in points[rows[bare], places[order[bare]]].tolist()]
            times = np.ones(len(ids), np.int64)
            times[bare] = [len(x) for x in spelled]
            ids, rows = np.repeat(ids, times), np.repeat(rows, times)
            ids[ids < 0] = [i for x in spelled for i in x]
        return ids, np.bincount(rows, minlength=len(points))

    def _viterbi(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best segmentations of equally long words (rows): ids end to end, and how many each word has."""
        p, (n, size) = self.pieces, points.shape
        # a row for each place, so that all words' values for one place lie side by side
        prefix = np.zeros((size + 1, n), np.uint64)
        for i in range(size):
            prefix[i + 1] = prefix[i] * _BASE + points[:, i].astype(np.uint64) + np.uint64(1)
        best = np.full((size + 1, n), -np.inf)
        best[0] = 0
        back, chosen = np.zeros((size + 1, n), np.int64), np.zeros((size + 1, n), np.int64)
        penalty, rows = p.scores.min() - 10.0, np.arange(n)
        power = np.multiply.accumulate(np.full(max(1, min(size, p.longest)), _BASE, np.uint64))
        for end in range(1, size + 1):
            widest = min(end, p.longest)
            starts = slice(end - widest, end)
            ids = p.find(prefix[end] - prefix[starts] * power[:widest][::-1, None])
            score = np.where(ids >= 0, best[starts] + p.scores[np.maximum(ids, 0)], -np.inf)
            alone = ids[-1] < 0
            score[-1, alone] = best[end - 1, alone] + penalty
            # of equal scores the longest piece, which is the first
            top = score.argmax(0)
            best[end], back[end], chosen[end] = score[top, rows], widest - top, ids[top, rows]
        # all words walk back together
        end, live, steps = np.full(n, size), rows, []
        while len(live):
            at = end[live]
            steps.append((live, chosen[at, live], at - 1))
            end[live] = at - back[at, live]
            live = live[end[live] > 0]
        rows, ids, places = (np.concatenate([x[k] for x in reversed(steps)]) for k in range(3))
        return self._laid(ids, rows, points, places)

    def _merge(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """BPE of equally long words (rows): in each round every word merges its best pair, the leftmost of equal ones.

        So after each round all words that still merge have the same number of parts, one less than before.
        """
        p, (n, width) = self.pieces, points.shape
        hashes, powers = points.astype(np.uint64) + np.uint64(1), np.full((n, width), _BASE, np.uint64)
        starts, live, done = np.tile(np.arange(width, dtype=np.int16), (n, 1)), np.arange(n), []

        def scores(left: np.ndarray, right: np.ndarray, power: np.ndarray) -> np.ndarray:
            ids = p.find(left * power + right)
            return np.where(ids >= 0, p.scores[np.maximum(ids, 0)], -np.inf)

        def without(x: np.ndarray, column: np.ndarray) -> np.ndarray:
            return x[np.arange(x.shape[1]) != column[:, None]].reshape(len(x), -1)

        score = scores(hashes[:, :-1], hashes[:, 1:], powers[:, 1:])
        while width > 1 and len(live):
            at = score.argmax(1)
            go = score[np.arange(len(live)), at] > -np.inf
            if not go.all():
                done.append((live[~go], hashes[~go], starts[~go]))
                live, at, hashes, powers, starts, score = live[go], at[go], hashes[go], powers[go], starts[go], score[go]
                if not len(live):
                    break
            rows = np.arange(len(live))
            power = powers[rows, at + 1]
            hashes[rows, at] = hashes[rows, at] * power + hashes[rows, at + 1]
            powers[rows, at] *= power
            hashes, powers, starts, score = without(hashes, at + 1), without(powers, at + 1), without(starts, at + 1), without(score, at)
            width -= 1
            for left in (at - 1, at):
                r = np.flatnonzero((left >= 0) & (left + 1 < width))
                c = left[r]
                score[r, c] = scores(hashes[r, c], hashes[r, c + 1], powers[r, c + 1])
        done.append((live, hashes, starts))
        rows = np.concatenate([np.repeat(r, h.shape[1]) for r, h, _ in done])
        ids = p.find(np.concatenate([h.reshape(-1) for _, h, _ in done]))
        return self._laid(ids, rows, points, np.concatenate([x.reshape(-1) for _, _, x in done]))

    def _matches(self, points: np.ndarray) -> list[list[tuple[int, int]]]:
        """For each place of a long word the pieces that end there: (length, id)."""
        p, n = self.pieces, len(points)
        out: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
        h, single = np.zeros(n, np.uint64), points.astype(np.uint64) + np.uint64(1)
        for width in range(1, min(n, p.longest) + 1):
            h = h[: n - width + 1] * _BASE + single[width - 1 :]
            ids = p.find(h)
            starts = np.flatnonzero(ids >= 0)
            for start, i in zip(starts.tolist(), ids[starts].tolist(), strict=True):
                out[start + width].append((width, i))
        return out

    def _viterbi_long(self, points: np.ndarray) -> list[int]:
        p, n = self.pieces, len(points)
        scores, penalty = p.scores.tolist(), float(p.scores.min()) - 10.0
        best, back = [0.0] * (n + 1), [(1, -1)] * (n + 1)
        for end, found in enumerate(self._matches(points)[1:], 1):
            top, chosen = best[end - 1] + penalty if not found or found[0][0] > 1 else -np.inf, (1, -1)
            for width, i in found:
                if (score := best[end - width] + scores[i]) >= top:
                    top, chosen = score, (width, i)
            best[end], back[end] = top, chosen
        out, end = [], n
        while end:
            width, i = back[end]
            out.append([i] if i >= 0 else self._spelled(int(points[end - 1])))
            end -= width
        return [i for part in reversed(out) for i in part]

    def _merge_long(self, word: str) -> list[int]:
        """BPE of one word with a heap of pairs, the best first, the leftmost of equal ones."""
        p, n = self.pieces, len(word)
        if self._by_text is None:
            self._by_text = {p.text[i]: (float(p.scores[i]), int(i)) for i in p.ids.tolist()}
        rank, end, before = self._by_text, list(range(1, n + 1)), list(range(-1, n - 1))
        live, heap = [True] * n, []

        def push(left: int) -> None:
            right = end[left]
            if left >= 0 and right < n and (found := rank.get(word[left : end[right]])):
                heapq.heappush(heap, (-found[0], left, end[right]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, left, stop = heapq.heappop(heap)
            right = end[left]
            if not live[left] or right >= n or end[right] != stop:
                continue
            live[right], end[left] = False, stop
            if stop < n:
                before[stop] = left
            push(left)
            if before[left] >= 0:
                push(before[left])
        out = []
        at = 0
        while at < n:
            found = rank.get(word[at : end[at]])
            out += [found[1]] if found else self._spelled(ord(word[at]))
            at = end[at]
        return out

    _by_text = None

    def words(self, words: list[str]) -> None:
        """Encode words that are not known yet, those of a length together, in each way that is asked for: by Viterbi (False), by merging (True)."""
        new = sorted((w for w in words if w not in self.places), key=len)
        parts: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in self._asked]
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        a = 0
        while a < len(new):
            size = int(sizes[a])
            step = max(1, 2_000_000 // (size * 16)) if size <= _LONG else 1
            part = new[a : min(a + step, int(np.searchsorted(sizes, size, "right")))]
            points = _points(part)
            for merging, found in zip(self._asked, parts, strict=True):
                if size > _LONG:
                    ids = np.array(self._merge_long(part[0]) if merging else self._viterbi_long(points[0]), np.int32)
                    found.append((ids, np.array([len(ids)])))
                else:
                    found.append(self._merge(points) if merging else self._viterbi(points))
            a += len(part)
        self.places.update(zip(new, range(len(self.places), len(self.places) + len(new)), strict=True))
        if new:
            self._held = [(np.concatenate([flat, *[x for x, _ in found]]), np.concatenate([starts, starts[-1] + np.cumsum(np.concatenate([x for _, x in found]))])) for (flat, starts), found in zip(self._held, parts, strict=True)]

    # texts

    def split(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct words, each place's word, and where each text's places begin. Words begin at a blank that follows another character."""
        plain = as_string(texts)
        if self.pieces.normalize:
            plain = pa.array([self.pieces.normalize(t) for t in plain.to_pylist()], pa.large_string())
        shown = pc.replace_substring(plain, " ", BLANK)
        if self.pieces.prefix:
            shown = pc.if_else(pc.equal(plain, ""), "", pc.binary_join_element_wise(pa.scalar(BLANK, pa.large_string()), shown, pa.scalar("", pa.large_string())))
        # no piece has a blank after another character, so words can be cut there; a blank is three bytes
        ends = np.frombuffer(shown.buffers()[1], np.int64)[shown.offset : shown.offset + len(shown) + 1]
        raw = np.frombuffer(shown.buffers()[2], np.uint8)[: ends[-1]] if len(shown) and ends[-1] else np.empty(0, np.uint8)
        blank = np.flatnonzero((raw[:-2] == 0xE2) & (raw[1:-1] == 0x96) & (raw[2:] == 0x81)) if len(raw) > 2 else np.empty(0, np.int64)
        # of blanks side by side the first begins a word
        cuts = np.concatenate([ends, blank[np.diff(blank, prepend=-4) != 3]])
        cuts.sort(kind="stable")
        cuts = cuts[np.diff(cuts, prepend=-1) > 0]
        words = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int64)), shown.buffers()[2]) if len(cuts) > 1 else pa.array([], pa.large_string())
        coded = words.dictionary_encode()
        return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), np.searchsorted(cuts, ends)

    def coded(self, distinct: list[str], *ways: bool) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each of ``ways`` the ids of these words end to end, and where each one's begin (and the last one's end)."""
        if ways != self._asked or len(self.places) + len(distinct) > _KNOWN_WORDS:
            self.places, self._asked = {}, ways
            self._held = [(np.empty(0, np.int32), np.zeros(1, np.int64)) for _ in ways]
        self.words(distinct)
        index = np.fromiter(map(self.places.__getitem__, distinct), np.int64, len(distinct))
        return [self.laid_out(flat, starts, index, slice(None)) for flat, starts in self._held]

    @staticmethod
    def laid_out(flat: np.ndarray, starts: np.ndarray, codes: np.ndarray, offsets: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and each text's offsets: the words ``codes``, whose ids ``coded`` gives."""
        sizes = np.diff(starts)[codes]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return flat[np.repeat(starts[:-1][codes] - ends[:-1], sizes) + np.arange(ends[-1])], ends[offsets]

    def encode(self, texts: pa.Array, merging: bool = False) -> tuple[np.ndarray, np.ndarray]:
        distinct, codes, offsets = self.split(texts)
        return self.laid_out(*self.coded(distinct, merging)[0], codes, offsets)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of ids; bytes that are no UTF-8 become replacement characters."""
        p = self.pieces
        if not hasattr(self, "_raw"):
            shown = [b"" if p.silent[i] else bytes([int(t[3:5], 16)]) if p.is_byte[i] else (" \u2047 " if i == p.unknown else t.replace(BLANK, " ")).encode() for i, t in enumerate(p.text)]
            self._raw = np.frombuffer(b"".join(shown), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in shown])])
        raw, starts = self._raw
        sizes = np.diff(starts)[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        flat = raw[np.repeat(starts[ids] - ends[:-1], sizes) + np.arange(ends[-1])].tobytes()
        out = [flat[ends[a] : ends[b]].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return [t[1:] if p.prefix and t.startswith(" ") else t for t in out]


def _points(words: list[str]) -> np.ndarray:
    """Code points of equally long words, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1)


ENCODED = "doc_id bigint, ids array<int>"
_codecs: dict[str, Codec] = {}


def _codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(Pieces(path))
    return _codecs[path]


def _encode(path: str, merging: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for part in text_slices(batches):
            ids, offsets = codec.encode(part.column("text"), merging)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))], ["doc_id", "ids"])

    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for part in batches:
            for a in range(0, part.num_rows, 256):
                some = part.slice(a, 256)
                lists = some.column("ids").fill_null([]) if some.column("ids").null_count else some.column("ids")
                offsets = lists.offsets.to_numpy().astype(np.int64)
                texts = codec.decode(lists.flatten().to_numpy(), offsets - offsets[0])
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def encode(docs: DataFrame, path: str, merging: bool = False) -> DataFrame:
    """doc_id and ids of every text of ``docs`` (doc_id, text), by the model in the file ``path``.

    The ids are those of the segmentation whose pieces' scores have the largest sum, of equal ones that with the longest last
    piece; with ``merging`` those that a BPE model's merges give, as the library does.
    A null or empty text has no ids. Texts are never cut. Characters without a piece are spelled as bytes where the model has
    them, else they are unknown. Repeated rows have repeated results, an empty table has none.
    """
    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_encode(path, merging), ENCODED)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of every row of ``encoded`` (doc_id, ids); null ids give an empty text."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(path), "doc_id bigint, text string")


def _agree(a: np.ndarray, starts: np.ndarray, b: np.ndarray, others: np.ndarray) -> np.ndarray:
    """For each run of ids whether it is the same in both, as 0 or 1."""
    sizes = np.diff(starts)
    same = (sizes == np.diff(others)).astype(np.int64)
    rows = np.flatnonzero(same & (sizes > 0))
    if len(rows):
        ends = np.cumsum(sizes[rows])
        first = np.repeat(starts[rows] - (ends - sizes[rows]), sizes[rows]) + np.arange(ends[-1])
        second = np.repeat(others[rows] - (ends - sizes[rows]), sizes[rows]) + np.arange(ends[-1])
        same[rows] = np.logical_and.reduceat(a[first] == b[second], ends - sizes[rows])
    return same


def _round_trip(path: str):
    import zlib

    def checksums(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        raw = memoryview(ids.astype("<u4").view(np.uint8))
        return pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for part in text_slices(batches):
            distinct, codes, starts = codec.split(part.column("text"))
            by_score, by_merge = codec.coded(distinct, False, True)
            ids, offsets = codec.laid_out(*by_score, codes, starts)
            back = codec.decode(ids, offsets)
            same = [a == b for a, b in zip(as_string(part.column("text")).to_pylist(), back, strict=True)]
            merged, ends = codec.laid_out(*by_merge, codes, starts)
            agreed = np.concatenate([[0], np.cumsum(_agree(*by_score, *by_merge)[codes])])
            columns = {
                "doc_id": part.column("doc_id"),
                "n_ids": pa.array(np.diff(offsets)),
                "ids_crc32": checksums(ids, offsets),
                "round_trip": pa.array(same),
                "n_words": pa.array(np.diff(starts)),
                "n_agree": pa.array(np.diff(agreed[starts])),
                "n_merged": pa.array(np.diff(ends)),
                "merged_crc32": checksums(merged, ends),
                "ids": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """What ``encode`` gives, whether decoding gives the text again, and how it stands to merging.

    doc_id, n_ids, ids_crc32 and ids are by Viterbi; n_merged and merged_crc32 by merging; n_words counts the words, n_agree
    those on which both agree. A null text counts as empty.
    """
    bounded_batches(docs.sparkSession)
    schema = "doc_id bigint, n_ids bigint, ids_crc32 bigint, round_trip boolean, n_words bigint, n_agree bigint, n_merged bigint, merged_crc32 bigint, ids array<int>"
    return docs.select("doc_id", "text").mapInArrow(_round_trip(path), schema)
