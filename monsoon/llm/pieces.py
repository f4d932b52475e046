"""SentencePiece-style encoding and decoding: batched Viterbi over a piece vocabulary in numpy.

A text is escaped (a space is U+2581, one more goes before the text), cut into words where no piece can cross, and the
batch's distinct words of equal length advance together: hashes of all their substrings of one length are probed in the
sorted piece keys, and at each end position the best score over piece lengths is kept with its length as backpointer.
Characters without a piece become byte pieces, or else one unknown piece for a run of them.  A word is also cut between any
two characters that stand side by side in no piece, which no segmentation can tell; so text without spaces in a script that
the vocabulary spells character by character gives short words.  Of the words that still have no company of their length,
long ones take the same recursion over the pieces found in them alone, as a vector step for one word costs as much as for
hundreds.

The score of a segmentation is the sum of its pieces' scores.  Files of the unigram kind hold log-probabilities.  Files
of the BPE kind hold merge ranks instead, whose sum means nothing; a rank r is scored as log-probability of Zipf's law,
-log((1 + r) * H).  The result is then the best segmentation under these scores, not the one of BPE's merges.

A file's normalisation is followed: its map of character sequences, the removal of extra white space, the dummy prefix.
"""

from __future__ import annotations

import re
import struct
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.llm.common import _col_of, map_batches

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)
_BUCKET_BITS = 18
_MASK = (1 << 64) - 1
#: A word of more characters that is alone of its length.
LONE = 24
#: Distinct words that a worker remembers, with their pieces (about 100 MB).
REMEMBER = 200_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at : at + size]
        at += size


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    dummy_prefix: bool = True
    collapse: bool = False
    charsmap: bytes = b""

    @staticmethod
    def parse(data: bytes) -> Vocabulary:
        pieces, scores, kinds, model, prefix, collapse, charsmap = [], [], [], UNIGRAM, True, True, b""
        for field, value in _fields(data):
            if field == 1:
                item = dict(_fields(value))
                pieces.append(item[1].decode())
                scores.append(struct.unpack("<f", item[2])[0] if 2 in item else 0.0)
                kinds.append(item.get(3, NORMAL))
            elif field == 2:
                told = dict(_fields(value))
                model = told.get(3, UNIGRAM)
                if model not in (UNIGRAM, BPE) or told.get(24):
                    raise ValueError("only unigram and BPE files with white space as prefix are supported")
            elif field == 3:
                norm = dict(_fields(value))
                prefix, collapse, charsmap = bool(norm.get(3, 1)), bool(norm.get(4, 1)), norm.get(2, b"")
                if not norm.get(5, 1):
                    raise ValueError("only files that escape white space are supported")
        if model == BPE:
            ranks = [max(0.0, -s) for s in scores]
            total = float(np.log(sum(1 / (1 + r) for r, k in zip(ranks, kinds, strict=True) if k == NORMAL)))
            scores = [-float(np.log1p(r)) - total for r in ranks]
        return Vocabulary(tuple(pieces), tuple(scores), tuple(kinds), prefix, collapse, charsmap)


class CharsMap:
    """The longest character sequences that a file replaces: a double array of 32-bit units, then the replacements."""

    def __init__(self, data: bytes):
        size = struct.unpack_from("<I", data)[0]
        self.units = np.frombuffer(data, "<u4", size // 4, 4).tolist()
        self.values = data[4 + size :]
        self.known: dict[str, str] = {}

    def _longest(self, data: bytes, at: int) -> tuple[int, int] | None:
        """Length and value of the longest entry that data begins with at `at`."""
        found, node = None, 0
        node ^= self._offset(self.units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, self.units[node] & 0x7FFFFFFF
        return found

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def _word(self, word: str) -> str:
        data, out, at = word.encode(), [], 0
        while at < len(data):
            found = self._longest(data, at)
            if found:
                size, value = found
                out.append(self.values[value : self.values.index(b"\0", value)])
            else:
                first = data[at]
                size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                out.append(data[at : at + size])
            at += size
        return b"".join(out).decode("utf-8", "replace")

    def __call__(self, text: str) -> str:
        """The text with all replacements; words between spaces are remembered."""
        out = []
        for word in re.findall(" +|[^ ]+", text):
            if word not in self.known:
                if len(self.known) > REMEMBER:
                    self.known.clear()
                self.known[word] = self._word(word)
            out.append(self.known[word])
        return "".join(out)


def _hash(points: np.ndarray) -> np.ndarray:
    """Prefix hashes (rows, n + 1) of code point rows."""
    out = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
    for j in range(points.shape[1]):
        out[:, j + 1] = out[:, j] * _BASE + points[:, j] + np.uint64(1)
    return out


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        use = [i for i, k in enumerate(vocabulary.kinds) if k in (NORMAL, USER) and vocabulary.pieces[i]]
        self.longest = max((len(vocabulary.pieces[i]) for i in use), default=1)
        keys = np.array([int(_hash(np.frombuffer(vocabulary.pieces[i].encode("utf-32-le"), np.uint32)[None, :])[0, -1]) for i in use], np.uint64) * _MULT
        order = np.argsort(keys, kind="stable")
        self.keys, self.ids = keys[order], np.array(use, np.int32)[order]
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces have the same hash")
        # where the keys with given top bits begin, and how many there are at most
        top = (self.keys >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
        self.begin = np.searchsorted(top, np.arange((1 << _BUCKET_BITS) + 1)).astype(np.int32)
        self.depth = int(np.diff(self.begin).max()) if len(use) else 0
        self.keys = np.concatenate((self.keys, np.zeros(self.depth + 1, np.uint64)))
        self.ids = np.concatenate((self.ids, np.full(self.depth + 1, -1, np.int32)))
        known = [vocabulary.scores[i] for i in use]
        # id -1, of no piece, has the score at the end
        self.scores = np.array([*vocabulary.scores, -np.inf])
        self.unknown = min(known, default=0.0) - 10.0
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(vocabulary.pieces, vocabulary.kinds, strict=True)) if k == BYTE}
        self.unk = next((i for i, k in enumerate(vocabulary.kinds) if k == UNKNOWN), 0)
        self.map = CharsMap(vocabulary.charsmap) if vocabulary.charsmap else None
        sides = [np.frombuffer(vocabulary.pieces[i].encode("utf-32-le"), np.uint32).astype(np.uint64) for i in use if len(vocabulary.pieces[i]) > 1]
        self.pairs = np.unique(np.concatenate([p[:-1] << np.uint64(32) | p[1:] for p in sides])) if sides else np.empty(0, np.uint64)
        self._forget()
        crossing = any(SPACE in vocabulary.pieces[i].lstrip(SPACE) for i in use)
        lines = any("\n" in vocabulary.pieces[i] and len(vocabulary.pieces[i]) > 1 for i in use)
        if crossing:
            self.word = re.compile("(?s).+")
        else:
            self.word = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if lines else f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")

    def probe(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each substring hash, else -1."""
        key = hashes * _MULT
        at = self.begin[(key >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)]
        out = np.full(key.shape, -1, np.int32)
        for _ in range(self.depth):
            hit = self.keys[at] == key
            np.copyto(out, self.ids[at], where=hit)
            at = at + 1
        return out

    def _cut(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """The words' parts between which no piece can lie, and how many each word has."""
        if not words or not len(self.pairs):
            return [c for w in words for c in w], np.array([len(w) for w in words], np.int64)
        flat = "".join(words)
        points = np.frombuffer(flat.encode("utf-32-le"), np.uint32).astype(np.uint64)
        pair = points[:-1] << np.uint64(32) | points[1:]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        cut = np.concatenate(([True], self.pairs[at] != pair))
        ends = np.cumsum([len(w) for w in words])
        cut[ends[:-1]] = True
        if not self.bytes:
            # a run of characters without a piece is one unknown piece, so it isn't cut
            alone = self.probe(points * np.uint64(1) + np.uint64(1)) < 0
            inside = np.concatenate(([False], alone[1:] & alone[:-1]))
            inside[ends[:-1]] = False
            cut &= ~inside
        start = np.flatnonzero(cut)
        stop = np.append(start[1:], len(flat))
        return [flat[s:e] for s, e in zip(start.tolist(), stop.tolist(), strict=True)], np.diff(np.concatenate(([0], np.searchsorted(start, ends))))

    def _sparse(self, points: np.ndarray, found: list) -> list[int]:
        """The pieces of one word from the end backwards, by the same recursion over the pieces that occur in it."""
        n = len(points)
        ends, sizes, ids = [], [], []
        for size in range(1, len(found)):
            own = found[size][:, 0]
            start = np.flatnonzero(own >= 0) if size > 1 else np.arange(n)
            ends.append(start + size)
            sizes.append(np.full(len(start), size))
            ids.append(own[start])
        ends, sizes, ids = np.concatenate(ends), np.concatenate(sizes), np.concatenate(ids)
        order = np.lexsort((-sizes, ends))
        ends, sizes, ids = ends[order], sizes[order], ids[order]
        score = np.where(ids < 0, self.unknown, self.scores[ids])
        best, back = [0.0] + [-np.inf] * n, [(0, -1)] * (n + 1)
        for end, size, piece, value in zip(ends.tolist(), sizes.tolist(), ids.tolist(), score.tolist(), strict=True):
            value += best[end - size]
            if value > best[end]:
                best[end], back[end] = value, (size, piece)
        out, at = [], n
        while at > 0:
            size, piece = back[at]
            out.append(piece if piece >= 0 else -2 - int(points[at - 1]))
            at -= size
        return out

    def _viterbi(self, words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of words of n characters, the pieces (rows, most) from the end backwards and how many; an unknown character is
        -2 minus its code point."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, n).T.copy()
        rows = np.arange(len(words))
        prefix = np.zeros((n + 1, len(words)), np.uint64)
        for j in range(n):
            prefix[j + 1] = prefix[j] * _BASE + points[j] + np.uint64(1)
        found, power = [None], 1
        for size in range(1, min(n, self.longest) + 1):
            power = power * int(_BASE) & _MASK
            found.append(self.probe(prefix[size:] - prefix[:-size] * np.uint64(power)))
        if len(words) == 1 and n > LONE:
            backwards = self._sparse(points[:, 0], found)
            return np.array([backwards], np.int64), np.array([len(backwards)])
        best = np.full((n + 1, len(words)), -np.inf)
        best[0] = 0
        back = np.zeros((n + 1, len(words)), np.int32)
        piece = np.full((n + 1, len(words)), -1, np.int32)
        for j in range(1, n + 1):
            for size in range(min(j, self.longest), 0, -1):
                ids = found[size][j - size]
                score = self.scores[ids]
                if size == 1:
                    score = np.where(ids < 0, self.unknown, score)
                score += best[j - size]
                better = score > best[j]
                np.copyto(best[j], score, where=better)
                np.copyto(back[j], size, where=better)
                np.copyto(piece[j], ids, where=better)
        out, count, at = [], np.zeros(len(words), np.int64), np.full(len(words), n)
        while (live := at > 0).any():
            ids = piece[at, rows].astype(np.int64)
            lost = np.flatnonzero(live & (ids < 0))
            ids[lost] = -2 - points[at[lost] - 1, lost].astype(np.int64)
            out.append(ids)
            count += live
            at = at - back[at, rows]
        return np.stack(out, axis=1), count

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The concatenated ids of distinct words, and each word's count."""
        parts, many = self._cut(words)
        index: dict[str, int] = {}
        of = np.fromiter((index.setdefault(p, len(index)) for p in parts), np.int64, len(parts))
        flat, counts = self._parts(list(index))
        start, own = np.cumsum(counts) - counts, counts[of]
        ends = np.cumsum(own)
        ids = flat[np.arange(len(flat) if not len(of) else ends[-1]) + np.repeat(start[of] - (ends - own), own)] if len(of) else flat[:0]
        stops = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(many)))]
        return ids, np.diff(stops)

    def _parts(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for parts that aren't cut any more."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        counts = np.zeros(len(words), np.int64)
        parts = []
        for n in np.unique(lengths):
            own = np.flatnonzero(lengths == n)
            block = max(1, 100_000 // int(n))
            for at in range(0, len(own), block):
                some = own[at : at + block]
                backwards, count = self._viterbi([words[i] for i in some], int(n))
                parts.append((some, backwards, count))
                counts[some] = count
        start = np.concatenate(([0], np.cumsum(counts)))
        flat = np.empty(start[-1], np.int64)
        for some, backwards, count in parts:
            for step in range(backwards.shape[1]):
                live = count > step
                flat[start[some[live]] + count[live] - 1 - step] = backwards[live, step]
        if (flat < 0).any():
            of = np.repeat(np.arange(len(words)), counts)
            if not self.bytes:
                lost = flat < 0
                more = np.concatenate(([False], lost[1:] & lost[:-1] & (of[1:] == of[:-1])))
                flat = np.where(lost, self.unk, flat)[~more]
                return flat.astype(np.int32), np.bincount(of[~more], minlength=len(words)).astype(np.int64)
            size = np.ones(len(flat), np.int64)
            spelled = {int(x): self._spell(int(-2 - x)) for x in np.unique(flat[flat < 0])}
            for x, ids in spelled.items():
                size[flat == x] = len(ids)
            counts = np.bincount(of, weights=size, minlength=len(words)).astype(np.int64)
            first = np.concatenate(([0], np.cumsum(size)))[:-1]
            wide = np.repeat(flat, size)
            for x, ids in spelled.items():
                for i, piece in enumerate(ids):
                    wide[first[flat == x] + i] = piece
            flat = wide
        return flat.astype(np.int32), counts

    def _spell(self, point: int) -> list[int]:
        data = chr(point).encode()
        return [self.bytes[x] for x in data] if all(x in self.bytes for x in data) else [self.unk]

    def _forget(self) -> None:
        """Words get numbers in the order in which they are first met."""
        if hasattr(self, "index"):
            # the factory is a method of its own dictionary, a cycle that would outlive it
            self.index.default_factory = None
            self.index.clear()
        self.index: defaultdict[str, int] = defaultdict()
        self.index.default_factory = self.index.__len__
        self.flat, self.counts = np.empty(0, np.int32), np.empty(0, np.int64)
        self.start, self.exact = np.empty(0, np.int64), np.empty(0, bool)

    def normalised(self, text: str) -> str:
        if self.map:
            text = self.map(text)
        return re.sub(" {2,}", " ", text.strip(" ")) if self.v.collapse else text

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The concatenated ids of the texts, each text's count, and whether it decodes to itself."""
        if len(self.index) > REMEMBER:
            self._forget()
        known, of, number = len(self.index), [], self.index.__getitem__
        changed = [self.normalised(t) != t for t in texts] if self.map or self.v.collapse else []
        for text in texts:
            escaped = self.normalised(text).replace(" ", SPACE)
            if self.v.dummy_prefix and escaped:
                escaped = SPACE + escaped
            words = self.word.findall(escaped)
            of.append(np.fromiter(map(number, words), np.int64, len(words)))
        if new := list(islice(self.index, known, None)):
            flat, counts = self.words(new)
            surface, at = _surfaces(self.v), 0
            exact = np.empty(len(new), bool)
            pieces = flat.tolist()
            for i, (word, n) in enumerate(zip(new, counts.tolist(), strict=True)):
                exact[i] = b"".join([surface[x] for x in pieces[at : at + n]]) == word.encode()
                at += n
            self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(counts) - counts))
            self.flat, self.counts = np.concatenate((self.flat, flat)), np.concatenate((self.counts, counts))
            self.exact = np.concatenate((self.exact, exact))
        words = np.concatenate(of) if of else np.empty(0, np.int64)
        count = self.counts[words]
        ends = np.concatenate(([0], np.cumsum(count)))
        ids = self.flat[np.arange(ends[-1]) + np.repeat(self.start[words] - ends[:-1], count)]
        cuts = np.cumsum([0, *map(len, of)])
        wrong = np.concatenate(([0], np.cumsum(~self.exact[words])))
        same = (np.diff(wrong[cuts]) == 0) & np.array([SPACE not in t for t in texts], bool)
        if changed:
            same &= ~np.array(changed, bool)
        return ids, np.diff(ends[cuts]), same

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text of ids; control pieces have none, invalid bytes become U+FFFD."""
        table = _surfaces(self.v)
        text = b"".join([table[i] for i in ids]).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if self.v.dummy_prefix and text.startswith(" ") else text


@lru_cache(4)
def _surfaces(v: Vocabulary) -> list[bytes]:
    out = []
    for piece, kind in zip(v.pieces, v.kinds, strict=True):
        out.append(bytes([int(piece[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else piece.encode())
    return out


@lru_cache(4)
def _encoder(data: bytes) -> Encoder:
    return Encoder(Vocabulary.parse(data))


def _encode(model: bytes, kind: pa.DataType, chars: int):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encoder, texts = _encoder(model), batch.column(1).to_pylist()
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop] or "") < chars):
                size += len(texts[stop] or "")
                stop += 1
            some = texts[at:stop]
            ids, counts, same = encoder.encode([t or "" for t in some])
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            null = np.array([t is None for t in some])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32(), mask=np.concatenate((null, [False]))), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, stop - at).cast(kind), lists, pa.array(counts, pa.int64(), mask=null), pa.array(same, pa.bool_(), mask=null)],
                ["id", "ids", "n_tokens", "round_trip"],
            )
            at = stop

    return run


def encode(spark: SparkSession, docs: DataFrame, model: str = DEFAULT_MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: id, ids (array<int>), n_tokens (long), round_trip (decoding gives the text again).

    A null text has null results, an empty one no tokens.  round_trip is false only for texts with U+2581, which decodes to
    a space, with characters that the vocabulary cannot spell, or that the file's normalisation changes.  Whole texts are encoded, of any length; memory is bound
    by the longest text.  Repeated rows and null ids get rows of their own.  The model file (about 500 kB) goes to the
    executors with the task; other columns aren't read.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    with open(model, "rb") as file:
        data = file.read()
    kind = docs.select(id_col).schema[0].dataType
    plain = docs.select(_col_of(id_col).alias("id"), _col_of(text_col).cast("string").alias("text"))
    return map_batches(plain, _encode(data, to_arrow_type(kind), 1_000_000), f"id {kind.simpleString()}, ids array<int>, n_tokens long, round_trip boolean", 4096)


def decode(spark: SparkSession, encoded: DataFrame, model: str = DEFAULT_MODEL, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """id and text of each row of encoded; null ids give a null text."""
    from pyspark.sql.pandas.types import to_arrow_type

    with open(model, "rb") as file:
        data = file.read()
    kind = encoded.select(id_col).schema[0].dataType
    arrow = to_arrow_type(kind)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(data)
        texts = [None if x is None else encoder.decode(x) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow), pa.array(texts, pa.string())], ["id", "text"])

    return map_batches(encoded.select(_col_of(id_col).alias("id"), F.col(ids_col).alias("ids")), run, f"id {kind.simpleString()}, text string")
