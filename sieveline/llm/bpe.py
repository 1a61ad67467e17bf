"""Byte-level BPE by a rank queue on a hierarchical bitmap.

A slice of texts is cut at spaces that no match of the pattern reaches over, and Arrow
finds the distinct pieces; their distinct pre-tokens that aren't known yet are laid behind
one another in one linked list with breaks between them. Every place whose pair has a
merge is put into the bucket of that merge's rank. A bitmap of three levels, 64 bits a
word, tells by find-first-set which bucket is the next; a bucket's places are merged from
left to right, and a place whose pair has changed since it was put there is stale and
skipped. A large bucket is merged at once by array operations, a small one place by place.
A merge costs the same however long its pre-token is, so one pre-token of a million bytes
is no slower, byte for byte, than short ones.

The ids of the texts are then gathered from those of the pieces, and the bytes from those
of the ids. Short pre-tokens are kept for later slices, up to a bound in bytes. All of it is
local to a task: nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from sieveline.llm.common import only, pieces_of

#: Bytes that the pre-tokens a worker keeps may take up, with what Python needs for each beside its text.
KEPT_BYTES, EACH = 64 << 20, 160
#: The id of a break between pre-tokens; no vocabulary has as many.
BREAK = 0xFFFFFF
#: Places of a bucket from which on array operations take less time.
MANY = 48
#: Bytes of the texts that are encoded at a time; a longer text is a slice of its own.
SLICE = 8 << 20
#: Fixed value: the pattern whose matches never reach over a single space between two characters that aren't white space.
SPACED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: ASCII bytes that may be white space.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True


class RankQueue:
    """Buckets of places by rank; ``pop`` gives the places of the lowest rank that has any."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.levels = [[0] * ((ranks >> 6 * (k + 1)) + 1) for k in range(3)]

    def put(self, rank: int, places: list[int]) -> None:
        held = self.buckets.get(rank)
        if held is not None:
            held += places
            return
        self.buckets[rank] = places
        for level in self.levels:
            word = rank >> 6
            level[word] |= 1 << (rank & 63)
            rank = word

    def put_all(self, ranks: np.ndarray, places: np.ndarray) -> None:
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, listed = ranks[order], places[order].tolist()
        begin = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1]))
        ends = [*begin[1:].tolist(), len(listed)]
        for r, i, j in zip(ranks[begin].tolist(), begin.tolist(), ends):
            self.put(r, listed[i:j])

    def pop(self) -> tuple[int, list[int]] | None:
        top = self.levels[2]
        word = next((i for i, w in enumerate(top) if w), -1)
        if word < 0:
            return None
        rank = word
        for level in (top, self.levels[1], self.levels[0]):
            w = level[rank]
            rank = rank << 6 | (w & -w).bit_length() - 1
        places = self.buckets.pop(rank)
        at = rank
        for level in self.levels:  # clears upwards for as long as words become empty
            level[at >> 6] &= ~(1 << (at & 63))
            if level[at >> 6]:
                break
            at >>= 6
        return rank, places


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``starts``, one behind the other; worked out for a million items at a time."""
    ends = np.cumsum(lengths)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=flat.dtype)
    kind = np.int32 if len(flat) < 1 << 30 else np.int64
    i = done = 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, done + (1 << 20), "right")))
        at = np.repeat((starts[i:j] - (ends[i:j] - lengths[i:j] - done)).astype(kind), lengths[i:j])
        at += np.arange(len(at), dtype=kind)
        out[done : done + len(at)] = flat[at]
        done += len(at)
        i = j
    return out


class Vocabulary:
    """The merges and texts of a ranks file, and the ids of what has been encoded."""

    def __init__(self, path: str, pattern: str, kept_bytes: int = KEPT_BYTES):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.ranks, self.kept_bytes = ranks, kept_bytes
        self.pattern, self.spaced = regex.compile(pattern), pattern == SPACED
        self.size = max(ranks.values()) + 1
        texts = [b""] * self.size
        for text, rank in ranks.items():
            texts[rank] = text
        self.bytes = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.lengths = np.array([len(t) for t in texts])
        self.starts = np.cumsum(self.lengths) - self.lengths
        byte = np.array([ranks[bytes([i])] for i in range(256)])
        merges: dict[int, int] = {}
        for text, rank in ranks.items():
            for i in range(1, len(text)):
                a, b = ranks.get(text[:i]), ranks.get(text[i:])
                if a is not None and b is not None:
                    merges[a << 24 | b] = rank
        self.merges, self.byte = merges, byte
        self.keys = np.array(sorted(merges))
        self.key_ranks = np.array([merges[k] for k in self.keys.tolist()])
        two = np.arange(65536)
        self.byte_pairs = self._ranks_of(byte[two >> 8] << 24 | byte[two & 255]).astype(np.int32)
        # Ids that may merge to a lower rank than their own: such a merge comes before the rest of their bucket.
        parts = np.concatenate([self.keys >> 24, self.keys & BREAK])
        self.falling = set(parts[np.tile(self.key_ranks, 2) < parts].tolist())
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.held, self.ids, self.used = 0, np.zeros(1 << 16, dtype=np.uint32), 0
        self.begin, self.count = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int64)

    def _ranks_of(self, keys: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge, or -1."""
        slot = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[slot] == keys, self.key_ranks[slot], -1)

    def merged(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pre-tokens by merging, one behind the other, and how many each has."""
        if not tokens:
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        # A break stands first, and after each pre-token; it pairs with nothing.
        raw = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        ends = np.cumsum(lengths + 1)
        size = len(raw) + len(tokens) + 1
        inside = np.ones(size, dtype=bool)
        inside[0] = False
        inside[ends] = False
        at = np.flatnonzero(inside)
        ids = np.full(size + 1, BREAK, dtype=np.int32)
        ids[at] = self.byte[raw]
        ranked = np.full(size + 1, -1, dtype=np.int32)
        first = np.flatnonzero(np.diff(at) == 1)
        ranked[at[first]] = self.byte_pairs[raw[first].astype(np.int32) << 8 | raw[first + 1]]
        after, before = np.arange(1, size + 2, dtype=np.int32), np.arange(-1, size, dtype=np.int32)
        queue = RankQueue(self.size)
        held = np.flatnonzero(ranked >= 0)
        queue.put_all(ranked[held], held)
        every = (ids, ranked, after, before)
        views = tuple(map(memoryview, every))
        while (found := queue.pop()) is not None:
            rank, places = found
            if len(places) < MANY or not self._merge_many(queue, rank, places, *every):
                self._merge_few(queue, rank, places, *views)
        kept = inside & (ranked[:size] != -2)
        return ids[:size][kept].astype(np.uint32), np.add.reduceat(kept, ends - lengths, dtype=np.int64)

    def _merge_many(self, queue: RankQueue, rank: int, places: list[int], ids: np.ndarray, ranked: np.ndarray, after: np.ndarray, before: np.ndarray) -> bool:
        """Merges the places at once; not if that leads to a merge that comes before the rest of them."""
        i = np.array(places, dtype=np.int32)
        i.sort()
        i = i[ranked[i] == rank]
        if not len(i):
            return True
        follows = np.append(False, (after[i[:-1]] == i[1:]) | (i[:-1] == i[1:]))
        if follows.any():
            # Of places that overlap in a row, and of a place that is listed twice, the first is merged.
            i = i[np.append(True, i[1:] != i[:-1])]
            follows = np.append(False, after[i[:-1]] == i[1:])
            row = np.maximum.accumulate(np.where(follows, 0, np.arange(len(i))))
            i = i[(np.arange(len(i)) - row) % 2 == 0]
        j = after[i]
        k = after[j]
        if rank in self.falling:
            h = before[i]
            left_ids = ids[h].astype(np.int64)
            left_ids[1:][h[1:] == j[:-1]] = rank  # the place before is merged first
            met = np.concatenate([self._ranks_of(rank << 24 | ids[k].astype(np.int64)), self._ranks_of(left_ids << 24 | rank)])
            if ((met >= 0) & (met < rank)).any():
                return False
        ids[i] = rank
        ranked[j] = -2
        after[i] = k
        before[k] = i
        h = before[i]
        right = self._ranks_of(rank << 24 | ids[k].astype(np.int64))
        left = self._ranks_of(ids[h].astype(np.int64) << 24 | rank)
        ranked[i] = right
        ranked[h] = left  # where the place before was merged too, both say the same
        r, p = np.concatenate([right, left]), np.concatenate([i, h])
        new = r >= 0
        queue.put_all(r[new], p[new])
        return True

    def _merge_few(self, queue: RankQueue, rank: int, places: list[int], ids, ranked, after, before) -> None:  # noqa: ANN001
        find, buckets, put = self.merges.get, queue.buckets, queue.put
        places.sort()
        for n, i in enumerate(places):
            if ranked[i] != rank:  # stale
                continue
            j = after[i]
            k = after[j]
            h = before[i]
            ids[i] = rank
            ranked[j] = -2
            after[i] = k
            before[k] = i
            ranked[i] = right = find(rank << 24 | ids[k], -1)
            if right >= 0:
                if right in buckets:
                    buckets[right].append(i)
                else:
                    put(right, [i])
            ranked[h] = left = find(ids[h] << 24 | rank, -1)
            if left >= 0:
                if left in buckets:
                    buckets[left].append(h)
                else:
                    put(left, [h])
            if 0 <= right < rank or 0 <= left < rank:  # that merge comes before the rest
                if n + 1 < len(places):
                    put(rank, places[n + 1 :])
                return

    def _learn(self, words: list[bytes]) -> None:
        """Keeps the ids of these words, which are distinct and new."""
        whole = list(map(self.ranks.get, words))  # a pre-token of the vocabulary is one id, whatever its merges
        ids, counts = self.merged([w for w, r in zip(words, whole) if r is None])
        one = np.array([r is not None for r in whole], dtype=bool)
        count = np.ones(len(words), dtype=np.int64)
        count[~one] = counts
        begin = self.used + np.cumsum(count) - count
        size, first, self.used = len(self.known), self.used, self.used + int(count.sum())
        if self.used > len(self.ids):
            self.ids = np.concatenate([self.ids[:first], np.zeros(self.used, dtype=np.uint32)])
        if size + len(words) > len(self.begin):
            more = np.zeros(size + len(words), dtype=np.int64)
            self.begin, self.count = np.concatenate([self.begin[:size], more]), np.concatenate([self.count[:size], more])
        part = self.ids[first : self.used]
        single = np.zeros(len(part), dtype=bool)
        single[begin[one] - first] = True
        part[single] = [r for r in whole if r is not None]
        part[~single] = ids
        self.begin[size : size + len(words)], self.count[size : size + len(words)] = begin, count
        self.known.update(zip(words, range(size, size + len(words))))
        self.held += sum(map(len, words)) + EACH * len(words) + 4 * len(part)

    def _slots(self, words: list[bytes]) -> np.ndarray:
        """The numbers of distinct words among those kept; new ones are learnt."""
        if self.held > self.kept_bytes:
            self._forget()
        new = [w for w in words if w not in self.known]
        if new:
            self._learn(new)
        return np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))

    def _words(self, pieces: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The pre-tokens of all pieces, and where each piece's begin and how many it has."""
        plain = np.array([self.spaced and len(p) > 1 and p[0] == " " and not p[1].isspace() and not p[-1].isspace() for p in pieces], dtype=bool)
        # Pieces that begin with a space and end without one match alike behind one another.
        together = [pieces[i] for i in np.flatnonzero(plain).tolist()]
        words = self.pattern.findall("".join(together))
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
        upto = np.searchsorted(ends, np.cumsum([len(p) for p in together])) + 1
        count = np.zeros(len(pieces), dtype=np.int64)
        count[plain] = np.diff(np.append(0, upto))
        begin = np.zeros(len(pieces), dtype=np.int64)
        begin[plain] = upto - count[plain]
        for i in np.flatnonzero(~plain).tolist():
            own = self.pattern.findall(pieces[i])
            begin[i], count[i] = len(words), len(own)
            words += own
        return words, begin, count

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one behind the other, and the place where each text's begin, with the end of the last."""
        pieces, of = cut_safely(texts, self.spaced)
        if not len(pieces):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(texts) + 1, dtype=np.int64)
        coded = pieces.dictionary_encode()
        words, first, n_words = self._words(coded.dictionary.to_pylist())
        named = pa.array(words, pa.string()).dictionary_encode()
        slots = self._slots(named.dictionary.cast(pa.binary()).to_pylist())[named.indices.to_numpy()]
        count = self.count[slots]
        ids = gathered(self.ids, self.begin[slots], count)
        upto = np.append(0, np.cumsum(count))
        begin, count = upto[first], upto[first + n_words] - upto[first]
        index = coded.indices.to_numpy()
        count = count[index]
        ends = np.append(0, np.cumsum(np.bincount(of, count, len(texts)).astype(np.int64)))
        return gathered(ids, begin[index], count), ends

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids."""
        return gathered(self.bytes, self.starts[ids], self.lengths[ids])


def cut_safely(texts: pa.Array, spaced: bool = True) -> tuple[pa.Array, np.ndarray]:
    """The texts' pieces, and the number of each one's text. A null or empty text has none.

    A piece ends before a single space between two characters that aren't white space: no
    match of the pattern reaches over such a place, so the pieces encode on their own.
    Without ``spaced`` each text is one piece.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    at = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    starts = at[:-1][np.diff(at) > 0]
    if spaced and len(data) > 2:
        p = np.flatnonzero(data[1:-1] == 32) + 1
        p = p[~SPACE[data[p - 1]] & ~SPACE[data[p + 1]]]
        wide = (data[p - 1] >= 0x80) | (data[p + 1] >= 0x80)
        q = p[wide]
        one, two, three = data[q - 1], data[q - 2], data[np.maximum(q, 3) - 3]
        four, five = data[q + 1], data[np.minimum(q + 2, len(data) - 1)]
        unsafe = (two == 0xC2) & ((one == 0x85) | (one == 0xA0)) | _wide_space(three, two) | (four == 0xC2) & ((five == 0x85) | (five == 0xA0)) | _wide_space(four, five)
        begins = np.zeros(len(data), dtype=bool)
        begins[starts] = True
        begins[p[~wide]] = True
        begins[q[~unsafe]] = True
        starts = np.flatnonzero(begins)
    ends = np.append(starts, np.int32(len(data))).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return pieces, np.searchsorted(at, starts, side="right") - 1


def _wide_space(lead: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Whether a character of three bytes may be white space, by its first two."""
    return (lead == 0xE1) & (following == 0x9A) | (lead == 0xE2) & ((following == 0x80) | (following == 0x81)) | (lead == 0xE3) & (following == 0x80)


_LOADED: dict[tuple, Vocabulary] = {}


def vocabulary(path: str, pattern: str, kept_bytes: int = KEPT_BYTES) -> Vocabulary:
    """The vocabulary of this process."""
    key = (path, pattern, kept_bytes)
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(path, pattern, kept_bytes)
    return _LOADED[key]


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE) -> DataFrame:
    """``(doc_id, ids, decoded)``: the token ids of every whole text and the bytes that they decode to.

    A null text counts as empty: no ids, no bytes. Repeated rows stay repeated; an empty
    table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for part in pieces_of(batches, 1, slice_bytes):
            ids, ends = vocab.encode(part.column(1))
            held = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.view(np.int32)))
            upto = np.append(0, np.cumsum(vocab.lengths[ids]))[ends]
            decoded = pa.Array.from_buffers(pa.binary(), len(held), [None, pa.py_buffer(upto.astype(np.int32)), pa.py_buffer(vocab.decode(ids))])
            yield pa.RecordBatch.from_arrays([part.column(0), held, decoded], names=["doc_id", "ids", "decoded"])

    return only(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE, kept_bytes: int = KEPT_BYTES) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: :func:`encoded` with digests in place of ids and bytes, made where they are.

    A null text counts as empty: no tokens, and the digests of no bytes. Repeated rows stay
    repeated; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern, kept_bytes)
        digest = lambda raw, ends: pa.array([hashlib.sha256(raw[i:j]).hexdigest() for i, j in zip(ends.tolist(), ends[1:].tolist())])
        for part in pieces_of(batches, 1, slice_bytes):
            ids, ends = vocab.encode(part.column(1))
            upto = np.append(0, np.cumsum(vocab.lengths[ids]))[ends]
            raw, back = memoryview(ids.astype("<u4")).cast("B") if len(ids) else b"", vocab.decode(ids)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(ends)), digest(raw, ends * 4), digest(memoryview(back) if len(back) else b"", upto)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return only(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def decode_ids(rows: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, decoded)`` of rows that hold token ids; null ids decode to no bytes."""
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for batch in batches:
            out = [vocab.decode(np.array(x or [], dtype=np.int64)).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "decoded"])

    return only(rows, id_col, ids_col).mapInArrow(run, f"doc_id {kind}, decoded binary")
