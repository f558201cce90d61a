"""Encoding and decoding with a SentencePiece BPE vocabulary, by suffix-array matching.

The texts of a batch are cut where a space follows another character; no piece crosses such a place, so
distinct segments are encoded once. Their concatenation is indexed by a suffix array; every piece of the
vocabulary is looked up in it by binary search, and its range gives all its occurrences. These edges,
sorted by position, form the lattice of the batch. It is relaxed as the vocabulary's own merge order asks:
starting from single characters, the best-scored edge over two neighbouring symbols, leftmost among
equals, contracts them until none is left, in all segments at once. (A shortest path over the scores, as
a unigram vocabulary wants it, would give other ids than this vocabulary's own encoder.) Characters that
are no piece become bytes.

The vocabulary has to keep texts as they are but for the space mark: its path is a parameter, it is read on
the driver and travels with the job.

Defined cases: a null or empty text has no pieces and decodes to an empty text; the space mark U+2581 in a
text reads as a space, as in the reference encoder; long segments are contracted one by one with a heap; an empty
table gives no rows; repeated rows and ids are ordinary rows; other columns are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneloom.llm.common import BASE, BASE_INVERSE, LETTERS, kept_powers, mix, slices, small_batches, text_bytes

MARK = "▁"
BATCH_BYTES = 12 << 20
INDEX_BYTES = 1 << 18
WIDEST = 48  # characters in a segment that is contracted side by side with others
REACH = 64  # bytes that a piece has at most
CODES = 128  # for keys of an edge: position times this plus length


class Vocabulary:
    """Pieces as bytes with spaces for marks, their scores, and the ids of bytes and of the unknown."""

    def __init__(self, pieces: list[bytes], scores: list[float], bytes_at: list[int], unknown: int, plain: list[bool]):
        self.pieces, self.scores = pieces, np.array(scores, np.float32)
        self.bytes_at, self.unknown = bytes_at, unknown
        self.scores[~np.array(plain, bool)] = -np.inf
        order = sorted((i for i, ok in enumerate(plain) if ok), key=lambda i: pieces[i])
        self.order = np.array(order, np.int32)
        self.sorted = [pieces[i] for i in order]
        if any(b" " in p.lstrip(b" ") or not 0 < len(p) <= REACH for p in self.sorted):
            raise ValueError("a piece crosses a word start or is too long")

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        names = [model.id_to_piece(i) for i in range(n)]
        kinds = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        bytes_at = [-1] * 256
        for i in range(n):
            if model.is_byte(i):
                bytes_at[int(names[i][3:5], 16)] = i
        shown = [bytes([bytes_at.index(i)]) if model.is_byte(i) else b"" if model.is_control(i) else x.replace(MARK, " ").encode()
                 for i, x in enumerate(names)]
        return cls(shown, [model.get_score(i) for i in range(n)], bytes_at, model.unk_id(), [not k for k in kinds])


# ---- index and lattice


def _eight(padded: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as one number."""
    out = np.zeros(len(at), np.uint64)
    for k in range(8):
        out |= padded[at + k].astype(np.uint64) << np.uint64(56 - 8 * k)
    return out


def suffix_order(text: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order of the ``left`` bytes up to the end of their segment, their first 8 bytes as one number).

    Sorted by 8 bytes; groups of equals are sorted further, 8 bytes at a time, as far as segments reach.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(REACH + 8, np.uint8)])
    # bytes behind a segment do not count
    cover = np.append(np.array([((1 << 64) - 1) ^ ((1 << (64 - 8 * k)) - 1) for k in range(8)], np.uint64), np.uint64((1 << 64) - 1))
    first = _eight(padded, np.arange(n)) & cover[np.minimum(left, 8)]
    order = np.argsort(first)
    sorted_first = first[order]
    group = np.cumsum(np.append(False, sorted_first[1:] != sorted_first[:-1]))
    slots = np.arange(n)
    for k in range(8, REACH, 8):
        where = order[slots]
        go = left[where] > k
        slots, where, group = slots[go], where[go], group[go]
        size = np.bincount(group, minlength=1)[group] if len(group) else group
        slots, where, group = slots[size > 1], where[size > 1], group[size > 1]
        if not len(slots):
            break
        key = _eight(padded, where + k) & cover[np.minimum(left[where] - k, 8)]
        by = np.lexsort((key, group))
        order[slots] = where[by]
        key, group = key[by], group[by]
        group = np.cumsum(np.append(False, (key[1:] != key[:-1]) | (group[1:] != group[:-1])))
    return order, sorted_first


def occurrences(text: np.ndarray, left: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, length, piece) of every occurrence of every piece, sorted by position and length."""
    order, first = suffix_order(text, left)
    size = np.array([len(p) for p in vocabulary.sorted], np.int64)
    heads = np.frombuffer(b"".join(p[:8].ljust(8, b"\0") for p in vocabulary.sorted), ">u8").astype(np.uint64)
    short = np.minimum(size, 8)
    spare = np.where(short == 8, np.uint64(0), (np.uint64(1) << (8 * (8 - short)).astype(np.uint64)) - np.uint64(1))
    lo, hi = np.searchsorted(first, heads, "left"), np.searchsorted(first, heads | spare, "right")
    padded = np.concatenate([text, np.zeros(REACH + 8, np.uint8)])

    # longer pieces: the range narrows by the next 8 bytes, by binary search in all ranges at once
    for k in range(8, REACH, 8):
        long = np.flatnonzero((size > k) & (hi > lo))
        if not len(long):
            break
        head = np.frombuffer(b"".join(vocabulary.sorted[i][k : k + 8].ljust(8, b"\0") for i in long.tolist()), ">u8").astype(np.uint64)
        rest = np.minimum(size[long] - k, 8)
        last = head | np.where(rest == 8, np.uint64(0), (np.uint64(1) << (8 * (8 - rest)).astype(np.uint64)) - np.uint64(1))
        ends = []
        for goal, strict in ((head, False), (last, True)):
            a, b = lo[long].copy(), hi[long].copy()
            while (a < b).any():
                open_ = np.flatnonzero(a < b)
                mid = (a[open_] + b[open_]) // 2
                have = _eight(padded, order[mid] + k)
                up = have <= goal[open_] if strict else have < goal[open_]
                a[open_[up]], b[open_[~up]] = mid[up] + 1, mid[~up]
            ends.append(a)
        lo[long], hi[long] = ends
    times = hi - lo
    at = np.repeat(lo, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    position, length, piece = order[at], np.repeat(size, times), np.repeat(vocabulary.order, times)
    by = np.argsort(position * CODES + length)
    return position[by], length[by].astype(np.int32), piece[by]


# ---- relaxation by merge order


def contract(begin: np.ndarray, close: np.ndarray, look: Callable) -> np.ndarray:
    """Symbols (rows of begin and close, equal widths, -1 beyond a row) contracted; returns who is left as a mask.

    ``look(begins, ends)`` scores the piece over a span, -inf where there is none.
    """
    n, w = begin.shape
    begin, close = begin.copy(), close.copy()
    count = (begin >= 0).sum(axis=1)
    out_begin, out_close = np.full((n, w), -1, np.int64), np.full((n, w), -1, np.int64)
    score = np.full((n, w), -np.inf, np.float32)
    pairs = begin[:, 1:] >= 0
    score[:, :-1][pairs] = look(begin[:, :-1][pairs], close[:, 1:][pairs])
    who = np.arange(n)
    while len(who):
        at = score.argmax(axis=1)
        done = score[np.arange(len(who)), at] == -np.inf
        if done.any():
            out_begin[who[done]], out_close[who[done]] = begin[done], close[done]
            left = ~done
            who, at, begin, close, score, count = who[left], at[left], begin[left], close[left], score[left], count[left]
            if not len(who):
                break
        rows = np.arange(len(who))
        close[rows, at] = close[rows, at + 1]
        # symbols beyond the pair move up by one
        take = np.arange(w) + (np.arange(w) > at[:, None])
        take[:, -1] = np.minimum(take[:, -1], w - 1)
        begin, close, score = (np.take_along_axis(x, take, axis=1) for x in (begin, close, score))
        count -= 1
        begin[rows, count] = -1
        close[rows, count] = -1
        score[rows, count - 1] = -np.inf
        right = at + 1 < count
        r, a = rows[right], at[right]
        score[r, a] = look(begin[r, a], close[r, a + 1])
        left = at > 0
        r, a = rows[left], at[left] - 1
        score[r, a] = look(begin[r, a], close[r, a + 1])
    return np.stack([out_begin, out_close])


def contract_one(ends: list[int], score: Callable) -> list[tuple[int, int]]:
    """The same for one long segment, given the ends of its characters; ``score(begin, end)`` may be None."""
    begin = [0, *ends[:-1]]
    close, after, before = list(ends), list(range(1, len(ends))) + [-1], [-1, *range(len(ends) - 1)]
    heap: list = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] >= 0 and (s := score(begin[i], close[after[i]])) is not None:
            heapq.heappush(heap, (-s, i, begin[i], close[after[i]]))

    for i in range(len(ends) - 1):
        offer(i)
    alive = [True] * len(ends)
    while heap:
        _, i, b, c = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j < 0 or begin[i] != b or close[j] != c:
            continue
        close[i], alive[j], after[i] = c, False, after[j]
        if after[i] >= 0:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [(begin[i], close[i]) for i in range(len(ends)) if alive[i]]


def encode_segments(segments: list[bytes], vocabulary: Vocabulary, limit: int = INDEX_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(ids, cuts): the ids of segment i are ids[cuts[i]:cuts[i + 1]]; an index for every ``limit`` bytes."""
    ends = np.append(0, np.cumsum(np.array([len(s) for s in segments], np.int64)))
    ids, sizes, lo = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0
    while lo < len(segments):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + limit, "right")) - 1)
        found, cuts = _indexed(segments[lo:hi], vocabulary)
        ids.append(found)
        sizes.append(np.diff(cuts))
        lo = hi
    return np.concatenate(ids), np.append(0, np.cumsum(np.concatenate(sizes)))


def _indexed(segments: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    text = np.frombuffer(b"\n".join(segments) + b"\n", np.uint8)  # the byte between is in no piece that could match across
    size = np.array([len(s) for s in segments], np.int64)
    base = np.append(0, np.cumsum(size + 1))
    position, length, piece = occurrences(text, np.repeat(base[1:], size + 1) - 1 - np.arange(len(text)), vocabulary)
    edges = np.append(0, np.cumsum(np.bincount(position, minlength=len(text)))).astype(np.int32)  # of each position
    del position
    length = np.append(length, np.int32(0))
    scores = vocabulary.scores[np.append(piece, 0)]

    def find(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The edge over each span, or -1: a few steps along the edges of its position."""
        span = (end - begin).astype(np.int32)
        at, stop = edges[begin], edges[begin + 1]
        found = np.full(len(begin), -1, np.int32)
        left = np.arange(len(begin), dtype=np.int32)
        while len(left):
            open_ = at < stop
            left, at, stop, span = left[open_], at[open_], stop[open_], span[open_]
            have = length[at]
            hit = have == span
            found[left[hit]] = at[hit]
            more = have < span
            left, at, stop, span = left[more], at[more] + 1, stop[more], span[more]
        return found

    def look(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        at = find(begin, end)
        return np.where(at >= 0, scores[at], -np.inf)

    lead = (text & 0xC0) != 0x80
    lead[base[1:] - 1] = False  # between segments
    char = np.flatnonzero(lead)
    owner = np.searchsorted(base, char, "right") - 1
    last = np.append(char[1:], len(text))
    last = np.minimum(last, base[owner + 1] - 1)
    count = np.bincount(owner, minlength=len(segments))
    first = np.cumsum(count) - count
    spans_b, spans_e, spans_o = [], [], []
    for low, high in ((1, 4), (4, 8), (8, 12), (12, 16), (16, 24), (24, WIDEST + 1)):
        own = np.flatnonzero((count >= low) & (count < high))
        for a in range(0, len(own), 1 << 15):
            some = own[a : a + (1 << 15)]
            w = high - 1
            at = first[some][:, None] + np.arange(w)
            inside = np.arange(w) < count[some][:, None]
            at = np.minimum(at, len(char) - 1)
            b, e = contract(np.where(inside, char[at], -1), np.where(inside, last[at], -1), look)
            held = b >= 0
            spans_b.append(b[held])
            spans_e.append(e[held])
            spans_o.append(np.repeat(some, held.sum(axis=1)))
    for i in np.flatnonzero(count > WIDEST).tolist():
        low, n = int(base[i]), int(count[i])

        def one(b: int, e: int, low: int = low) -> float | None:
            for k in range(edges[low + b], edges[low + b + 1]):
                if length[k] == e - b:
                    return float(scores[k])
            return None

        found = np.array(contract_one((last[first[i] : first[i] + n] - low).tolist(), one), np.int64)
        spans_b.append(found[:, 0] + low)
        spans_e.append(found[:, 1] + low)
        spans_o.append(np.full(len(found), i))
    b, e, o = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (spans_b, spans_e, spans_o))
    by = np.argsort(b)
    b, e, o = b[by], e[by], o[by]
    at = find(b, e)
    ids = np.where(at >= 0, np.append(piece, 0)[at], -1)
    # characters that are no piece: one id a byte
    times = np.where(ids >= 0, 1, e - b)
    spread = np.repeat(np.arange(len(b)), times)
    offset = np.arange(len(spread)) - np.repeat(np.cumsum(times) - times, times)
    to_byte = np.array([x if x >= 0 else vocabulary.unknown for x in vocabulary.bytes_at], np.int32)
    out = np.where(ids[spread] >= 0, ids[spread], to_byte[text[np.minimum(b[spread] + offset, len(text) - 1)]]).astype(np.int32)
    cuts = np.append(0, np.cumsum(np.bincount(o, weights=times, minlength=len(segments)).astype(np.int64)))
    return out, cuts


def decode_ids(ids: np.ndarray, vocabulary: Vocabulary) -> str:
    """The text of a row of ids, without the space that the encoder puts first."""
    joined = b"".join([vocabulary.pieces[i] for i in ids.tolist()]).decode("utf-8", "replace")
    return joined[1:] if joined.startswith(" ") else joined


def _exact(ids: np.ndarray, cuts: np.ndarray, segments: list[bytes], vocabulary: Vocabulary) -> np.ndarray:
    """Which segments their ids give back."""
    shown = [vocabulary.pieces[i] for i in ids.tolist()]
    ends = np.append(0, np.cumsum(np.array([len(x) for x in vocabulary.pieces], np.int64)[ids]))
    if b"".join(shown) == b"".join(segments) and (np.diff(ends[cuts]) == [len(x) for x in segments]).all():
        return np.ones(len(segments), bool)
    return np.array([b"".join(shown[a:b]) == x for a, b, x in zip(cuts[:-1].tolist(), cuts[1:].tolist(), segments, strict=True)], bool)


def _same_bytes(data: np.ndarray, s: np.ndarray, e: np.ndarray, like: np.ndarray) -> bool:
    """Whether every segment holds the bytes of the one it is told to be like; the segments cover ``data``."""
    if ((e - s) != (e - s)[like]).any():
        return False
    shift = s[like] - s
    for low in range(0, len(s), 1 << 16):
        high = min(low + (1 << 16), len(s))
        own = np.arange(s[low], e[high - 1])
        if not np.array_equal(data[own + np.repeat(shift[low:high], (e - s)[low:high])], data[own]):
            return False
    return True


def encode_texts(texts: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, cuts, exact): ids of every text, and whether decoding them gives the text."""
    shown = pa.array([(" " + t.replace(MARK, " ")) if t else "" for t in texts], pa.large_string())
    data, at = text_bytes(shown)
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64), np.ones(len(texts), bool)
    starts, hashes = [], []
    for lo, hi, part, edges in slices(shown):
        n = len(part)
        if not n:
            continue
        space = part == 0x20
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[edges[:-1][edges[:-1] < n]] = True
        s = np.flatnonzero(begins)
        e = np.append(s[1:], n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(LETTERS[part] * kept_powers(BASE, n), out=total[1:])
        hashes.append(mix((total[e] - total[s]) * kept_powers(BASE_INVERSE, n + 1)[s] + (e - s).astype(np.uint64)))
        starts.append(s + at[lo])
    s, h = np.concatenate(starts), np.concatenate(hashes)
    e = np.append(s[1:], len(data))
    order = np.argsort(h)
    fresh = np.append(True, h[order][1:] != h[order][:-1])
    which = np.empty(len(h), np.int64)
    which[order] = np.cumsum(fresh) - 1
    some = order[fresh]
    whole = data.tobytes()
    segments = [whole[a:b] for a, b in zip(s[some].tolist(), e[some].tolist(), strict=True)]
    if not _same_bytes(data, s, e, some[which]):  # one hash for unlike segments
        numbers: dict[bytes, int] = {}
        which = np.array([numbers.setdefault(whole[a:b], len(numbers)) for a, b in zip(s.tolist(), e.tolist(), strict=True)], np.int64)
        segments = list(numbers)
    ids, cuts = encode_segments(segments, vocabulary)
    same = _exact(ids, cuts, segments, vocabulary)
    size = np.diff(cuts)[which]
    flat = ids[np.repeat(cuts[:-1][which], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
    ends = np.append(0, np.cumsum(size))
    text_cuts = ends[np.searchsorted(s, at)]
    wrong = np.append(0, np.cumsum(~same[which]))
    edges = np.searchsorted(s, at)
    # the space mark is read as a space and never comes back
    marked = np.array([MARK in t for t in texts], bool)
    return flat, text_cuts, (wrong[edges[1:]] == wrong[edges[:-1]]) & ~marked


def _grouped(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[tuple[list, list[str]]]:
    held, texts, size = [], [], 0
    for b in batches:
        for x, t in zip(zip(*[b.column(c).to_pylist() for c in keep], strict=True), b.column("text"), strict=True):
            held.append(x)
            texts.append(t.as_py() or "")
            size += len(texts[-1])
            if size >= BATCH_BYTES:
                yield held, texts
                held, texts, size = [], [], 0
    if held:
        yield held, texts


def _encoder(vocabulary: Vocabulary, digest: bool) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, texts in _grouped(batches, ["doc_id"]):
            ids, cuts, exact = encode_texts(texts, vocabulary)
            rows = pa.array([x for x, in held], pa.int64())
            if digest:
                found = [hashlib.sha256(ids[a:b].tobytes()).hexdigest() for a, b in zip(cuts, cuts[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([rows, pa.array(np.diff(cuts)), pa.array(found), pa.array(exact)],
                                                 ["doc_id", "n_pieces", "ids_sha256", "exact"])
            else:
                yield pa.RecordBatch.from_arrays([rows, pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids))], ["doc_id", "ids"])

    return encode


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every text."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_encoder(Vocabulary.load(path), False), "doc_id long, ids array<int>")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids)."""
    vocabulary = Vocabulary.load(path)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [decode_ids(np.array(x or [], np.int64), vocabulary) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(back, "doc_id long, text string")


def encoded_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_pieces, SHA-256 of the ids as 32-bit little-endian numbers, and whether decoding gives the text."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_encoder(Vocabulary.load(path), True), "doc_id long, n_pieces long, ids_sha256 string, exact boolean")
