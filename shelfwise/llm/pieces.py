"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch of texts are written one after another and indexed by a suffix array. Every piece of
the vocabulary is looked up in it by binary search; its range of suffixes are its occurrences. The occurrences are the
edges of a lattice; ordered by the position where they end, they are relaxed from left to right. For a byte-pair model
the edge that may end at a position is the one whose piece is compatible with the last piece before it (see ``_bpe``).
Characters that no piece covers become byte pieces.

Texts are cut into words between any two characters that stand next to each other in no piece (before a space, for
instance): no merge crosses such a border, so words are encoded apart without changing the result. The model file is a parameter; its pieces are read in each worker.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from ._bpe import LONG_WORD, Merges, ragged, relax, relax_long
from ._common import arrow_text, mixed, span_hashes, steps

SPACE = 0x2581
UNKNOWN = 0
# Words and ids that a worker keeps between batches (about 100 MB); beyond, it starts anew.
KEPT_WORDS = 2_000_000
KEPT_IDS = 8_000_000
# Code points below this are told apart where words are cut; the last two numbers are for spaces and all others.
LATIN = 0x250
# Symbols of new words that one suffix array indexes.
SYMBOLS_AT_ONCE = 400_000


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their suffixes' first ``depth`` or more symbols (prefix doubling)."""
    symbols, dense = np.unique(codes, return_inverse=True)
    bits = max(1, int(len(symbols)).bit_length())
    have = 63 // bits
    padded = np.concatenate([dense.astype(np.uint64) + np.uint64(1), np.zeros(have, np.uint64)])
    key = padded[:len(codes)]
    for i in range(1, have):  # as many symbols as fit into one number
        key = key << np.uint64(bits) | padded[i:len(codes) + i]
    while True:
        order = np.argsort(key)
        if have >= depth:
            return order
        ranked = key[order]
        step = np.ones(len(order), np.uint64)
        step[1:] = ranked[1:] != ranked[:-1]
        rank = np.empty(len(order), np.uint64)
        rank[order] = np.cumsum(step)
        later = np.zeros(len(order), np.uint64)
        later[:max(len(order) - have, 0)] = rank[have:]
        key = rank << np.uint64(32) | later
        have *= 2


def occurrences(codes: np.ndarray, order: np.ndarray, pieces: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[low, high) of every piece in the suffix array: the suffixes that begin with it."""
    width = pieces.shape[1]
    padded = np.concatenate([codes, np.zeros(width, codes.dtype)])
    used = np.arange(width) < sizes[:, None]

    def bound(above: bool) -> np.ndarray:
        lo, hi = np.zeros(len(pieces), np.int64), np.full(len(pieces), len(order))
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) // 2
            text = padded[order[mid][:, None] + np.arange(width)]
            differ = (text != pieces[open_]) & used[open_]
            at = differ.argmax(1)
            here = np.arange(len(open_))
            some = differ[here, at]
            less = some & (text[here, at] < pieces[open_][here, at])
            right = less | (~some if above else np.zeros(len(open_), bool))
            lo[open_] = np.where(right, mid + 1, lo[open_])
            hi[open_] = np.where(right, hi[open_], mid)

    return bound(False), bound(True)


class PieceTokenizer:
    """Byte-pair pieces of a SentencePiece model with byte fallback."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.names = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.byte = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        text = {self.names[i]: i for i in plain}
        if any(chr(SPACE) in p.lstrip(chr(SPACE)) for p in text):
            raise ValueError(f"{path}: pieces cross the words that this encoder cuts at")
        # Characters that longer pieces hold but that are no pieces: symbols of their own, written as bytes if they stay alone.
        for c in sorted({c for p in text for c in p} - text.keys()):
            text[c] = len(self.names)
            self.names.append(c)
            plain.append(text[c])
        self.real = n
        n = len(self.names)
        # Two characters that stand next to each other in no piece are always encoded apart.
        self.joined = np.zeros((LATIN, LATIN), bool)
        for p in text:
            for a, b in zip(p, p[1:], strict=False):
                a, b = _narrow(ord(a)), _narrow(ord(b))
                self.joined[a, b] = True
        self.joined[LATIN - 1, :LATIN - 2] |= True
        self.joined[:LATIN - 2, LATIN - 1] |= True
        self.joined[LATIN - 1, LATIN - 1] = True
        self.joined = self.joined.ravel()
        order = sorted((i for i in plain if len(self.names[i]) > 1), key=lambda i: (-model.get_score(i), i))
        rank = np.full(n, -1, np.int64)
        rank[order] = np.arange(len(order))
        pairs = {}
        for i in order:
            p = self.names[i]
            for cut in range(1, len(p)):
                a, b = text.get(p[:cut]), text.get(p[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = int(rank[i])
        left, right = np.zeros(n, np.int64), np.zeros(n, np.int64)
        made = dict(zip(rank[order].tolist(), order, strict=True))
        reached = [i for i in plain if len(self.names[i]) == 1]
        for i in order:
            halves = _last_merge([text.get(c, UNKNOWN) for c in self.names[i]], pairs, made)
            if halves:
                left[i], right[i] = halves
                reached.append(i)
        self.merges = Merges(pairs, rank, left, right, unknown=UNKNOWN)
        self.ids = np.array(reached)
        self.sizes = np.array([len(self.names[i]) for i in reached])
        self.widest = int(self.sizes.max())
        self.pieces = np.zeros((len(reached), self.widest), np.uint32)
        for row, i in enumerate(reached):
            self.pieces[row, :len(self.names[i])] = [ord(c) for c in self.names[i]]
        body = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else b"" if model.is_control(i) else p.replace(chr(SPACE), " ").encode()
                for i, p in enumerate(self.names[:self.real])]
        self.body = np.frombuffer(b"".join(body), np.uint8)
        self.body_size = np.array([len(b) for b in body])
        self.body_at = np.cumsum(self.body_size) - self.body_size
        self.forget()

    def forget(self) -> None:
        self.known, self.known_at, self.known_size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.known_ids = np.zeros(0, np.int32)

    def lattice(self, codes: np.ndarray) -> np.ndarray:
        """The edges of the lattice by their end: ``[n, e]`` is the piece of n symbols that ends with symbol e."""
        order = suffix_array(codes, self.widest)
        # Pieces with a symbol that the text does not have cannot occur.
        there = np.zeros(0x110000, bool)
        there[codes] = there[0] = True
        able = np.flatnonzero(there[self.pieces].all(1))
        low, high = occurrences(codes, order, self.pieces[able], self.sizes[able])
        piece = np.repeat(able, high - low)
        start = order[ragged(low, high - low)]
        edges = np.full((self.widest + 1, len(codes)), -1, np.int32)
        edges[self.sizes[piece], start + self.sizes[piece] - 1] = self.ids[piece]
        bare = edges[1] < 0
        edges[1, bare] = UNKNOWN
        return edges

    def encode_words(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per word) of words that are symbol spans of ``codes``, apart from each other."""
        long = lengths > LONG_WORD
        if long.any():
            return self._encode_long(codes, starts, lengths, long)
        done = relax(self.lattice(codes), starts, lengths, self.merges)
        end = starts + lengths - 1
        # Bytes of characters without a piece.
        unknown = (done.last == UNKNOWN) | (done.last >= self.real)
        width = np.where(unknown, _utf8_width(codes), 1)
        sizes = np.zeros(len(starts), np.int64)
        at, word = end.copy(), np.arange(len(starts))
        path = []
        while len(word):
            path.append((word, at))
            sizes[word] += width[at]
            at = done.came[at] - 1
            on = at >= starts[word]
            at, word = at[on], word[on]
        ids = np.zeros(int(sizes.sum()), np.int32)
        to = np.cumsum(sizes)
        for word, at in path:
            to[word] -= width[at]
            self._write(ids, to[word], codes[at], done.last[at], unknown[at])
        return ids, sizes

    def _write(self, ids: np.ndarray, to: np.ndarray, codes: np.ndarray, pieces: np.ndarray, unknown: np.ndarray) -> None:
        ids[to[~unknown]] = pieces[~unknown]
        for w, c in zip(to[unknown].tolist(), codes[unknown].tolist(), strict=True):
            raw = list(chr(c).encode())
            ids[w:w + len(raw)] = self.byte[raw]

    def _encode_long(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`encode_words` where some words are long: those are relaxed in windows, with a lattice of some windows at a time."""
        some = np.flatnonzero(~long)
        flat, to = apart(codes, starts[some], lengths[some])
        ids, sizes = self.encode_words(flat, to, lengths[some])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        out = dict(zip(some.tolist(), (ids[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)), strict=True))

        def edges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
            flat, to = apart(codes, starts, lengths)
            return self.lattice(flat)[:, ragged(to, lengths)]

        for w in np.flatnonzero(long).tolist():
            s, size = int(starts[w]), int(lengths[w])
            done = relax_long(size, self.widest, lambda b, k, s=s: edges(s + b, k), self.merges)
            came, path, at = done.came.tolist(), [], size - 1
            while at >= 0:
                path.append(at)
                at = came[at] - 1
            path = np.array(path[::-1])
            own, last = codes[s + path], done.last[path]
            unknown = (last == UNKNOWN) | (last >= self.real)
            width = np.where(unknown, _utf8_width(own), 1)
            out[w] = np.zeros(int(width.sum()), np.int32)
            self._write(out[w], np.cumsum(width) - width, own, last, unknown)
        return np.concatenate([out[w] for w in range(len(starts))]), np.array([len(out[w]) for w in range(len(starts))], np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): text i has ids[bounds[i]:bounds[i + 1]]."""
        # Every text is a line of its own; a space is put before it, as the model's format asks.
        codes = np.frombuffer("".join("\0" + ("▁" + t if t else "") for t in texts).encode("utf-32-le"), np.uint32)
        codes = np.where(codes == 0x20, np.uint32(SPACE), codes)
        size = np.array([len(t) + 2 if t else 1 for t in texts], np.int64)
        line = np.cumsum(size) - size
        narrow = np.minimum(codes, LATIN - 1).astype(np.int32)
        narrow[codes == SPACE] = LATIN - 2
        first = np.ones(len(codes), bool)
        first[1:] = ~self.joined[narrow[:-1] * LATIN + narrow[1:]]
        first[line] = True
        begin = np.flatnonzero(first)
        length = np.diff(np.append(begin, len(codes)))
        real = np.ones(len(begin), bool)
        real[np.searchsorted(begin, line)] = False  # the mark before each text
        begin, length = begin[real], length[real]
        at, count = self._lookup(codes, begin, length)
        ids = self.known_ids[ragged(at, count)]
        upto = np.searchsorted(begin, np.append(line, len(codes)))
        running = np.concatenate([[0], np.cumsum(count)])
        return ids, running[upto]

    def _lookup(self, codes: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = span_hashes(mixed(codes.astype(np.uint64) + np.uint64(1)), begin, begin + length)
        distinct, first, which = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > KEPT_WORDS or len(self.known_ids) > KEPT_IDS:
            self.forget()
        at = np.searchsorted(self.known, distinct)
        at[at == len(self.known)] = 0
        new = self.known[at] != distinct if len(self.known) else np.ones(len(distinct), bool)
        fresh = np.flatnonzero(new)
        if len(fresh):
            s, n = begin[first[fresh]], length[first[fresh]]
            size = np.cumsum(n + 1)
            ids, sizes = [self.known_ids], []
            lo = 0
            while lo < len(fresh):
                hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + SYMBOLS_AT_ONCE, "right")))
                flat, to = apart(codes, s[lo:hi], n[lo:hi])
                got, per_word = self.encode_words(flat, to, n[lo:hi])
                ids.append(got)
                sizes.append(per_word)
                lo = hi
            sizes = np.concatenate(sizes)
            places = len(self.known_ids) + np.cumsum(sizes) - sizes
            self.known_ids = np.concatenate(ids)
            keys = np.concatenate([self.known, distinct[fresh]])
            order = np.argsort(keys, kind="stable")
            self.known = keys[order]
            self.known_at = np.concatenate([self.known_at, places])[order]
            self.known_size = np.concatenate([self.known_size, sizes])[order]
        at = np.searchsorted(self.known, distinct)[which]
        return self.known_at[at], self.known_size[at]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, bounds) of the texts that the ids stand for; the space put before a text is taken off."""
        size = self.body_size[ids]
        data = self.body[ragged(self.body_at[ids], size)]
        running = np.concatenate([[0], np.cumsum(size)])[bounds]
        some = np.diff(running) > 0
        lead = running[:-1][some]
        keep = np.ones(len(data), bool)
        keep[lead[data[lead] == 0x20]] = False
        kept = np.concatenate([[0], np.cumsum(keep)])
        return data[keep], kept[running]


def apart(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, new starts) of some spans with a mark after each, which no piece holds and which keeps them apart."""
    to = np.cumsum(lengths + 1) - (lengths + 1)
    flat = np.zeros(int(lengths.sum()) + len(lengths), np.uint32)
    flat[ragged(to, lengths)] = codes[ragged(starts, lengths)]
    return flat, to


def _narrow(code: int) -> int:
    return LATIN - 2 if code == SPACE else min(code, LATIN - 1)


def _utf8_width(codes: np.ndarray) -> np.ndarray:
    return 1 + (codes >= 0x80) + (codes >= 0x800).astype(np.int64) + (codes >= 0x10000)


def _last_merge(symbols: list[int], pairs: dict[tuple[int, int], int], made: dict[int, int]) -> tuple[int, int] | None:
    """The two halves that encoding joins last, or None if it does not end with a single piece."""
    while len(symbols) > 1:
        ranked = [(pairs.get(p, 1 << 40), i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False))]
        rank, i = min(ranked)
        if rank not in made:
            return None
        halves = symbols[i], symbols[i + 1]
        symbols[i:i + 2] = [made[rank]]
    return halves


@functools.lru_cache(maxsize=2)
def _loaded(path: str) -> PieceTokenizer:
    """The tokenizer of a file, read once per worker."""
    return PieceTokenizer(path)


def encode_column(t: PieceTokenizer, text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(ids as lists, number of ids, whether decoding gives the text back) of a string column."""
    data, offsets = arrow_text(text)
    ids, bounds = t.encode(text.fill_null("").to_pylist())
    back, back_at = t.decode(ids, bounds)
    n = len(offsets) - 1
    same = np.diff(back_at) == np.diff(offsets)
    if same.all() and len(data):
        wrong = np.concatenate([[0], np.cumsum(back != data)])
        same = wrong[offsets[1:]] == wrong[offsets[:-1]]
    elif not same.all():
        same = np.array([same[i] and np.array_equal(back[back_at[i]:back_at[i + 1]], data[offsets[i]:offsets[i + 1]]) for i in range(n)], bool)
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())), np.diff(bounds), same


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, token_ids and round_trip of every row of ``docs`` (doc_id, text; other columns are ignored).

    ``model`` is the path of the model file, readable by every executor. Null and empty texts have no ids. ``round_trip``
    says whether decoding the ids gives the text back; it does unless a text holds U+2581, which the model's format
    reads as a space. Repeated rows are encoded each; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _loaded(model)
        for batch in batches:
            for part in steps(batch, "text"):
                lists, n, same = encode_column(t, part.column("text"))
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "n_tokens": n, "token_ids": lists, "round_trip": same})

    kept = docs.select("doc_id", "text")
    return kept.mapInArrow(run, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, n_tokens long, token_ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of every row of ``encoded`` (doc_id, token_ids); null ids give null text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _loaded(model)
        for batch in batches:
            lists = batch.column("token_ids")
            bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(False))]).astype(np.int64)
            raw, at = t.decode(lists.flatten().to_numpy(False), bounds)
            raw = raw.tobytes()
            text = [raw[a:b].decode("utf-8", "replace") if ok else None
                    for a, b, ok in zip(at[:-1], at[1:], lists.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(text, pa.string())})

    kept = encoded.select("doc_id", "token_ids")
    return kept.mapInArrow(run, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, text string")
