"""Token counts by prefix dynamic programming.

A text is normalised and cut into words as the tokenizer file says. For every word a dynamic program over its
positions gives the exact token count of each prefix (see ``_bpe``). Counts at word ends are kept; running sums over the
words give totals, and a cut point needs one more relaxation, of the word that passes the budget.

Words are counted once per batch of texts, all positions of all new words at a time, and kept for later batches up to
``KEPT_WORDS``. The tokenizer's file is a parameter; its vocabulary is read in each worker.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._bpe import LONG_WORD, HashIndex, Merges, Relaxed, ragged, relax, relax_long
from ._common import arrow_text, mixed, span_hashes, steps

KEPT_WORDS = 2_000_000
# Symbols of new words that are relaxed at a time.
SYMBOLS_AT_ONCE = 250_000
SPACE, LETTER, NUMBER, OTHER = range(4)


@functools.cache
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Character class and 64-bit value of every code point."""
    kind = np.full(0x110000, OTHER, np.uint8)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(points)
    for pattern, value in ((r"\p{White_Space}", SPACE), (r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
        kind[[ord(c) for c in regex.findall(pattern, text)]] = value
    return kind, mixed(np.arange(0x110000, dtype=np.uint64) + np.uint64(1))


def _byte_letters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1 for itself, others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordTokenizer:
    """Word-end byte-pair tokenizer of a ``tokenizers`` file (NFC, lower case, words, byte-level merges)."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix") or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path}: not a lower-casing word-end byte-pair vocabulary")
        self.special = [t["content"] for t in spec["added_tokens"]]
        end, letter = model["end_of_word_suffix"], _byte_letters()
        vocabulary: dict[str, int] = model["vocab"]
        n = max(vocabulary.values()) + 1
        rank, left, right = np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        pairs = {}
        for r, (a, b) in enumerate(model["merges"]):
            token = vocabulary[a + b]
            pairs[vocabulary[a], vocabulary[b]] = r
            if rank[token] < 0:
                rank[token], left[token], right[token] = r, vocabulary[a], vocabulary[b]
        self.merges = Merges(pairs, rank, left, right)
        inner, closing = {}, {}
        for token, i in vocabulary.items():
            body = token[:-len(end)] if token.endswith(end) else token
            if body and all(c in letter for c in body) and token not in self.special:
                (closing if token.endswith(end) else inner)[bytes(letter[c] for c in body)] = i
        self.inner, self.closing = _by_length(inner), _by_length(closing)
        self.widest = max(max(self.inner), max(self.closing))
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.known_count = np.zeros(0, np.int32)

    def normalised(self, text: str) -> tuple[str, int]:
        """(text with special strings blanked out, number of those)."""
        specials = 0
        if "<|" in text:
            for s in self.special:
                specials += text.count(s)
                text = text.replace(s, " ")
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # Character by character: no final form of sigma.
        return text.replace("Σ", "σ").lower(), specials

    def words(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, ends) of the words: contractions, runs of letters, single numbers, runs of other characters."""
        n = len(codes)
        kind = _classes()[0][codes]
        before = np.concatenate([[SPACE], kind[:-1]]) if n else kind
        start = ((kind == LETTER) & (before != LETTER)) | (kind == NUMBER) | ((kind == OTHER) & (before != OTHER))
        mark = np.flatnonzero((codes == 0x27) & start)
        if len(mark):
            padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
            one, two = padded[mark + 1], padded[mark + 2]
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = ~short & (((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l"))))
            kinds = np.concatenate([kind, np.full(3, SPACE, kind.dtype)])
            for hits, size in ((mark[short], 2), (mark[long], 3)):
                start[hits + 1] = False
                after = hits + size
                start[after[kinds[after] == LETTER]] = True
        cut = start | (kind == SPACE)
        places = np.append(np.flatnonzero(cut), n)
        starts = np.flatnonzero(start)
        return starts, places[np.searchsorted(places, starts, "right")]

    def prefixes(self, words: bytes, starts: np.ndarray, lengths: np.ndarray, every: bool = False) -> tuple[Relaxed, np.ndarray]:
        """(relaxation, counts): the token count of every word, or with ``every`` of every prefix taken as a word."""
        data = np.frombuffer(words, np.uint8)
        n = len(data)
        hashes = _Prefix(data)

        def edges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
            at = ragged(starts, lengths)
            depth = at - np.repeat(starts, lengths)
            tokens = np.full((self.widest + 1, len(at)), -1, np.int32)
            for size, index in self.inner.items():
                own = np.flatnonzero(depth >= size - 1)
                tokens[size, own] = index.get(hashes.span(at[own] - size + 1, size))
            return tokens

        done = Relaxed(n)
        long = lengths > LONG_WORD
        some, sizes = starts[~long], lengths[~long]
        at = ragged(some, sizes)
        flat = np.cumsum(sizes) - sizes
        part = relax(edges(some, sizes), flat, sizes, self.merges)
        done.last[at], done.count[at], done.came[at] = part.last, part.count, part.came + np.repeat(some - flat, sizes)
        for s, size in zip(starts[long].tolist(), lengths[long].tolist(), strict=True):
            part = relax_long(size, self.widest, lambda b, k, s=s: edges(s + b, k), self.merges)
            done.last[s:s + size], done.count[s:s + size], done.came[s:s + size] = part.last, part.count, part.came + s
        word_start = np.zeros(n, np.int64)
        at = ragged(starts, lengths)
        word_start[at] = np.repeat(starts, lengths)
        open_ends = at if every else starts + lengths - 1
        counts = np.zeros(n, np.int32)
        for size in range(self.widest, 0, -1):
            able = np.flatnonzero(open_ends - word_start[open_ends] >= size - 1) if size in self.closing else []
            if not len(able):
                continue
            t = self.closing[size].get(hashes.span(open_ends[able] - size + 1, size))
            has, t = able[t >= 0], t[t >= 0]
            if not len(has):
                continue
            e = open_ends[has]
            inside = e - size >= word_start[e]
            ok = ~inside
            ok[inside] = self.merges.compatible(done.last[e[inside] - size], t[inside])
            has, e, inside = has[ok], e[ok], inside[ok]
            counts[e] = 1
            counts[e[inside]] = done.count[e[inside] - size] + 1
            open_ends = np.delete(open_ends, has)
        return done, counts if every else counts[starts + lengths - 1]

    def count_words(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Token count of every word of the text ``codes``."""
        h = span_hashes(_classes()[1][codes], starts, ends)
        distinct, first, which = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        at[at == len(self.known)] = 0
        new = self.known[at] != distinct if len(self.known) else np.ones(len(distinct), bool)
        counts = np.zeros(len(distinct), np.int32)
        if len(self.known):
            counts[~new] = self.known_count[at[~new]]
        fresh = np.flatnonzero(new)
        if len(fresh):
            s, e = starts[first[fresh]], ends[first[fresh]]
            size = np.cumsum(e - s)
            lo = 0
            while lo < len(fresh):
                hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + SYMBOLS_AT_ONCE, "right")))
                counts[fresh[lo:hi]] = self._count_new(codes, s[lo:hi], e[lo:hi])
                lo = hi
            if len(self.known) + len(fresh) > KEPT_WORDS:
                self.forget()
            keys = np.concatenate([self.known, distinct[fresh]])
            order = np.argsort(keys, kind="stable")
            self.known = keys[order]
            self.known_count = np.concatenate([self.known_count, counts[fresh]])[order]
        return counts[which]

    def _count_new(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        # A zero after every word keeps the words apart in their UTF-8 form.
        size = ends - starts
        flat = np.zeros(int(size.sum()) + len(size), np.uint32)
        to = np.cumsum(size + 1) - (size + 1)
        flat[ragged(to, size)] = codes[ragged(starts, size)]
        mark = to + size
        raw = flat.tobytes().decode("utf-32-le").encode()
        width = 1 + (flat >= 0x80) + (flat >= 0x800).astype(np.int64) + (flat >= 0x10000)
        byte_at = np.cumsum(width) - width
        return self.prefixes(raw, byte_at[to], byte_at[mark] - byte_at[to])[1]

    def prefix_table(self, text: str) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        """(normalised text, starts, ends, counts): exact token counts of the prefixes that end with each word or special string.

        Special strings stay as they are in the normalised text and are one token each.
        """
        parts = re.split("(" + "|".join(map(re.escape, self.special)) + ")", text) if self.special else [text]
        parts[::2] = [self.normalised(p)[0] for p in parts[::2]]
        size = np.array([len(p) for p in parts], np.int64)
        codes = _codes("".join(" " * len(p) if i % 2 else p for i, p in enumerate(parts)))
        starts, ends = self.words(codes)
        special = np.cumsum(size)[1::2]
        counts = np.append(self.count_words(codes, starts, ends), np.ones(len(special), np.int64))
        starts, ends = np.append(starts, special - size[1::2]), np.append(ends, special)
        order = np.argsort(starts)
        return "".join(parts), starts[order], ends[order], np.cumsum(counts[order])

    def cut(self, text: str, budget: int) -> str:
        """The longest prefix of the normalised text with at most ``budget`` tokens."""
        text, starts, ends, counts = self.prefix_table(text)
        w = int(np.searchsorted(counts, budget, "right"))
        if w == len(ends):
            return text
        start, left = int(starts[w]), budget - (int(counts[w - 1]) if w else 0)
        if left <= 0:
            return text[:start]
        # Inside the word that passes the budget: the counts of all of its prefixes.
        word = text[start:int(ends[w])]
        raw = word.encode()
        upto = np.cumsum([len(c.encode()) for c in word])
        inside = self.prefixes(raw, np.array([0]), np.array([len(raw)]), every=True)[1][upto - 1]
        if len(word) == 3 and word in ("'re", "'ve", "'ll"):  # two words without their last letter
            codes = _codes(word[:2])
            inside[1] = self.count_words(codes, *self.words(codes)).sum()
        fits = np.flatnonzero(inside[:-1] <= left)
        return text[:start + int(fits[-1]) + 1 if len(fits) else start]


class _Prefix:
    """Hashes of all spans of one size from running sums."""

    def __init__(self, data: np.ndarray):
        power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(data), _BASE)]))
        self.inverse = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(data), _INVERSE)]))
        terms = mixed(data.astype(np.uint64) + np.uint64(1)) * power[:-1]
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(terms)])

    def span(self, starts: np.ndarray, size: int) -> np.ndarray:
        return (self.sums[starts + size] - self.sums[starts]) * self.inverse[starts]


_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))


def _by_length(tokens: dict[bytes, int]) -> dict[int, HashIndex]:
    out = {}
    for size in {len(t) for t in tokens}:
        own = [t for t in tokens if len(t) == size]
        flat = _Prefix(np.frombuffer(b"".join(own), np.uint8))
        out[size] = HashIndex(flat.span(np.arange(len(own)) * size, size), np.array([tokens[t] for t in own]), -1)
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


@functools.lru_cache(maxsize=2)
def _loaded(path: str) -> WordTokenizer:
    """The tokenizer of a file, read once per worker."""
    return WordTokenizer(path)


def count(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs`` (doc_id, text; other columns are ignored).

    ``tokenizer`` is the path of the vocabulary file, readable by every executor. Null text is empty and has no tokens;
    repeated rows are counted each; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _loaded(tokenizer)
        for batch in batches:
            for part in steps(batch, "text"):
                _, offsets = arrow_text(part.column("text"))
                tokens = count_texts(t, part.column("text").fill_null("").to_pylist())
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "n_bytes": np.diff(offsets),
                                                  "n_tokens": tokens, "over_limit": tokens > limit})

    kept = docs.select("doc_id", "text")
    return kept.mapInArrow(run, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")


def count_texts(t: WordTokenizer, texts: list[str]) -> np.ndarray:
    """Exact token count of every text: the last entry of its prefix counts."""
    normal = [t.normalised(x) for x in texts]
    size = np.array([len(x) + 1 for x, _ in normal], np.int64)
    codes = _codes("\n".join([x for x, _ in normal] + [""]))
    starts, ends = t.words(codes)
    running = np.concatenate([[0], np.cumsum(t.count_words(codes, starts, ends))])
    upto = np.searchsorted(starts, np.concatenate([[0], np.cumsum(size)]))
    return running[upto[1:]] - running[upto[:-1]] + np.array([s for _, s in normal], np.int64)


def cut_to_budget(docs: DataFrame, tokenizer: str, budget: int) -> DataFrame:
    """doc_id and the longest prefix of every row's normalised text with at most ``budget`` tokens (null stays null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _loaded(tokenizer)
        for batch in batches:
            for part in steps(batch, "text"):
                cut = [None if x is None else t.cut(x, budget) for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "text": pa.array(cut, pa.string())})

    kept = docs.select("doc_id", "text")
    return kept.mapInArrow(run, kept.schema)
