"""MinHash near-dedup by a multi-index Hamming join of b-bit signatures.

1. A text's set holds the 64-bit hashes of its distinct word shingles. Its signature has ``CHUNKS * WIDTH`` components, each
   the lowest ``BITS`` bits of a minimum under one permutation. The signature distance of two texts is the
   number of components that differ; at similarity J it is J-binomial: (1 - J) of the components on average.
2. By the pigeonhole principle, signatures within distance ``CHUNKS * (ERRORS + 1) - 1`` share a chunk with at most
   ``ERRORS`` = 1 differing component. All forms of a chunk with one component left out are enumerated as keys, so that each
   such pair meets under some key whatever component differs.
3. Texts with equal sets are one class, numbered and named by its smallest id; only classes are joined.
4. Signatures that share a key are compared in groups of bounded size. At first only the few nearest partners of every
   member are confirmed, and their links merged into components. Then all pairs that are still in different
   components are confirmed inside their group, whatever their distance; the group returns links only. So thousands of near copies of one text
   cost a multiple of their number in rows, not its square, and no link between components is skipped.
5. A pair counts as a link only if the full sets confirm the similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import (
    BLANK_WORD, HASH_STEP_BYTES, arrow_text, byte_values, combined, give_back, mixed, span_hashes, steps, word_spans, written,
)
from ._bpe import ragged
from .graph import components

CHUNKS, WIDTH, BITS, ERRORS = 8, 5, 16, 1
COMPONENTS = CHUNKS * WIDTH
# First links are sought up to this distance, so that few rows leave the groups; after them, pairs of any distance are confirmed.
FIRST_DISTANCE = 18
# Rows of a key that are compared in one group with each other; more make several groups.
KEY_BLOCK = 2000
# Shingles of a block at most, on average, where sets are brought along.
KEY_SHINGLES = 1_000_000
PAIRS_AT_ONCE = 100_000
# Partners of a document that are confirmed first.
NEAREST = 4
# Ids that are broadcast at most (40 bytes each); beyond, the join is a shuffle.
BROADCAST_IDS = 1_000_000
_RNG = np.random.Generator(np.random.PCG64(7))
_A = _RNG.integers(1, 1 << 63, COMPONENTS, dtype=np.uint64) | np.uint64(1)
_B = _RNG.integers(1, 1 << 63, COMPONENTS, dtype=np.uint64)


def shingle_sets(text: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): row i's distinct shingles are ``hashes[bounds[i]:bounds[i + 1]]``, sorted.

    Words are runs between white space of the text with A-Z lower-cased. Fewer words than
    ``words`` make one shingle; no words make none.
    """
    data, offsets = arrow_text(text)
    n = len(offsets) - 1
    starts, ends, row = word_spans(BLANK_WORD[data], offsets)
    h = span_hashes(byte_values(data, lower=True), starts, ends)
    first = np.searchsorted(row, np.arange(n + 1))
    m = max(len(h) - words + 1, 0)
    rolled = combined([h[j:j + m] for j in range(words)]) if m else h[:0]
    out, bounds = [], np.zeros(n + 1, np.int64)
    for i in range(n):
        lo, hi = first[i], first[i + 1]
        if hi - lo >= words:
            s = np.unique(rolled[lo:hi - words + 1])
        elif hi > lo:
            s = combined([h[j:j + 1] for j in range(lo, hi)])
        else:
            s = h[:0]
        out.append(s)
        bounds[i + 1] = bounds[i] + len(s)
    return (np.concatenate(out) if out else h[:0]), bounds


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """uint16 matrix (rows, COMPONENTS); a row without shingles has zeros."""
    n = len(bounds) - 1
    sig = np.zeros((n, COMPONENTS), np.uint16)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        for k in range(COMPONENTS):
            low = np.minimum.reduceat(hashes * _A[k] + _B[k], bounds[full])
            sig[full, k] = mixed(low).astype(np.uint16)
    return sig


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """int64 matrix (rows, CHUNKS * WIDTH): the chunk keys with one component left out each."""
    wide = sig.astype(np.uint64)
    keys = np.empty(sig.shape, np.uint64)
    for c in range(CHUNKS):
        for out in range(WIDTH):
            h = np.full(len(sig), c * WIDTH + out, np.uint64)
            for j in range(WIDTH):
                if j != out:
                    h = (h << np.uint64(16) | wide[:, c * WIDTH + j]) if j > 1 else h * np.uint64(65536) + wide[:, c * WIDTH + j]
            keys[:, c * WIDTH + out] = mixed(h ^ np.uint64((c * WIDTH + out + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return keys.view(np.int64)


def _set_key(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of every set."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes))])
    other = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)))])
    return (sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64), (other[bounds[1:]] - other[bounds[:-1]]).view(np.int64)


def _bytes_rows(matrix: np.ndarray) -> pa.Array:
    width = matrix.shape[1] * matrix.itemsize
    offsets = pa.py_buffer(np.arange(0, width * len(matrix) + 1, width, dtype=np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, offsets, pa.py_buffer(np.ascontiguousarray(matrix).tobytes())])


def signature_rows(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``signature_table`` for batches of (doc_id, text_hash, text), a step of text at a time."""
    for batch in batches:
        for part in steps(batch, "text", HASH_STEP_BYTES):
            hashes, bounds = shingle_sets(part.column("text"), words)
            a, b = _set_key(hashes, bounds)
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "text_hash": part.column("text_hash"),
                "n_shingles": np.diff(bounds), "set_a": a, "set_b": b,
                "sig": _bytes_rows(signatures(hashes, bounds))})


def signature_table(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_a, set_b, sig) of every row of docs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from signature_rows(batches, words)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text") \
        .mapInArrow(run, "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, sig binary")


def _keyed(classes: DataFrame) -> DataFrame:
    """(key, k, id) of every class representative; k numbers the 40 forms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = chunk_keys(_sig_matrix(batch.column("sig")))
            yield pa.RecordBatch.from_pydict({
                "key": keys.ravel(), "k": np.tile(np.arange(COMPONENTS, dtype=np.int32), len(keys)),
                "id": np.repeat(batch.column("id").to_numpy(False), COMPONENTS)})

    return classes.select("id", "sig").mapInArrow(run, "key long, k int, id long")


def _sig_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, COMPONENTS)


def _blocked(members: DataFrame) -> DataFrame:
    """Deal the members of every key (with its number of ``blocks``) to groups of at most two blocks.

    A key of one block is one group; a larger one is cut into blocks by a hash of the id, and every two of its blocks
    (and each block with itself) are a group.
    """
    blk = F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int")
    return members.withColumn("blk", blk) \
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("key", "k", F.least("blk", "with").alias("lo"), F.greatest("blk", "with").alias("hi"), "blk", "id", "comp", "n", "sig")


def _in_groups(grouped: DataFrame, schema: str, answer) -> DataFrame:
    """Apply ``answer(table, bounds of its groups)`` to whole groups (key, lo, hi), several at a time."""
    dealt = grouped.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            bounds = _group_bounds(t)
            rest = t.slice(bounds[-2])  # the last group may go on in the next batch
            if bounds[-2]:
                yield from answer(t.slice(0, bounds[-2]), bounds[:-1])
        if rest is not None and rest.num_rows:
            yield from answer(rest, _group_bounds(rest))
        rest = None
        give_back()

    return dealt.mapInArrow(run, schema)


def _group_bounds(t: pa.Table) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for c in ("key", "lo", "hi"):
        values = t.column(c).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(new), t.num_rows)


def _near_pairs(t: pa.Table, bounds: np.ndarray, similarity: tuple[int, int], within: bool
                ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, distance) of members of a group whose first shared key is the group's, some rows i at a time.

    With ``within`` the pairs up to FIRST_DISTANCE come from both sides; else all of different components, once.
    Only sizes that rule the similarity out leave a pair out of the latter.
    """
    num, den = similarity
    sig = _sig_matrix(t.column("sig").combine_chunks())
    k, lo, hi, blk, ids, comp, n = (t.column(c).to_numpy() for c in ("k", "lo", "hi", "blk", "id", "comp", "n"))
    group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    first = bounds[group] if within else np.arange(t.num_rows) + 1
    partners = bounds[group + 1] - first
    upto = np.concatenate([[0], np.cumsum(partners)])
    at = 0
    while at < t.num_rows:
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + PAIRS_AT_ONCE, "right")) - 1)
        i = np.repeat(np.arange(at, end), partners[at:end])
        j = ragged(first[at:end], partners[at:end])
        at = end
        use = (den * np.minimum(n[i], n[j]) >= num * np.maximum(n[i], n[j])) & ((lo[i] == hi[i]) | (blk[i] != blk[j]))
        use &= (ids[i] != ids[j]) if within else (comp[i] != comp[j])
        i, j = i[use], j[use]
        same = (sig[i] == sig[j]).reshape(-1, CHUNKS, WIDTH)
        wrong = WIDTH - same.sum(2)
        distance = wrong.sum(1)
        chunk = (wrong <= ERRORS).argmax(1)
        row = np.arange(len(i))
        out = np.where(wrong[row, chunk] == 0, 0, same[row, chunk].argmin(1))
        use = chunk * WIDTH + out == k[i]
        if within:
            use &= distance <= FIRST_DISTANCE
        yield i[use], j[use], distance[use]


def _nearest_pairs(grouped: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """(a, b, distance): the NEAREST nearest partners of every member in each of its groups, a < b."""
    def answer(t: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids = t.column("id").to_numpy()
        for i, j, distance in _near_pairs(t, bounds, similarity, within=True):
            order = np.lexsort((mixed((ids[j] ^ ids[i]).astype(np.uint64)), distance, i))
            i, j, distance = i[order], j[order], distance[order]
            start = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else np.zeros(0, np.int64)
            rank = np.arange(len(i)) - np.repeat(start, np.diff(np.append(start, len(i))))
            keep = rank < NEAREST
            x, y = ids[i[keep]], ids[j[keep]]
            yield pa.RecordBatch.from_pydict({"a": np.minimum(x, y), "b": np.maximum(x, y), "distance": distance[keep].astype(np.int32)})

    return _in_groups(grouped, "a long, b long, distance int", answer)


def _undecided_members(grouped: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """(key, lo, hi, id): members that have a partner of another component in the group."""
    def answer(t: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        some = np.zeros(t.num_rows, bool)
        for i, j, _ in _near_pairs(t, bounds, similarity, within=False):
            some[i] = some[j] = True
        keep = pa.array(some)
        yield pa.RecordBatch.from_pydict({c: t.column(c).filter(keep).combine_chunks() for c in ("key", "lo", "hi", "id")})

    return _in_groups(grouped, "key long, lo int, hi int, id long", answer)


def _links_in_groups(grouped: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """(a, b): pairs of different components whose full sets (column shingles) reach the similarity."""
    num, den = similarity

    def answer(t: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        upto = np.concatenate([[0], np.cumsum(t.column("n").to_numpy())])[bounds]
        at = 0
        while at < len(bounds) - 1:  # some groups at a time, so that few shingles are ranked at once
            end = max(at + 1, int(np.searchsorted(upto, upto[at] + KEY_SHINGLES, "right")) - 1)
            yield from links(t.slice(bounds[at], bounds[end] - bounds[at]), bounds[at:end + 1] - bounds[at])
            at = end

    def links(t: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        data, offsets = _binary(t.column("shingles").combine_chunks())
        size = np.diff(offsets) // 8
        at = offsets[:-1] // 8
        vocabulary, rank = np.unique(data.view(np.uint64), return_inverse=True)
        member = np.zeros(len(vocabulary), bool)
        ids = t.column("id").to_numpy()
        for i, j, _ in _near_pairs(t, bounds, similarity, within=False):
            cuts = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else np.zeros(0, np.int64)
            linked = np.zeros(len(i), bool)
            for lo, hi in zip(cuts, np.append(cuts, len(i))[1:], strict=True):
                own, others = rank[at[i[lo]]:at[i[lo]] + size[i[lo]]], j[lo:hi]
                member[own] = True
                hits = member[rank[ragged(at[others], size[others])]]
                member[own] = False
                both = np.add.reduceat(hits.astype(np.int64), np.cumsum(size[others]) - size[others])
                linked[lo:hi] = den * both >= num * (len(own) + size[others] - both)
            yield pa.RecordBatch.from_pydict({"a": ids[i[linked]], "b": ids[j[linked]]})

    return _in_groups(grouped, "a long, b long", answer)


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return arrow_text(column.cast(pa.large_binary()).view(pa.large_string()))


def _sets(docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """(id, shingles) of ``classes`` (id, doc_id, n_shingles, set_a, set_b), from the rows of doc_id that have that set."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # A few numbers a class: broadcast up to a counted bound, a shuffle join beyond it.
    few = classes.count() <= BROADCAST_IDS
    texts = texts.join(F.broadcast(classes) if few else classes, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text", HASH_STEP_BYTES):
                hashes, bounds = shingle_sets(part.column("text"), words)
                own = np.diff(bounds) == part.column("n_shingles").to_numpy(False)
                for c, x in zip(("set_a", "set_b"), _set_key(hashes, bounds), strict=True):
                    own &= part.column(c).to_numpy(False) == x
                raw = hashes.tobytes()
                yield pa.RecordBatch.from_pydict({"id": part.column("id").filter(pa.array(own)), "shingles": pa.array(
                    [raw[8 * bounds[i]:8 * bounds[i + 1]] for i in np.flatnonzero(own)], pa.binary())})

    return written(texts.select("id", "n_shingles", "set_a", "set_b", "text").mapInArrow(run, "id long, shingles binary"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs whose full shingle sets reach the similarity."""
    num, den = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_x"), batch.column("set_y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_pydict({"a": batch.column("a").filter(keep), "b": batch.column("b").filter(keep)})

    x = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_x"))
    y = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_y"))
    return pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "set_x", "set_y") \
        .mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, similarity: tuple[int, int] = (8, 10)) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text).

    ``similarity`` is (numerator, denominator) of the least Jaccard similarity of linked sets.
    ``component_id`` is the smallest doc_id reachable by links. Null and empty texts have no shingles and link with nothing;
    repeated rows are one class; rows that share an id but not the set are decided each by its own set; a null id
    has a null component and is kept; an empty table gives no rows.
    """
    return _found(docs, words, similarity).select("doc_id", "n_shingles", "component_id", "kept")


def _found(docs: DataFrame, words: int, similarity: tuple[int, int]) -> DataFrame:
    """The result of ``near_duplicates`` with text_hash, set_a and set_b of every row."""
    table = written(signature_table(docs, words), "signatures")
    key = ["set_a", "set_b", "n_shingles"]
    classes = table.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()) \
        .groupBy(*key).agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig"))
    # Numbered, as different sets can come under one doc_id.
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    named = classes.select("id", "doc_id", *key)
    keyed = written(_keyed(classes), "keys")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    carried = classes.select("id", F.col("n_shingles").alias("n"), "sig")
    shared = shared.select("key", F.ceil(F.col("members") / KEY_BLOCK).cast("int").alias("blocks"))
    members = written(keyed.join(shared, "key").join(carried, "id"), "members")

    # First links: the nearest partners of every member.
    first = written(_nearest_pairs(_blocked(members.withColumn("comp", F.col("id"))), similarity), "first")
    pair = F.struct("distance", F.xxhash64("a", "b"), "a", "b").alias("p")
    sides = first.select(F.col("a").alias("id"), pair).unionByName(first.select(F.col("b").alias("id"), pair))
    best = sides.withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy("p"))).filter(F.col("r") <= NEAREST)
    best = written(best.select("p.a", "p.b").distinct(), "best")
    ids = written(best.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    sets = _sets(docs, named.join(ids, "id"), words)
    links = written(_confirmed(best, sets, similarity), "links")
    comp = components(links).withColumnRenamed("node", "id")

    # The rest: every pair that the first links leave in different components. Only members of such
    # pairs bring their sets to the group, and only links leave it.
    placed = members.join(comp, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component", "blocks")
    split = placed.groupBy("key").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.count(F.lit(1)).alias("m"),
                                      F.sum("n").alias("shingles")).filter("c1 < c2") \
        .select("key", F.ceil(F.greatest(F.col("m") / KEY_BLOCK, F.col("shingles") / KEY_SHINGLES)).cast("int").alias("blocks"))
    rest = written(_blocked(placed.join(split, "key")), "rest")
    undecided = written(_undecided_members(rest, similarity), "undecided")
    others = written(undecided.select("id").distinct().join(ids, "id", "left_anti"), "others")
    sets = sets.unionByName(_sets(docs, named.join(others, "id"), words))
    rest = rest.join(undecided, ["key", "lo", "hi", "id"]).join(sets, "id")
    more = written(_links_in_groups(rest, similarity), "more")
    comp = components(links.unionByName(more)).withColumnRenamed("node", "id")

    placed = named.join(comp, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = placed.groupBy("component").agg(F.min(F.struct("doc_id", *key, "id")).alias("least"))
    of_class = placed.join(least, "component").select(
        *key, F.col("least.doc_id").alias("component"), (F.col("least.id") == F.col("id")).alias("own"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    first = (F.col("doc_id") == F.col("component_id")) & F.coalesce("own", F.lit(True))
    return table.join(of_class, key, "left").withColumn("component_id", component) \
        .withColumn("kept", F.col("doc_id").isNull() | first) \
        .select("doc_id", "text_hash", *key, "component_id", "kept")


def drop_near_duplicates(docs: DataFrame, words: int = 5, similarity: tuple[int, int] = (8, 10)) -> DataFrame:
    """``docs`` with one document of every group left: the one with the smallest id.

    Documents without shingles stay. Of rows that share an id and a set, the first by text hash stays.
    """
    found = written(_found(docs, words, similarity), "found")
    full = found.filter("doc_id is not null and n_shingles > 0")
    key = ["doc_id", "set_a", "set_b", "n_shingles"]
    # Other texts of a kept set under its id, as "One" and "one".
    texts = full.filter("kept").groupBy(*key).agg(F.min("text_hash").alias("first"), F.max("text_hash").alias("last")) \
        .filter("first < last").drop("last")
    others = full.filter("kept").join(texts, key).filter("text_hash > first")
    named = [F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text")]
    gone = written(full.filter(~F.col("kept")).select(*named).unionByName(others.select(*named)).distinct(), "gone")
    few = gone.count() <= BROADCAST_IDS
    same = (docs["doc_id"].cast("long") == F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_text"))
    left = docs.join(F.broadcast(gone) if few else gone, same, "left_anti")
    twice = full.filter("kept").groupBy(*named).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").drop("_rows")
    twice = written(twice.join(gone, ["_id", "_text"], "left_anti"), "repeated")
    if twice.isEmpty():
        return left
    marked = left.join(twice, same, "left")
    # One row of each, combined before the shuffle: an id of very many equal rows never gathers with its texts.
    again = marked.filter("_id is not null").dropDuplicates(["_id", "_text"])
    return marked.filter("_id is null").select(*docs.columns).unionByName(again.select(*docs.columns))
