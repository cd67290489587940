"""SimHash near-duplicates through Golay-code fuzzy hashing.

A 64-bit fingerprint is read as three segments of 23, 23 and 18 bits. If two
fingerprints differ in at most two bits, then for one of the pairs (1, 2),
(2, 3), (3, 1) the first segment agrees and the second differs in at most one
bit (pigeonhole: checked for all distributions of two errors in the tests).
The binary Golay code [23, 12, 7] is perfect, so each 23-bit word decodes to
one codeword within distance 3. A word emits the codeword of itself and of
all its 23 neighbours, about five different ones: two words at distance one
always share one. A key is the pair, the exact first segment, and a codeword
index: about 16 keys for each distinct fingerprint.

Fingerprints that share a key are compared bit by bit, and only edges of a
spanning forest leave a bucket. Large buckets never compare all pairs: there
two words are linked through a word at distance one from both, which exists
exactly if they differ in at most two bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import components, cut

# The generator polynomial of the binary Golay code [23, 12, 7].
GOLAY = 0b110001110101
SEGMENTS = ((0, 23), (23, 23), (46, 18))
PAIRS = ((0, 1), (1, 2), (2, 0))
#: Buckets beyond this many fingerprints are linked through shared neighbours.
PAIRWISE = 48


def remainders(words: np.ndarray) -> np.ndarray:
    """Of 23-bit words by the generator polynomial."""
    left = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        left ^= np.where(left >> bit & 1, GOLAY << (bit - 11), 0)
    return left


def decoder() -> np.ndarray:
    """Syndrome -> error pattern of weight 3 or less; the code is perfect."""
    one = 1 << np.arange(23, dtype=np.int64)
    two = (one[:, None] | one[None, :]).ravel()
    errors = np.unique(np.concatenate([[0], one, two, (two[:, None] | one[None, :]).ravel()]))
    found = np.zeros(2048, np.int64)
    found[remainders(errors)] = errors
    return found


def codewords(words: np.ndarray, errors: np.ndarray) -> np.ndarray:
    """12-bit indices of the codewords nearest to 23-bit words."""
    return (words ^ errors[remainders(words)]) >> 11


def keys(prints: np.ndarray, errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) of each distinct key of each fingerprint."""
    flips = np.concatenate([[0], 1 << np.arange(23, dtype=np.int64)])
    segment = [((prints >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    out, rows = [], []
    for k, (i, j) in enumerate(PAIRS):
        near = np.sort(codewords(segment[j][:, None] ^ flips, errors), axis=1)
        new = np.ones(near.shape, bool)
        new[:, 1:] = near[:, 1:] != near[:, :-1]
        row, col = np.nonzero(new)
        out.append(((k << 23 | segment[i][row]) << 12) | near[row, col])
        rows.append(row)
    return np.concatenate(out), np.concatenate(rows)


def fingerprint(text: bytes | None, hasher) -> int:
    """Of one text: 3-word shingles, majority of each bit; none: zero."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    shingles = [b" ".join(x) for x in zip(words, words[1:], words[2:])] if len(words) >= 3 else [b" ".join(words)]
    total, n = np.zeros(64, np.int64), len(shingles)
    for at in range(0, n, 65536):
        h = np.array([hasher(x, 42) for x in shingles[at : at + 65536]], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > n, bitorder="little").view("<u8")[0])


def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for b in batches:
        texts = b.column("text").cast(pa.binary())
        prints = np.array([fingerprint(t.as_py(), xxhash.xxh64_intdigest) for t in texts], np.uint64).view(np.int64)
        names = [x for x in b.schema.names if x != "text"]
        yield pa.RecordBatch.from_arrays([*map(b.column, names), pa.array(prints, pa.int64())], [*names, "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs(text, ...)`` -> the other columns and ``fp``, the 64 bits as a signed long."""
    schema = T.StructType([*(f for f in docs.schema.fields if f.name not in ("text", "fp")), T.StructField("fp", T.LongType())])
    return docs.drop("fp").mapInArrow(_print_batches, schema)


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    errors = decoder()
    for b in batches:
        fp = b.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(fp), 4096):
            key, row = keys(fp[at : at + 4096].view(np.uint64), errors)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[at : at + 4096][row])], ["key", "fp"])


class Forest:
    """Union-find over the fingerprints of a bucket."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def whole_keys(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[list[np.ndarray]]:
    """Columns of batches that come sorted by the first one, joined so that no key is parted."""
    held: list[list[np.ndarray]] = []
    for b in batches:
        if len(b):
            columns = [b.column(x).to_numpy(zero_copy_only=False) for x in names]
            last = int(np.searchsorted(columns[0], columns[0][-1]))
            if held and (last or held[-1][0][-1] != columns[0][0]):
                yield [np.concatenate(x) for x in zip(*held, [c[:last] for c in columns])]
                held = []
            elif last:
                yield [c[:last] for c in columns]
            held.append([c[last:] for c in columns])
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def links(fp: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the graph of distinct words at distance 2 or less."""
    n = len(fp)
    if n <= PAIRWISE:
        i, j = np.nonzero(np.triu(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 2, 1))
    else:
        flips = np.concatenate([[0], np.uint64(1) << np.arange(64, dtype=np.uint64)]).astype(np.uint64)
        middle = (fp[:, None] ^ flips).ravel()
        order = np.argsort(middle, kind="stable")
        same = middle[order[1:]] == middle[order[:-1]]
        i, j = order[:-1][same] // 65, order[1:][same] // 65
    forest = Forest(n)
    return [(a, b) for a, b in zip(i.tolist(), j.tolist()) if forest.join(a, b)]


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key within the partition; a key never leaves it."""

    def linked(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        ends = np.append(starts[1:], len(key))
        src, dst = [], []
        pair = starts[ends - starts == 2]
        near = np.bitwise_count(fp[pair].view(np.uint64) ^ fp[pair + 1].view(np.uint64)) <= 2
        src.append(fp[pair[near]])
        dst.append(fp[pair[near] + 1])
        for a, z in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist()):
            if found := links(fp[a:z].view(np.uint64)):
                found = np.array(found)
                src.append(fp[a:z][found[:, 0]])
                dst.append(fp[a:z][found[:, 1]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(src)), pa.array(np.concatenate(dst))], ["src", "dst"])

    for key, fp in whole_keys(batches, ("key", "fp")):
        yield linked(key, fp)


def near_links(distinct: DataFrame) -> DataFrame:
    """``distinct(fp)`` -> ``(src, dst)``: edges whose closure is that of all links."""
    keyed = distinct.mapInArrow(_key_batches, "key long, fp long")
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_link_batches, "src long, dst long")


def classes(prints: DataFrame) -> DataFrame:
    """``prints(fp)`` -> ``(fp, root)`` for each distinct fingerprint; copies meet before any key is made."""
    distinct = cut(prints.select("fp").distinct())
    roots = components(near_links(distinct))
    return distinct.join(roots, distinct.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, fp, component_id)``.

    Null and empty texts have fingerprint zero and are linked like any other.
    Repeated rows and doc_ids keep their rows. Null ids are never the least.
    Other columns are ignored; an empty table gives an empty table.
    """
    prints = cut(fingerprints(docs.select("doc_id", "text")))
    # the least id of each fingerprint first, with a map-side minimum, so that a large group joins as one row
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classed = cut(least.join(classes(prints), "fp"))
    named = classed.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(classed.join(named, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


# Near duplicates by similarity: the corpus pipeline's rule.

#: Words of a shingle, and the similarity (cosine of the counts of shingles, which is what a SimHash estimates) from which on two texts are near copies.
WORDS, SIMILAR = 5, 0.8
_SHARE = float(np.arccos(SIMILAR) / np.pi)
#: The most bits of 128 in which their fingerprints differ: the angle's share of a half turn, and one standard error
#: of this estimate more, so that few texts this similar are missed. Texts a little less similar may be linked too.
APART = int(128 * _SHARE + np.sqrt(128 * _SHARE * (1 - _SHARE)))
WIDE = ((0, 23), (23, 23), (46, 23))


def majority(features: list[bytes]) -> np.ndarray:
    """128 bits, as two words, each set if it is in over half of the features' hashes; none: zero."""
    import xxhash

    total, n = np.zeros(128, np.int64), len(features)
    for at in range(0, n, 65536):
        h = np.frombuffer(b"".join([xxhash.xxh3_128_digest(x) for x in features[at : at + 65536]]), np.uint8).reshape(-1, 16)
        total += np.unpackbits(h, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(total * 2 > n, bitorder="little").view("<i8")


def _wide_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text the fingerprint of its five-word shingles, which decides, and that of its different words, which few edits change."""
    for b in batches:
        out = np.zeros((4, len(b)), np.int64)
        for i, t in enumerate(b.column("text").cast(pa.binary())):
            words = (t.as_py() or b"").lower().split()
            shingles = [b" ".join(x) for x in zip(*(words[k:] for k in range(WORDS)))] if len(words) >= WORDS else [b" ".join(words)] if words else []
            out[:2, i], out[2:, i] = majority(shingles), majority(sorted(set(words)))
        names = [x for x in b.schema.names if x != "text"]
        yield pa.RecordBatch.from_arrays([*map(b.column, names), *map(pa.array, out)], [*names, "f1", "f2", "w1", "w2"])


def wide_keys(w1: np.ndarray, w2: np.ndarray, errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, row): for each two of three segments of 23 bits the codewords near both; about 75 keys each.

    A word emits the codewords of itself and of its 23 neighbours, so words at
    distance two or less share one. If in two of the segments fingerprints differ by two bits or
    less, they share a key; more errors may share one too.
    """
    flips = np.concatenate([[0], 1 << np.arange(23, dtype=np.int64)])
    whole = w1.view(np.uint64), w2.view(np.uint64)
    segments = [((whole[0] >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) if at + n <= 64 else ((whole[0] >> np.uint64(at) | whole[1] << np.uint64(64 - at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in WIDE]
    codes, starts, sizes = [], [], []
    for s in segments:
        near = np.sort(codewords(s[:, None] ^ flips, errors), axis=1)
        new = np.ones(near.shape, bool)
        new[:, 1:] = near[:, 1:] != near[:, :-1]
        row, col = np.nonzero(new)
        codes.append(near[row, col])
        sizes.append(new.sum(axis=1))
        starts.append(np.cumsum(sizes[-1]) - sizes[-1])
    keys_, rows = [], []
    for k, (i, j) in enumerate(PAIRS):
        both = sizes[i] * sizes[j]
        row = np.repeat(np.arange(len(both)), both)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(both) - both, both)
        a, b = codes[i][starts[i][row] + nth // sizes[j][row]], codes[j][starts[j][row] + nth % sizes[j][row]]
        keys_.append(k << 24 | a << 12 | b)
        rows.append(row)
    return np.concatenate(keys_), np.concatenate(rows)


def _wide_key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    errors = decoder()
    for b in batches:
        w1, w2 = (b.column(x).to_numpy(zero_copy_only=False) for x in ("w1", "w2"))
        for at in range(0, len(b), 2048):
            key, row = wide_keys(w1[at : at + 2048], w2[at : at + 2048], errors)
            which = pa.array(row + at)
            yield pa.RecordBatch.from_arrays([pa.array(key), *(b.column(x).take(which) for x in ("id", "f1", "f2"))], ["key", "id", "f1", "f2"])


def wide_links(fp: np.ndarray, apart: int = APART) -> list[tuple[int, int]]:
    """A spanning forest of the graph of 128-bit words (n x 2) that differ in ``apart`` bits at most.

    From one word after another its neighbours among those not reached yet are
    found, so a dense group of n words takes a few n comparisons, not n squared.
    """
    out, left = [], np.arange(len(fp))
    while len(left) > 1:
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = np.bitwise_count(fp[left] ^ fp[x]).sum(axis=1) <= apart
            out += [(x, y) for y in left[near].tolist()]
            todo += left[near].tolist()
            left = left[~near]
    return out


def _wide_link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key within the partition; a key never leaves it."""

    def linked(key: np.ndarray, node: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        ends = np.append(starts[1:], len(key))
        pair = starts[ends - starts == 2]
        near = np.bitwise_count(fp[pair] ^ fp[pair + 1]).sum(axis=1) <= APART
        src, dst = [node[pair[near]]], [node[pair[near] + 1]]
        for a, z in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist()):
            if found := wide_links(fp[a:z]):
                at = np.array(found) + a
                src.append(node[at[:, 0]])
                dst.append(node[at[:, 1]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(src)), pa.array(np.concatenate(dst))], ["src", "dst"])

    for key, node, f1, f2 in whole_keys(batches, ("key", "id", "f1", "f2")):
        yield linked(key, node, np.stack([f1, f2], axis=1).view(np.uint64))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that stay: one of each group of near copies, that with the least doc_id.

    Two texts are linked if the 128-bit SimHashes of their five-word shingles
    (fewer words: the whole text) differ in ``APART`` bits at most, that is if their cosine
    may be 0.8 or more by that estimate; groups are what links connect. Candidates share a Golay key of
    the fingerprints of their different words, which holds nearly always for texts this similar; within a
    key all links are found. Texts without words are one group. Null ids come last; among
    rows with one id the hash of the text decides; of a row that is there twice one stays.
    Columns stay as they are; no rows give no rows.
    """
    text = F.xxhash64("text")
    rows = docs.select("doc_id", text.alias("tie"), "text")
    schema = T.StructType([*(f for f in rows.schema.fields if f.name != "text"), *(T.StructField(c, T.LongType()) for c in ("f1", "f2", "w1", "w2"))])
    prints = cut(rows.mapInArrow(_wide_batches, schema))
    order = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")).alias("w")
    # equal texts meet first, with a map-side minimum, so that a large group of copies is one node
    nodes = cut(prints.groupBy("f1", "f2", "w1", "w2").agg(order).withColumn("id", F.monotonically_increasing_id()))
    keyed = nodes.select("id", "f1", "f2", "w1", "w2").mapInArrow(_wide_key_batches, "key long, id long, f1 long, f2 long")
    links = keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_wide_link_batches, "src long, dst long")
    roots = components(links)
    winners = nodes.join(roots, nodes["id"] == roots["node"], "left").groupBy(F.coalesce("root", "id")).agg(F.min("w").alias("w")).select(F.col("w.doc_id").alias("id2"), F.col("w.tie").alias("tie2"))
    whole = docs.select(F.col("doc_id").alias("id1"), text.alias("tie1"), F.struct(*docs.columns).alias("row"))
    kept = whole.join(winners, F.col("id1").eqNullSafe(F.col("id2")) & (F.col("tie1") == F.col("tie2")), "left_semi")
    if prints.groupBy("doc_id", "tie").count().where("count > 1").limit(1).count():
        kept = kept.dropDuplicates(["id1", "tie1"])
    return kept.select("row.*")
