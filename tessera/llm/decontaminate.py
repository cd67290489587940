"""Benchmark decontamination: a prefix-filtered set join over item windows.

Each window of consecutive item words is a set of word shingles. Shingles are
ordered by rarity, that is by the number of documents that have them, counted
over all documents. Containment must be complete, so the necessary prefix of
a window is its rarest shingle: a document without it can't hold the window.
Documents join on prefixes; a match fixes where the window would have to
start (positional bound) and that it must fit (length bound); then the words
themselves are compared, byte by byte.

Only the benchmark is sent to the executors, in blocks of at most
``BLOCK_BYTES`` of text whose number follows its size. A block is a few flat
arrays: the words of its items, and for each different window its prefix's
hash, sorted. Documents are read once to count the shingles of all blocks and once
more for each block; they never move. Counts are kept by ``BUCKETS`` of
hashes; shingles that share a bucket share a count, which bears on the order
alone, never on what is found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLOCK_BYTES = 16 << 20
BUCKETS = 1 << 22
#: Bytes of text whose words are taken at a time, but for longer words; and texts that share such a part.
SLICE = 1 << 19
_WORDY = np.array([WORD.fullmatch(bytes([c])) is not None for c in range(256)])
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_random = np.random.default_rng(1)
_BYTE = _random.integers(1, 1 << 62, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _random.integers(1, 1 << 62, 1024, dtype=np.uint64) | np.uint64(1)
_STEP = _random.integers(1, 1 << 62, 64, dtype=np.uint64) | np.uint64(1)


def words(text: bytes | None) -> list[bytes]:
    """A-Z lower-cased; UTF-8 bytes above 0x7F belong to words."""
    return WORD.findall((text or b"").lower())


def windows(text: bytes | None, size: int) -> list[tuple[bytes, ...]]:
    """All runs of ``size`` words; a shorter text is one window, no words none."""
    w = words(text)
    return [tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if w else []


class Words:
    """Words of texts laid end to end: where each begins and ends, its hash, and the first word of each text."""

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join(texts).translate(_LOWER)
        whole = np.frombuffer(self.raw, np.uint8)
        begin, end, hashes, at = [], [], [], 0
        while at < len(whole):
            stop = min(len(whole), at + SLICE)
            while stop < len(whole) and _WORDY[whole[stop]]:  # a part ends behind a word
                stop += 1
            part = whole[at:stop]
            on = _WORDY[part]
            edge = np.diff(on.astype(np.int8), prepend=0, append=0)
            first, behind = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
            if len(first):
                place = np.arange(len(part)) - np.repeat(first, np.diff(np.append(first, len(part)))) if not first[0] else np.arange(len(part)) - np.repeat(np.append(0, first), np.diff(np.concatenate([[0], first, [len(part)]])))
                mixed = np.where(on, _BYTE[part] * _PLACE[place & 1023], np.uint64(0))
                mixed ^= mixed >> np.uint64(31)
                h = np.add.reduceat(mixed * np.uint64(0x9E3779B97F4A7C15), first) + (behind - first).astype(np.uint64)
                hashes.append(h ^ (h >> np.uint64(29)))
                begin.append(first + at)
                end.append(behind + at)
            at = stop
        none = np.zeros(0, np.int64)
        self.begin, self.end = np.concatenate([none, *begin]), np.concatenate([none, *end])
        self.hash = np.concatenate([none.astype(np.uint64), *hashes])
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.first = np.searchsorted(self.begin, starts)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, first word) of the runs of ``k`` words that lie within one text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        h = np.zeros(n, np.uint64)
        for j in range(k):
            h = (h ^ (self.hash[j : j + n] * _STEP[j % 64])) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
        inside = np.ones(n, bool)
        for j in range(1, k):
            edge = self.first[1:-1] - j
            inside[edge[(edge >= 0) & (edge < n)]] = False
        at = np.flatnonzero(inside)
        return h[at], at

    def bytes_of(self, first: int, n: int) -> bytes:
        return b" ".join(self.raw[a:z] for a, z in zip(self.begin[first : first + n].tolist(), self.end[first : first + n].tolist()))


def buckets(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


class Items:
    """The different windows of a block of items, by the hash of their rarest shingle.

    ``counts`` holds in how many documents the shingles of each bucket occur;
    of equally rare shingles the first in the window is taken.
    """

    def __init__(self, rows: list[tuple[object, bytes | None]], size: int, width: int, counts: np.ndarray | None = None):
        w = self.words = Words([t or b"" for _, t in rows])
        length = np.diff(w.first)
        many = np.where(length > 0, np.maximum(length - size + 1, 1), 0)
        item = np.repeat(np.arange(len(rows)), many)
        first = np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many) + w.first[item]
        n = np.minimum(length[item], size)
        # equal windows become one with several owners: a hash brings them together, the bytes decide
        digest = np.zeros(len(first), np.uint64)
        for j in range(size):
            on = n > j
            digest[on] = (digest[on] ^ (w.hash[first[on] + j] * _STEP[j % 64])) * np.uint64(0xD6E8FEB86659FD93)
            digest[on] ^= digest[on] >> np.uint64(32)
        order = np.lexsort((first, n, digest))
        same = np.concatenate([[False], (digest[order[1:]] == digest[order[:-1]]) & (n[order[1:]] == n[order[:-1]])]) if len(order) else np.zeros(0, bool)
        for i in np.flatnonzero(same).tolist():
            a, b = order[i - 1], order[i]
            same[i] = w.bytes_of(int(first[a]), int(n[a])) == w.bytes_of(int(first[b]), int(n[b]))
        lead = np.flatnonzero(~same)
        self.first, self.n = first[order[lead]], n[order[lead]]
        self.owner_at, self.owners = np.append(lead, len(order)), item[order]
        self.names = [str(i) for i, _ in rows]
        # a block's text is bounded, so small integers hold all places
        w.begin, w.end = w.begin.astype(np.int32), w.end.astype(np.int32)
        self.first, self.n, self.owner_at, self.owners = (x.astype(np.int32) for x in (self.first, self.n, self.owner_at, self.owners))
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for k in sorted(set(np.minimum(self.n, width).tolist())):
            mine = np.flatnonzero(np.minimum(self.n, width) == k)
            h = np.zeros(len(w.hash) + 1, np.uint64)
            shingle, at = w.shingles(k)
            h[at] = shingle
            best, place = np.full(len(mine), np.iinfo(np.int64).max), np.zeros(len(mine), np.int64)
            for j in range(size - k + 1):
                on = self.n[mine] - k >= j
                seen = np.full(len(mine), np.iinfo(np.int64).max)
                seen[on] = counts[buckets(h[self.first[mine][on] + j])] if counts is not None else 0
                less = on & (seen < best)
                best, place = np.where(less, seen, best), np.where(less, j, place)
            key = h[self.first[mine] + place]
            sort = np.argsort(key, kind="stable")
            some = np.zeros(BUCKETS, bool)
            some[buckets(key)] = True
            self.tables[k] = (key[sort], mine[sort].astype(np.int32), place[sort].astype(np.int16), np.packbits(some))

    def found(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first word, window) of each occurrence of a window, words counted over all texts."""
        texts, firsts, found = [], [], []
        for k, (key, window, place, some) in self.tables.items():
            h, at = w.shingles(k)
            b = buckets(h)
            maybe = np.flatnonzero(some[b >> 3] >> (7 - (b & 7)).astype(np.uint8) & 1)
            h, at = h[maybe], at[maybe]
            lo, hi = np.searchsorted(key, h), np.searchsorted(key, h, side="right")
            for begin in range(0, len(h), 1 << 16):  # a common shingle may be the prefix of many windows
                a, z, p = lo[begin : begin + (1 << 16)], hi[begin : begin + (1 << 16)], at[begin : begin + (1 << 16)]
                n = z - a
                entry = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
                start = np.repeat(p, n) - place[entry]
                doc = np.searchsorted(w.first, np.repeat(p, n), side="right") - 1
                size = self.n[window[entry]]
                fits = (start >= w.first[doc]) & (start + size <= w.first[doc + 1])
                entry, start, doc, size = entry[fits], start[fits], doc[fits], size[fits]
                for j in range(int(size.max(initial=0))):
                    ok = (size <= j) | (w.hash[np.minimum(start + j, len(w.hash) - 1)] == self.words.hash[np.minimum(self.first[window[entry]] + j, len(self.words.hash) - 1)])
                    entry, start, doc, size = entry[ok], start[ok], doc[ok], size[ok]
                known: dict[int, bytes] = {}
                for e, s, d, m in zip(window[entry].tolist(), start.tolist(), doc.tolist(), size.tolist()):
                    if e not in known:
                        known[e] = self.words.bytes_of(int(self.first[e]), m)
                    if w.bytes_of(s, m) == known[e]:
                        texts.append(d)
                        firsts.append(s)
                        found.append(e)
        return np.array(texts, np.int64), np.array(firsts, np.int64), np.array(found, np.int64)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, overlapping or touching ones joined."""
    out: list[list[int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [tuple(x) for x in out]


def _parts(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in parts of about ``SLICE`` bytes, and the row where each begins."""
    part, n, first = [], 0, 0
    for i, t in enumerate(column.cast(pa.binary())):
        t = t.as_py() or b""
        if part and n + len(t) > SLICE:
            yield first, part
            part, n, first = [], 0, i
        part.append(t)
        n += len(t)
    if part:
        yield first, part


def _bucketing(size: int, width: int):
    """(words, bucket) of the shingles of all windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = np.zeros((width + 1, BUCKETS), bool)
        for b in batches:
            for _, texts in _parts(b.column(0)):
                w = Words(texts)
                length = np.diff(w.first)
                for k in range(1, width + 1):
                    h, at = w.shingles(k)
                    mine = length[np.searchsorted(w.first, at, side="right") - 1]
                    some[k, buckets(h[np.minimum(np.minimum(mine, size), width) == k])] = True
        k, bucket = np.nonzero(some)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(bucket)], ["k", "bucket"])

    return run


def _counting(some: np.ndarray, sizes: list[int]):
    """In how many texts each bucket of the benchmark's shingles occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for _, texts in _parts(b.column(0)):
                w = Words(texts)
                for k in sizes:
                    h, at = w.shingles(k)
                    bucket = buckets(h)
                    on = np.flatnonzero(some[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8) & 1)
                    doc = np.searchsorted(w.first, at[on], side="right") - 1
                    seen, n = np.unique(np.unique(doc * BUCKETS + bucket[on]) % BUCKETS, return_counts=True)
                    total[seen] += n
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    return run


FOUND = "n_words long, hits array<struct<start:int,stop:int>>, items array<string>"


def _finding(items: Items):
    hit = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, hits, names = [], b.column("hits").to_pylist(), b.column("items").to_pylist()
            for first, texts in _parts(b.column("_text")):
                w = Words(texts)
                n.append(np.diff(w.first))
                docs, starts, found = items.found(w)
                for d in np.unique(docs).tolist():
                    mine = docs == d
                    at, which = starts[mine] - w.first[d], found[mine]
                    spans = set(zip(at.tolist(), (at + items.n[which]).tolist())) | {(x["start"], x["stop"]) for x in hits[first + d]}
                    hits[first + d] = [{"start": a, "stop": z} for a, z in merged(list(spans))]
                    owners = {items.names[o] for e in set(which.tolist()) for o in items.owners[items.owner_at[e] : items.owner_at[e + 1]].tolist()}
                    names[first + d] = sorted(owners | set(names[first + d]))
            new = {"n_words": pa.array(np.concatenate([np.zeros(0, np.int64), *n])), "hits": pa.array(hits, hit), "items": pa.array(names, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([new[x] if x in new else b.column(i) for i, x in enumerate(b.schema.names)], b.schema.names)

    return find


def scan(docs: DataFrame, benchmark: DataFrame, size: int = 10, shingle: int = 2, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``docs(text, *carry)``, ``benchmark(item_id, text)`` -> carry, n_words, hits, items.

    ``hits`` are the maximal runs of hit words, ``items`` the ids (as strings,
    sorted) of items of which a window occurs. Null and empty texts have no
    words; texts of any length are read whole, part by part; items without words or id
    are never found; repeated items count once, repeated documents each; an empty benchmark
    finds nothing, no documents give no rows; carried columns with a name of the results are
    replaced by these.
    """
    carry = tuple(c for c in carry if c not in ("n_words", "hits", "items"))
    items = benchmark.where("item_id is not null").select("item_id", F.col("text").cast("binary").alias("text"))
    weight = items.agg(F.coalesce(F.sum(F.octet_length(F.coalesce("text", F.lit(b""))) + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-int(weight) // BLOCK_BYTES))
    some = np.zeros(BUCKETS, bool)
    used = items.select("text").mapInArrow(_bucketing(size, shingle), "k long, bucket long").distinct().toArrow()
    some[used.column("bucket").to_numpy()] = True
    counts = np.zeros(BUCKETS, np.int64)
    if some.any():
        counted = docs.select("text").mapInArrow(_counting(np.packbits(some), np.unique(used.column("k").to_numpy()).tolist()), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
        counts[counted.column(0).to_numpy()] = counted.column(1).to_numpy()
    none = F.lit(0).cast("long").alias("n_words"), F.expr("cast(array() as array<struct<start:int,stop:int>>)").alias("hits"), F.expr("cast(array() as array<string>)").alias("items")

    def block(k: int) -> Items:
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        return Items([(r[0], r[1]) for r in part.toLocalIterator()], size, shingle, counts)

    if blocks == 1:
        out = docs.select(*carry, F.col("text").alias("_text"), *none)
        return out.mapInArrow(_finding(block(0)), out.schema).drop("_text")
    # texts are written once, with a number each; a block adds narrow rows, of the texts that it has found something in, and driver and workers hold one block at a time
    texts = cut(docs.select(*carry, F.col("text").alias("_text"), F.monotonically_increasing_id().alias("_row")))
    asked, found = texts.select("_row", "_text", *none), None
    for k in range(blocks):
        own = asked.mapInArrow(_finding(block(k)), asked.schema).drop("_text")
        own = cut(own.where("size(hits) > 0") if k else own)
        found = own if found is None else found.unionByName(own)
    lists = found.groupBy("_row").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return texts.drop("_text").join(lists.mapInArrow(_merging, lists.schema), "_row").drop("_row")


def _merging(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs that several blocks have found, as maximal ones."""
    for b in batches:
        k = b.schema.get_field_index("hits")
        runs = [[{"start": a, "stop": z} for a, z in merged([(x["start"], x["stop"]) for x in row])] if len(row) > 1 else row for row in b.column(k).to_pylist()]
        yield b.set_column(k, b.schema.field(k), pa.array(runs, b.schema.types[k]))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any hit, all columns kept."""
    rows = docs.select("text", F.struct(*docs.columns).alias("row"))
    return scan(rows, benchmark, carry=("row",)).where(F.size("hits") == 0).select("row.*")
