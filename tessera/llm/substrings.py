"""Removal of repeated byte strings with a sparse suffix array.

Every window of ``span`` bytes picks an anchor, the leftmost least of the
hashes of its ``GRAM``-byte strings; equal windows pick equal anchors. So a
repeated window shows as an anchor string that occurs twice. Of an anchor at
byte a only its context matters, the ``span - GRAM`` bytes before it and
``span`` from it on: it holds all windows around the anchor.

1. Anchors are counted by hash. Equal contexts of an anchor meet by a hash of
   128 bits; they are repeated as they are, so one of them stands for all. (Two different
   contexts of one anchor are taken for equal with a chance of 2^-128 a pair;
   when a document is cut, one of its contexts is taken for a repeated one
   with a chance of 2^-64 for each that the document has.)
2. Of each anchor with a context that occurs once, every different context is sent to
   the task of the anchor, where they are
   sorted as suffixes from the anchor on, and as reversed prefixes up to it,
   by deep-shallow sorting: a multikey quicksort, eight bytes a key, down to
   a shallow depth, and a blind trie for each group that still agrees there.
   The longest common prefixes of neighbours then give, for each offset r,
   which contexts agree on r bytes before and span - r bytes from the anchor:
   the windows that occur twice. Work grows as n log n in the contexts of an
   anchor, and no pairs are formed. An
   anchor's different contexts are sorted by one task, in about 1 KB each.
3. What the windows cover is cut out of each document.

Documents of any length are taken whole; anchors are looked for in slices that
overlap by a window, so that little more than the text itself is in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut

GRAM = 32
#: Keys of eight bytes that the quicksort looks at, after the anchor's number.
SHALLOW = 8
#: Contexts that a task sorts together; an anchor's own are never split.
TOGETHER = 20_000
#: Bytes of text that are taken together, but for longer documents, and windows of which anchors are looked for at a time.
BLOCK, SLICE = 1 << 18, 1 << 20
#: Low bits that hold the place in a slice while hashes are compared; the hashes keep the others, alike in every slice.
PLACE = 22


def anchors(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the anchors of all windows inside the documents [start, end); 8 bytes follow the last one."""
    windows, total = ends - starts - span + 1, len(buffer) - 8 - span + 1
    ok = windows > 0
    begin, stop = starts[ok], (starts + windows)[ok]
    at, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for first in range(0, max(0, total), SLICE):
        count = min(SLICE, total - first)
        a, z = np.searchsorted(stop, first, side="right"), np.searchsorted(begin, first + count)
        if a >= z:
            continue
        h, least = _least(buffer[first : first + count + span - 1 + 8], span)
        inside = np.zeros(count + 1, np.int32)
        np.add.at(inside, np.maximum(begin[a:z] - first, 0), 1)
        np.add.at(inside, np.minimum(stop[a:z] - first, count), -1)
        here = (least[np.cumsum(inside[:-1]) > 0] & np.uint64((1 << PLACE) - 1)).astype(np.int64)
        here = here[np.concatenate([[True], here[1:] != here[:-1]])]
        # windows move on, and so do their anchors: only the first one may be that of the slice before
        here = here[1:] if len(at[-1]) and at[-1][-1] == here[0] + first else here
        if len(here):
            at.append(here + first)
            hashes.append(h[here].view(np.int64))
    return np.concatenate(at), np.concatenate(hashes)


def _least(part: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all grams of a slice, and of each window the least one with its place."""
    n, width = len(part) - 8 - GRAM + 1, span - GRAM + 1
    eight = np.lib.stride_tricks.as_strided(part[:8].view("<u8"), (len(part) - 7,), (1,)).copy()
    h = eight[:n] * np.uint64(0x9E3779B97F4A7C15)
    for k, prime in ((8, 0xC2B2AE3D27D4EB4F), (16, 0x165667B19E3779F9), (24, 0xD6E8FEB86659FD93)):
        h ^= h >> np.uint64(29)
        h += eight[k : k + n]
        h *= np.uint64(prime)
    h ^= h >> np.uint64(32)
    least = (h >> np.uint64(PLACE) << np.uint64(PLACE)) | np.arange(n, dtype=np.uint64)
    size = 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    return h, least


class Text:
    """Anchors of a block of documents, their contexts and hashes of these."""

    def __init__(self, texts: list[bytes], span: int):
        import xxhash

        self.whole = b"".join(texts) + b"\0" * 8
        buffer = np.frombuffer(self.whole, np.uint8)
        self.ends = np.cumsum([len(t) for t in texts])
        self.starts = self.ends - np.array([len(t) for t in texts])
        self.at, self.h = anchors(buffer, self.starts, self.ends, span)
        self.doc = np.searchsorted(self.ends, self.at, side="right")
        self.lo = np.maximum(self.at - (span - GRAM), self.starts[self.doc]) if len(self.at) else self.at
        self.hi = np.minimum(self.at + span, self.ends[self.doc]) if len(self.at) else self.at
        digest, whole = xxhash.xxh3_128_digest, self.whole
        both = b"".join([digest(whole[a:z], left) for a, z, left in zip(self.lo.tolist(), self.hi.tolist(), (self.at - self.lo).tolist())])
        # two halves of one hash; within a document the first one alone tells contexts apart
        self.c, self.d = np.ascontiguousarray(np.frombuffer(both or bytes(16), "<i8").reshape(-1, 2)[: len(self.at)].T)


def blocked(column: pa.Array, wanted: np.ndarray | None = None) -> Iterator[tuple[list[int], list[bytes]]]:
    """Texts in blocks of about ``BLOCK`` bytes, with their rows; only the wanted ones."""
    rows, block, n = [], [], 0
    for i, t in enumerate(column.cast(pa.binary())):
        if wanted is None or wanted[i]:
            t = t.as_py() or b""
            if block and n + len(t) > BLOCK:
                yield rows, block
                rows, block, n = [], [], 0
            rows.append(i)
            block.append(t)
            n += len(t)
    if block:
        yield rows, block


def _anchoring(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rid = b.column(0).to_numpy(zero_copy_only=False)
            for rows, texts in blocked(b.column(1)):
                t = Text(texts, span)
                yield pa.RecordBatch.from_arrays([pa.array(t.h), pa.array(t.c), pa.array(t.d), pa.array(rid[rows][t.doc])], ["h", "c", "d", "rid"])

    return run


def check_of(text: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text, 77) - (1 << 63)


def _members(b: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a column of lists of longs; null is empty."""
    column = b.column(name)
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(lengths)]), column.flatten().to_numpy(zero_copy_only=False)


def _contexts(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "single", "near", "context", "rid", "verify", "at"]
        for b in batches:
            rid = b.column("rid").to_numpy(zero_copy_only=False)
            offset, lone = _members(b, "lone")
            offset2, shown = _members(b, "shown")
            for rows, texts in blocked(b.column("text"), (np.diff(offset) > 0) | (np.diff(offset2) > 0)):
                t, out = Text(texts, span), []
                mine = {(d, x) for d, i in enumerate(rows) for x in lone[offset[i] : offset[i + 1]].tolist()}
                other = {(d, x) for d, i in enumerate(rows) for x in shown[offset2[i] : offset2[i + 1]].tolist()}
                for d, c, h, a, lo, hi in zip(t.doc.tolist(), t.c.tolist(), t.h.tolist(), t.at.tolist(), t.lo.tolist(), t.hi.tolist()):
                    if (single := (d, c) in mine) or (d, c) in other:
                        out.append((h, single, a - lo, t.whole[lo:hi], rid[rows[d]], check_of(texts[d]), a - t.starts[d]))
                if out:
                    types = (pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), types)], names)

    return run


def quicksorted(words: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of rows by their first ``depth`` words.

    Returns the order and, for each place, the first place of its group of
    rows that agree on these words. All groups part at once around their own
    pivots: less, equal, greater; the equal part goes on with the next word.
    """
    n = len(words)
    order, group = np.arange(n), np.zeros(n, np.int64)
    word = np.zeros(n, np.int64)
    while True:
        size = np.bincount(group, minlength=n)[group]
        live = np.flatnonzero((size > 1) & (word < depth))
        if not len(live):
            return order, group
        rows, g, w = order[live], group[live], word[live]
        key = words[rows, w]
        a, s = g, size[live]
        ends = [words[order[p], word[p]] for p in (a, a + s // 2, a + s - 1)]
        pivot = np.maximum(np.minimum(ends[0], ends[1]), np.minimum(np.maximum(ends[0], ends[1]), ends[2]))
        part = (key > pivot).astype(np.int8) + (key >= pivot)
        sort = np.lexsort((part, g))
        order[live], part, w, g = rows[sort], part[sort], w[sort], g[sort]
        fresh = np.concatenate([[True], (g[1:] != g[:-1]) | (part[1:] != part[:-1])])
        group[live] = live[np.maximum.accumulate(np.where(fresh, np.arange(len(live)), 0))]
        word[live] = w + (part == 1)


class Trie:
    """A blind trie: inner nodes only know at which byte their leaves differ."""

    __slots__ = ("depth", "kids", "any")

    def __init__(self, depth: int, leaf: int):
        self.depth, self.any = depth, leaf
        self.kids: dict[int, Trie | int] = {}


def trie_sorted(rows: list[int], strings: list[bytes]) -> list[int]:
    """Rows in the order of their strings of one length, equal strings side by side."""
    as_int = [int.from_bytes(s, "big") for s in strings]
    bits = len(strings[0]) * 8
    same: dict[int, list[int]] = {}
    root: Trie | int | None = None
    for i, s in enumerate(strings):
        if root is None:
            root = i
            continue
        node = root
        while isinstance(node, Trie):  # blind: bytes between the nodes are not looked at
            node = node.kids.get(s[node.depth], node.any)
        differ = as_int[node] ^ as_int[i]
        if not differ:
            same.setdefault(node, []).append(i)
            continue
        lcp = (bits - differ.bit_length()) // 8
        above, node = None, root
        while isinstance(node, Trie) and node.depth < lcp:
            above, node = node, node.kids[s[node.depth]]
        if isinstance(node, Trie) and node.depth == lcp:
            node.kids[s[lcp]] = i
            continue
        fork = Trie(lcp, i)
        leaf = node.any if isinstance(node, Trie) else node
        fork.kids = {strings[leaf][lcp]: node, s[lcp]: i}
        if above is None:
            root = fork
        else:
            above.kids[s[above.depth]] = fork
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, Trie):
            stack.extend(node.kids[k] for k in sorted(node.kids, reverse=True))
        else:
            out.extend((node, *same.get(node, ())))
    return [rows[i] for i in out]


def deep_shallow(group: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Order of the rows of a byte matrix within their groups."""
    pad = -text.shape[1] % 8
    wide = np.pad(text, ((0, 0), (0, pad)), constant_values=255)
    words = np.hstack([group.astype(np.uint64)[:, None], np.ascontiguousarray(wide).view(">u8").astype(np.uint64)])
    depth = min(words.shape[1], SHALLOW + 1)
    order, first = quicksorted(words, depth)
    size = np.bincount(first, minlength=len(order))
    tail = (depth - 1) * 8
    if tail < wide.shape[1]:
        for a in np.flatnonzero(size > 1).tolist():
            z = a + int(size[a])
            rows = order[a:z].tolist()
            order[a:z] = trie_sorted(rows, [wide[r, tail:].tobytes() for r in rows])
    return order


def common(group: np.ndarray, text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Longest common prefix of each row in order with the one before; 0 for a group's first."""
    out = np.zeros(len(order), np.int64)
    if len(order) > 1:
        a, b = order[:-1], order[1:]
        differ = text[a] != text[b]
        lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), text.shape[1])
        out[1:] = np.where(group[a] == group[b], lcp, -1)
    return out


def offsets(group: np.ndarray, near: list[int], contexts: list[bytes], span: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest r of each context so that its window from r bytes before the anchor occurs again in its group; -1 if none."""
    n, reach = len(contexts), span - GRAM
    ahead, back = np.full((n, span), 255, np.uint8), np.full((n, reach), 255, np.uint8)
    for i, (k, c) in enumerate(zip(near, contexts)):
        raw = np.frombuffer(c, np.uint8)
        ahead[i, : len(raw) - k] = raw[k:]
        back[i, :k] = raw[:k][::-1]
    left, right = np.array(near), np.array([len(c) - k for k, c in zip(near, contexts)])
    sides = []
    for text in (ahead, back):
        order = deep_shallow(group, text)
        sides.append((order, common(group, text, order)))
    (o1, lcp1), (o2, lcp2) = sides
    low, high = np.full(n, -1), np.full(n, -1)
    f, b = np.empty(n, np.int64), np.empty(n, np.int64)
    for r in range(reach + 1):
        f[o1] = np.cumsum(lcp1 < span - r)
        # two contexts of a group agree on no bytes at least; -1 parts groups
        b[o2] = np.cumsum(lcp2 < r)
        ok = np.flatnonzero((right >= span - r) & (left >= r))
        if len(ok) < 2:
            continue
        key = f[ok] * (n + 1) + b[ok]
        sort = np.argsort(key, kind="stable")
        same = key[sort[1:]] == key[sort[:-1]]
        hit = ok[np.unique(np.concatenate([sort[1:][same], sort[:-1][same]]))]
        low[hit] = np.where(low[hit] < 0, r, low[hit])
        high[hit] = r
    return low, high


def _windows(span: int):
    """Rows come sorted by anchor within the partition; an anchor never leaves it."""

    def found(t: pa.Table) -> pa.RecordBatch:
        h = t.column("h").to_numpy()
        group = np.cumsum(np.concatenate([[True], h[1:] != h[:-1]]))
        low, high = offsets(group, t.column("near").to_pylist(), t.column("context").to_pylist(), span)
        keep = np.flatnonzero(t.column("single").to_numpy() & (low >= 0))
        at = t.column("at").to_numpy()[keep]
        part = [pa.array(t.column(x).to_numpy()[keep]) for x in ("rid", "verify")]
        return pa.RecordBatch.from_arrays([*part, pa.array(at - high[keep]), pa.array(at + span - low[keep])], ["rid", "verify", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            while held.num_rows >= TOGETHER:
                h = held.column("h").to_numpy()
                cut_at = int(np.searchsorted(h, h[TOGETHER - 1]))
                if not cut_at:
                    cut_at = int(np.searchsorted(h, h[0], side="right"))
                    if cut_at == len(h):
                        break
                yield found(held.slice(0, cut_at))
                held = held.slice(cut_at)
        if held is not None and held.num_rows:
            yield found(held)

    return run


def covered(n: int, lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes of [0, n) inside any of the intervals."""
    out: list[list[int]] = []
    for k in np.lexsort((hi, lo)).tolist():
        a, z = int(lo[k]), min(n, int(hi[k]))
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def _cutting(span: int, schema_names: list[str]):
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offset, full = _members(b, "full")
            verify, lows, highs = (_members(b, x) for x in ("verify", "lo", "hi"))
            column = b.column("text").cast(pa.binary())
            touched = (np.diff(offset) > 0) | (np.diff(lows[0]) > 0)
            spans: list[list[dict]] = [[] for _ in range(len(b))]
            kept = [None if on else (t.as_py() or b"") for on, t in zip(touched, column)]
            total = np.array([len(t) if t is not None else 0 for t in kept], np.int64)
            for rows, texts in blocked(column, touched):
                t = Text(texts, span)
                place = np.searchsorted(t.doc, np.arange(len(texts) + 1))
                for d, (i, text) in enumerate(zip(rows, texts)):
                    p, q = place[d : d + 2]
                    hit = np.isin(t.c[p:q], full[offset[i] : offset[i + 1]])
                    mine = slice(lows[0][i], lows[0][i + 1])
                    ours = verify[1][mine] == check_of(text) if mine.stop > mine.start else np.zeros(0, bool)
                    lo = np.concatenate([t.lo[p:q][hit] - t.starts[d], lows[1][mine][ours]])
                    hi = np.concatenate([t.hi[p:q][hit] - t.starts[d], highs[1][mine][ours]])
                    runs = covered(len(text), lo, hi)
                    at, pieces = 0, []
                    for a, z in runs:
                        pieces.append(text[at:a])
                        at = z
                    spans[i] = [{"start": a, "stop": z} for a, z in runs]
                    kept[i], total[i] = b"".join((*pieces, text[at:])), len(text)
            new = {"n_bytes": pa.array(total), "removed": pa.array(spans, spans_type), "kept": pa.array(kept, pa.binary())}
            yield pa.RecordBatch.from_arrays([new[x] if x in new else b.column(x) for x in schema_names], schema_names)

    return run


def without_repeats(docs: DataFrame, span: int = 200) -> DataFrame:
    """``docs(doc_id, text)`` -> (doc_id, n_bytes, removed, kept).

    ``removed`` holds the maximal runs of bytes covered by strings of ``span``
    bytes that also start elsewhere, in the same text or another; ``kept`` is
    the rest. Texts are judged as they come in, as UTF-8 bytes. A null text
    is empty; a text shorter than ``span`` stays whole; a row that is there
    twice is a repeat of itself; null and repeated ids are told apart by their texts; other
    columns are ignored; an empty table gives an empty table.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", text.alias("text"), F.xxhash64("doc_id", text).alias("rid"))
    marks = base.select("rid", "text").mapInArrow(_anchoring(span), "h long, c long, d long, rid long")
    # counts are written before they are joined: both sides of the join are then exchanges, so that one very common
    # anchor can be split over tasks, which it can't where the counting and the join share an exchange
    often = cut(marks.groupBy("h").agg(F.count("*").alias("n"), *(f(x).alias(f"{x}{k}") for x in "cd" for k, f in enumerate((F.min, F.max)))).where("n > 1"))
    # the anchors that occur again, written once: all that follows starts from them
    seen = cut(marks.join(often.select("h", F.expr("c0 != c1 or d0 != d1").alias("mixed")), "h"))
    mixed = seen.where("mixed").select("h", "c", "d", "rid")
    kinds = cut(mixed.groupBy("h", "c", "d").agg(F.count("*").alias("n"), F.min("rid").alias("first")))
    # written, so that anchors with many contexts can be split over tasks here too
    alone = cut(kinds.where("n = 1").select("h").distinct())
    # contexts that occur once are searched for; of the others with such a one beside them, one is shown to it
    flags = kinds.where("n = 1").select(F.col("first").alias("rid"), "c", F.lit(1).alias("flag")).unionByName(
        kinds.where("n > 1").join(alone, "h", "left_semi").select(F.col("first").alias("rid"), "c", F.lit(2).alias("flag"))
    ).unionByName(
        mixed.join(kinds.where("n > 1").select("h", "c", "d"), ["h", "c", "d"], "left_semi").select("rid", "c", F.lit(0).alias("flag"))
    ).unionByName(seen.where("not mixed").select("rid", "c", F.lit(0).alias("flag")))
    of = lambda k: F.collect_set(F.when(F.col("flag") == k, F.col("c")))
    lists = flags.groupBy("rid").agg(of(0).alias("full"), of(1).alias("lone"), of(2).alias("shown"))
    known = base.join(lists, "rid", "left")
    contexts = known.mapInArrow(_contexts(span), "h long, single boolean, near int, context binary, rid long, verify long, at long")
    found = contexts.repartition("h").sortWithinPartitions("h").mapInArrow(_windows(span), "rid long, verify long, lo long, hi long")
    mine = found.groupBy("rid").agg(F.collect_list(F.struct("verify", "lo", "hi")).alias("runs"))
    mine = mine.select("rid", *(F.col(f"runs.{x}").alias(x) for x in ("verify", "lo", "hi")))
    schema = f"doc_id {kind}, n_bytes long, removed array<struct<start:long,stop:long>>, kept binary"
    return known.join(mine, "rid", "left").mapInArrow(_cutting(span, ["doc_id", "n_bytes", "removed", "kept"]), schema)

