"""Best-fit packing with certified bounds.

Documents are tokenised and cut to pieces once. Pieces are dealt by hash to
partitions of about ``PER_TASK`` pieces; each is packed best-fit decreasing.
Dual-feasible functions give a lower bound of its number of bins. Where best
fit meets the bound, no packing of that partition has fewer bins. Partitions
with a gap, and the open last bin of the others, put the documents of their
least filled bins into an exchange, which is dealt and packed again, until
one partition holds what is left.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut

PER_TASK = 50_000
TOKENIZER = "byte_bpe_50k"
END = "<|endoftext|>"


def encoder(name: str = TOKENIZER):
    """Text -> ids of the public tokenizer ``name``, equal to those of its json file.

    The rank file of the same vocabulary gives the same ids in a quarter of
    the time; a text that spells the special token goes to the json file's own
    tokenizer, which reads it as one id.
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast, slow = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), []

    def encode(text: str) -> list[int]:
        if END not in text:
            return fast.encode_ordinary(text)
        if not slow:
            from tokenizers import Tokenizer

            slow.append(Tokenizer.from_file(public_tokenizers.path(f"{name}.json")))
        return slow[0].encode(text, add_special_tokens=False).ids

    return encode


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full ones but for the first."""
    first = n % size or size
    return [(0, min(n, first))] + [(s, size) for s in range(first, n, size)]


def _pieces(size: int, name: str, with_ids: bool = False):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(name)
        for b in batches:
            out = []
            for doc, text in zip(b.column(0), b.column(1)):
                ids = np.array([*encode(text.as_py() or ""), 0], "<u4")
                for k, (start, n) in enumerate(cuts(len(ids), size)):
                    own = ids[start : start + n]
                    out.append((doc.as_py(), k, start, n, zlib.crc32(own.tobytes()), own.astype("i4") if with_ids else None))
            doc, *rest = zip(*out) if out else [()] * 6
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
            columns = [pa.array(doc, b.schema.types[0]), *map(pa.array, rest, types)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(columns[: 5 + with_ids], names[: 5 + with_ids])

    return pieces


def best_fit(lengths: np.ndarray, size: int) -> np.ndarray:
    """Bin of each length (given in decreasing order), best fit, ties to the newest bin.

    One integer's bits say which amounts of free space some bin has, so the
    smallest that suffices is found in one step.
    """
    free, some, bins, out = [[] for _ in range(size + 1)], 0, 0, np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        if above := some >> n:
            room = n + ((above & -above).bit_length() - 1)
            k = free[room].pop()
            if not free[room]:
                some ^= 1 << room
        else:
            room, k, bins = size, bins, bins + 1
        out[i] = k
        if room > n:
            free[room - n].append(k)
            some |= 1 << (room - n)
    return out


def lower_bound(lengths: np.ndarray, size: int, times: np.ndarray | None = None) -> int:
    """Bins that any packing needs: the best of a family of dual-feasible functions.

    u_k rounds sizes down to k-ths of a bin but keeps multiples of 1/(k+1);
    before it, sizes over ``size - e`` may count as whole bins where those
    under ``e`` count as nothing. With ``times`` each length stands for so many.
    """
    x, n = np.unique(np.asarray(lengths, np.int64), return_counts=True) if times is None else (lengths[np.argsort(lengths)], times[np.argsort(lengths)])
    best = -(-int((x * n).sum()) // size) if len(x) else 0
    cut_at = x[x <= size // 2]
    for e in [0, *np.unique(cut_at[np.linspace(0, len(cut_at) - 1, min(len(cut_at), 64)).astype(int)] if len(cut_at) else []).tolist()]:
        y = np.where(x > size - e, size, np.where(x < e, 0, x)) if e else x
        best = max(best, -(-int((y * n).sum()) // size))
        for k in range(1, 12):
            u = np.where(y * (k + 1) % size == 0, y * k, (k + 1) * y // size * size)
            best = max(best, -(-int((u * n).sum()) // (size * k)))
    return best


COLUMNS = ("doc_id", "piece", "start", "length", "ids_crc32")
PLACED = ("sequence_id", "offset", "bins", "bound", "certified")


def packed(rows: pa.Table, size: int, last: bool) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, int, int]:
    """One partition's pieces in the order of packing, their bins, offsets, and whether the bin is open (to be exchanged); bins and their bound."""
    rows = rows.take(pc.sort_indices(rows, sort_keys=[("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]))
    n = rows.column("length").to_numpy()
    bins = best_fit(n, size)
    filled = np.bincount(bins, weights=n).astype(np.int64)
    bound = lower_bound(n, size)
    together = np.argsort(bins, kind="stable")
    offset = np.empty(len(n), np.int64)
    offset[together] = np.cumsum(n[together]) - n[together]
    offset -= (np.cumsum(filled) - filled)[bins]
    give = np.zeros(len(filled), bool)
    if not last:
        order = np.argsort(filled, kind="stable")[: 1 + 4 * (len(filled) - bound)]
        give[order] = filled[order] < size
    return rows, bins, offset, give[bins], len(filled), bound


def _packing(size: int, turn: int, last: bool):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if len(b)]
        if held:
            rows, bins, offset, still, many, bound = packed(pa.Table.from_batches(held), size, last)
            base, n = (turn << 56) + (TaskContext.get().partitionId() << 32), len(bins)
            columns = [rows.column(c).combine_chunks() for c in COLUMNS]
            columns += [pa.array(bins + base), pa.array(offset), pa.array(np.full(n, many)), pa.array(np.full(n, bound)), pa.array(np.full(n, many == bound)), pa.array(still)]
            whole = pa.RecordBatch.from_arrays(columns, [*COLUMNS, *PLACED, "open"])
            for at in range(0, n, 10_000):
                yield whole.slice(at, 10_000)

    return pack


def pieces(docs: DataFrame, size: int = 2048, tokenizer: str = TOKENIZER) -> DataFrame:
    """``docs(doc_id, text)`` -> one row a piece, with the checksum of its ids.

    A null or empty text has the closing id 0 alone, and so one piece. Texts of
    any length are cut, never shortened. Null ids and repeated rows have their
    pieces like any other; ids are never converted. Other columns are ignored;
    no rows give no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_pieces(size, tokenizer), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack(cut_pieces: DataFrame, size: int = 2048, per_task: int = PER_TASK, turns: int = 20) -> DataFrame:
    """Pieces -> the same rows with ``sequence_id`` and ``offset``, and the certificate of the partition that packed them.

    ``bins`` is how many sequences that partition's packing took, ``bound`` how
    many any packing of its pieces takes, ``certified`` whether both are equal.
    Every piece is in one sequence; sequences hold ``size`` ids at most and
    have no gaps. Repeated rows are packed one by one; of equal lengths the
    less id comes first, null ids last. After ``turns`` exchanges what is left
    is packed as it is, which may leave gaps, never pieces. No rows give no rows.
    """
    kind = cut_pieces.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, bins long, bound long, certified boolean, open boolean"
    pool, done, turn = cut(cut_pieces.select(*COLUMNS)), None, 0
    n = pool.count()
    while True:
        tasks = max(1, -(-n // per_task))
        last = tasks == 1 or turn >= turns
        # dealt in an order that hashing alone fixes, so that a task run again packs the same rows
        dealt = pool.repartition(tasks, F.xxhash64("doc_id", "piece", "ids_crc32")) if tasks > 1 else pool.coalesce(1)
        out = dealt.mapInArrow(_packing(size, turn, last), schema)
        if not last:
            out = cut(out)
        ready = out.where("not open").drop("open")
        done = ready if done is None else done.unionByName(ready)
        if last:
            return done
        pool = out.where("open").select(*COLUMNS)
        n, turn = pool.count(), turn + 1


def certificate(packed_pieces: DataFrame, size: int = 2048) -> DataFrame:
    """One row for a whole packing: ``sequences``, the ``bound`` of all pieces together, ``certified`` if they are equal.

    The bound needs how often each length occurs, at most ``size`` rows. No
    pieces take no sequences, which is certified.
    """
    lengths = packed_pieces.groupBy("length").count().collect()
    bound = lower_bound(np.array([r["length"] for r in lengths], np.int64), size, np.array([r["count"] for r in lengths], np.int64))
    return packed_pieces.agg(F.count_distinct("sequence_id").alias("sequences")).select("sequences", F.lit(bound).cast("long").alias("bound"), (F.col("sequences") == bound).alias("certified"))


def sequences(docs: DataFrame, packed_pieces: DataFrame, size: int = 2048, tokenizer: str = TOKENIZER) -> DataFrame:
    """``(sequence_id, ids)``: the token ids of each sequence, from the documents and their packing.

    Documents are encoded again, so only the training set itself moves, once.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids array<int>"
    key = [F.struct("doc_id").alias("d"), "piece", "ids_crc32"]
    ids = docs.select("doc_id", "text").mapInArrow(_pieces(size, tokenizer, True), schema).select(*key, "ids").dropDuplicates(["d", "piece", "ids_crc32"])
    placed = packed_pieces.select(*key, "sequence_id", "offset").join(ids, ["d", "piece", "ids_crc32"])
    whole = F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda s: s["ids"])
    return placed.groupBy("sequence_id").agg(F.flatten(whole).alias("ids"))
