"""Line dedup over content-defined chunks of lines.

A rolling hash over the hashes of the last ``ROLL`` lines chooses where chunks
end, so boundaries follow the content and move with it.

1. Chunks of two or more lines that occur at an earlier place (less doc_id,
   then place, the same document included) are removed whole.
2. A repeated run need not begin or end at a boundary. So matches are extended
   line by line: of the chunks that stay, and over the edge from each chunk to
   the next, two lines in a row that occur at an earlier place go as well, and
   so does a line with blank ones behind or before it, however many. Any
   repeated run of two or more lines that are not all blank is a union of these,
   so it goes wherever it begins, and where the boundaries fall decides only how
   much is left to compare line by line. No boundary is next to a blank line.

Bytes are compared through the lines: a table of all distinct lines shows that
no hash of a line stands for two contents (else lines are hashed anew with
another seed), so equal hashes of lines are equal bytes. Blank lines in a row
are told apart by 64 bits of all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import cut

#: Lines that the rolling hash sees, and after one in how many of them a chunk ends.
ROLL, EVERY = 2, 4


def line_hash(line: bytes, seed: int = 0) -> int:
    """64 bits as a signed integer, the last one 0 for lines of nothing but white space."""
    import xxhash

    return (xxhash.xxh3_64_intdigest(line, seed) - (1 << 63)) & ~1 | bool(line.strip())


def boundaries(hashes: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a text's lines, from the hashes of its lines; the last one ends the text."""
    h = hashes.view(np.uint64)
    rolled = h.copy()
    for k in range(1, ROLL):
        rolled[k:] += h[:-k] * np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) & (1 << 64) - 1)
    rolled ^= rolled >> np.uint64(31)
    rolled *= np.uint64(0xD6E8FEB86659FD93)
    ends = np.flatnonzero((rolled >> np.uint64(33)) % np.uint64(EVERY) == 0) + 1
    said = (hashes & 1).astype(bool)
    ends = ends[said[ends - 1] & said[np.minimum(ends, len(h) - 1)]]
    return ends if len(ends) and ends[-1] == len(h) else np.append(ends, len(h))


def blank_links(lines: list[bytes], said: np.ndarray, hashes: np.ndarray, seed: int = 0) -> list[tuple[int, int, int, int]]:
    """(hash of a line, hash of the blank lines behind or before it, first line, end) for every number of these."""
    import xxhash

    out = []
    edges = np.flatnonzero(np.diff(np.concatenate([[1], said, [1]])))
    for start, end in edges.reshape(-1, 2).tolist():
        # behind the line before them, then before the line behind them
        for near, order in ((start - 1, range(start, end)), (end, range(end - 1, start - 1, -1))):
            if 0 <= near < len(lines):
                whole = xxhash.xxh3_64(seed=2 * seed + 1 + (near == end))
                for k in order:
                    whole.update(lines[k] + b"\n")
                    out.append((int(hashes[near]), whole.intdigest() - (1 << 63), min(near, k), max(near, k) + 1))
    return sorted(out, key=lambda x: x[2])


def _lines(seed: int):
    """Hash and bytes of the lines of texts that have more than one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column("text").cast(pa.binary()):
                lines = t.as_py().split(b"\n")
                if len(lines) > 1:
                    lines = list(set(lines))
                    yield pa.RecordBatch.from_arrays([pa.array([line_hash(x, seed) for x in lines], pa.int64()), pa.array(lines, pa.binary())], ["h", "line"])

    return run


def _chunking(seed: int):
    """A row for each chunk: its place, the hashes of its lines, that of the line behind it, and the links of its blank lines."""
    links = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("line", pa.int32()), ("upto", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            which, first, hashes, behind, blank = [], [], [], [], []
            for i, t in enumerate(b.column("text").cast(pa.binary())):
                lines = t.as_py().split(b"\n")
                if len(lines) > 1:
                    h = np.array([line_hash(x, seed) for x in lines], np.int64)
                    said = h & 1
                    near = [] if said.all() else blank_links(lines, said, h, seed)
                    start = at = 0
                    for end in boundaries(h).tolist():
                        upto = at
                        while upto < len(near) and near[upto][2] < end:
                            upto += 1
                        blank.append([dict(zip(("a", "b", "line", "upto"), x)) for x in near[at:upto]])
                        at = upto
                        which.append(i)
                        first.append(start)
                        hashes.append(h[start:end])
                        behind.append(int(h[end]) if end < len(h) else None)
                        start = end
            at = pa.array(which, pa.int64())
            columns = [b.column("doc_id").take(at), b.column("tie").take(at), pa.array(first, pa.int32()), pa.array(hashes, pa.list_(pa.int64())), pa.array(behind, pa.int64()), pa.array(blank, links)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tie", "line", "hashes", "behind", "blank"])

    return run


def repeats(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, tie, text)``, no text null -> ``(doc_id, tie, gone)``: first lines and ends of the runs to remove."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    seed = 0
    while docs.mapInArrow(_lines(seed), "h long, line binary").distinct().groupBy("h").count().where("count > 1").limit(1).count():
        seed += 1
    chunks = cut(docs.mapInArrow(_chunking(seed), f"doc_id {kind}, tie long, line int, hashes array<long>, behind long, blank array<struct<a:long,b:long,line:int,upto:int>>"))
    place = F.struct("doc_id", "tie", "line")
    # counts are written before they are joined, so that a very common chunk or pair can be split over tasks
    first = cut(chunks.where("size(hashes) > 1 and exists(hashes, h -> h & 1 = 1)").groupBy("hashes").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    marked = chunks.join(first, "hashes", "left").withColumn("gone", F.col("first").isNotNull() & ~place.eqNullSafe(F.col("first")))
    inside = F.expr("transform(sequence(0, size(hashes) - 2), i -> struct(hashes[i] as a, hashes[i + 1] as b, line + i as line, line + i + 2 as upto))")
    over = F.expr("struct(element_at(hashes, -1) as a, behind as b, line + size(hashes) - 1 as line, line + size(hashes) + 1 as upto)")
    none = F.expr("cast(array() as array<struct<a:long,b:long,line:int,upto:int>>)")
    both = lambda x: (x["a"].bitwiseAND(x["b"]).bitwiseAND(F.lit(1))) == 1
    pairs = [F.when(~F.col("gone") & (F.size("hashes") > 1), F.filter(inside, both)).otherwise(none), F.when(F.col("behind").isNotNull(), F.array(over)).otherwise(none)]
    pairs = marked.select("doc_id", "tie", F.inline(F.concat(*pairs, F.when(F.col("gone"), none).otherwise(F.col("blank")))))
    firsts = cut(pairs.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    later = pairs.join(firsts, ["a", "b"]).where(~place.eqNullSafe(F.col("first")))
    runs = marked.where("gone").select("doc_id", "tie", "line", (F.col("line") + F.size("hashes")).alias("upto"))
    runs = runs.unionByName(later.select("doc_id", "tie", "line", "upto"))
    return runs.groupBy("doc_id", "tie").agg(F.collect_set(F.struct("line", "upto")).alias("gone"))


def _removing(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, removed, runs, kept = [], [], [], []
            gone = b.column("gone")
            for k, t in enumerate(b.column("text").cast(pa.binary())):
                text = t.as_py()
                lines = text.split(b"\n") if text else []
                total.append(len(lines))
                runs.append(0)
                if gone[k].is_valid:
                    out, ranges = np.zeros(len(lines) + 1, np.int64), gone[k].values
                    np.add.at(out, ranges.field("line").to_numpy(), 1)
                    np.add.at(out, ranges.field("upto").to_numpy(), -1)
                    out = np.cumsum(out)[:-1] > 0
                    runs[-1] = int(out[0]) + int((out[1:] & ~out[:-1]).sum())
                    lines = [x for x, drop in zip(lines, out.tolist()) if not drop]
                    text = b"\n".join(lines)
                removed.append(total[-1] - len(lines))
                kept.append(text)
            new = {"text": pa.array(kept, pa.binary()).cast(pa.string()), "n_lines": pa.array(total, pa.int64()), "n_lines_removed": pa.array(removed, pa.int64()), "n_chunks_removed": pa.array(runs, pa.int64())}
            yield pa.RecordBatch.from_arrays([new[x] if x in new else b.column(x) for x in names], names)

    return run


COUNTS = ("n_lines", "n_lines_removed", "n_chunks_removed")


def _deduped(docs: DataFrame) -> DataFrame:
    """(row, text, counts): the rows as structs, so that no name of theirs can clash, and the new texts."""
    tied = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"), F.struct(*(docs[c] for c in docs.columns if c != "text"), F.lit(1).alias("_")).alias("row"))
    gone = repeats(tied.select("doc_id", "tie", "text").where("length(text) > 0"))
    gone = gone.select(F.col("doc_id").alias("id2"), F.col("tie").alias("tie2"), "gone")
    both = tied.join(gone, tied["doc_id"].eqNullSafe(gone["id2"]) & (tied["tie"] == gone["tie2"]), "left").select("row", "text", "gone")
    schema = T.StructType([both.schema["row"], both.schema["text"], *(T.StructField(x, T.LongType()) for x in COUNTS)])
    return both.mapInArrow(_removing(schema.names), schema)


def dedup(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> the same rows, text without repeated runs of lines, and three counts.

    ``n_lines``, ``n_lines_removed`` and ``n_chunks_removed`` (runs of removed lines) are added, or
    take the place of columns so called. Of a repeated run the occurrence with the least doc_id and place stays
    (null ids first). Runs that hold nothing but white space are no repeats. Null and empty texts have no lines
    and stay as they are. A row that is there twice counts as one document.
    Rows with equal or null ids and different texts are told apart by their
    content. Texts of any length are taken whole; a text's lines are held by one task. No rows give no rows.
    """
    return _deduped(docs).select(*(F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c not in COUNTS), *COUNTS)


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents with repeated runs of lines cut out, same columns; ``n_chars``, where there, counts again."""

    def column(c: str):
        if c == "n_chars":
            return F.when(F.col("text").isNull(), F.col("row")[c]).otherwise(F.char_length("text")).cast(docs.schema[c].dataType).alias(c)
        return F.col("text") if c == "text" else F.col("row")[c].alias(c)

    return _deduped(docs).select(*map(column, docs.columns))
