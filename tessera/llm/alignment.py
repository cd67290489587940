"""Alignment of two tokenizers over the same texts, in DuckDB per Arrow partition.

Neither tokenizer has a token that goes on over a space after something
else, so a text may be cut there. The different units of a block of texts are
tokenised once. Both token sequences become interval tables over the bytes of the
units: an ASOF join finds for each token of A the token of B that holds
its last byte, a window sum over those that end together numbers the groups, and a
range join brings the tokens of B to groups that are more than one token to one.
Units are remembered from block to block, in tables of the same DuckDB, which
also joins them with the texts that hold them.

Each block of texts yields its partial counts of id pairs; Spark adds these
up, and brings to each block the totals of its own pairs alone, so no table of pairs
is broadcast and a pair that every text has is one row a block.
"""

from __future__ import annotations

import base64
import gc
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import stored

A, B = "byte_bpe_50k", "piece_bpe_32k"
#: Characters of text, about, in a block.
BLOCK = 1_000_000
#: Units, and characters of units, remembered from block to block; those of the block at hand are all known.
KNOWN, KNOWN_CHARS = 150_000, 4_000_000
UNIT = re.compile(r"(?<=\S)(?= )")
#: Where this is absent, all single spaces follow something else.
ODD = re.compile(r"\s ")

#: Over the new units u(u, s), and their tokens a(id, s, e) and b(j, id, s, e), in bytes from the first unit on.
STEPS = {
    "met": "SELECT a.id, a.s, a.e, b.j, b.id AS b, b.s AS b_s, b.e = a.e AS together FROM a ASOF JOIN b ON a.e > b.s",
    "numbered": "SELECT *, coalesce(sum(together::INT) OVER (ORDER BY e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS g FROM met",
    "groups": "SELECT g, id, b, j, e, lag(e, 1, 0) OVER (ORDER BY e) AS s, s = lag(e, 1, 0) OVER (ORDER BY e) AND b_s = s AS single FROM numbered WHERE together",
    "several": "SELECT g, s, e FROM groups WHERE NOT single",
    "of_a": "SELECT g, string_agg(id::VARCHAR, ',') AS ids FROM (SELECT g, id FROM numbered SEMI JOIN several USING (g) ORDER BY numbered.e) GROUP BY g",
    "of_b": "SELECT g, string_agg(id::VARCHAR, ',') AS ids FROM (SELECT g, r.id FROM (SELECT * FROM b ANTI JOIN (SELECT j FROM groups WHERE single) USING (j)) r JOIN several ON r.s >= several.s AND r.e <= several.e ORDER BY j) GROUP BY g",
    "said": "SELECT g, e, id || '|' || b AS x FROM groups WHERE single UNION ALL SELECT g, e, of_a.ids || '|' || of_b.ids FROM several JOIN of_a USING (g) JOIN of_b USING (g)",
}
TEXTS = "SELECT string_agg(x, ';') AS groups, count(*) AS n FROM (SELECT u, x FROM said ASOF JOIN u ON said.e > u.s ORDER BY g) GROUP BY u ORDER BY u"
LINKS = "INSERT INTO links SELECT u, id::BIGINT << 32 | b FROM groups ASOF JOIN u ON groups.e > u.s"
PAIRS = "SELECT d, pair, sum(n)::BIGINT AS times FROM (SELECT d, u, count(*) AS n FROM held GROUP BY d, u) JOIN links USING (u) GROUP BY d, pair ORDER BY d, pair"


class Numbers(dict):
    """Numbers of units in order of their first use; those in ``new`` have been added since it was emptied."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        n = self[unit] = len(self)
        self.new.append(unit)
        return n


class Aligner:
    """Alignment of texts in one DuckDB connection with one thread."""

    def __init__(self, a: str = A, b: str = B):
        import duckdb
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(public_tokenizers.path(f"{a}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
        self.a = tiktoken.Encoding(a, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{b}.model"))
        self.length_a = np.zeros(max(ranks.values()) + 1, np.int64)
        self.length_a[list(ranks.values())] = [*map(len, ranks)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.length_b = np.array([*map(len, self.bytes_b)])
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        self.con = duckdb.connect()
        self.con.execute("SET threads = 1; SET enable_progress_bar = false")
        self.forget()

    def forget(self) -> None:
        """Empty what is remembered of units: numbers, groups as text, and (tokens of A, of B, groups), none for those whose bytes change."""
        self.number, self.said, self.sizes, self.chars = Numbers(), [], np.zeros((0, 3), np.int64), 0
        self.con.execute("CREATE OR REPLACE TABLE links (u BIGINT, pair BIGINT)")

    def split(self, text: str | None) -> list[str]:
        # the sign that stands for a space in B comes back as one, so such a text changes
        if not text or "▁" in text:
            return []
        text = f" {text}"
        if not self.cuts:
            return [text]
        return UNIT.split(text) if ODD.search(text) else [f" {w}" for w in text[1:].split(" ")]

    def of_a(self, units: list[str]) -> list[int]:
        """Ids of A of all units, in one text; white space at the end of a unit would join with the space of the next one."""
        out, at = [], 0
        for k in [k for k, u in enumerate(units) if u[-1].isspace() or not self.cuts]:
            out += self.a.encode_ordinary("".join(units[at:k])) + self.a.encode_ordinary(units[k])
            at = k + 1
        return out + self.a.encode_ordinary("".join(units[at:]))

    def of_b(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which units come back from B as they were, their lengths in bytes, and the ids of these."""
        lists, raw = self.b.encode([u[1:] for u in units], num_threads=1), [u.encode() for u in units]
        if " " in units:  # nothing but the space that B adds, which it leaves out if nothing follows
            lists[units.index(" ")] = [self.b.piece_to_id("▁")]
        size, many = np.array([*map(len, raw)], np.int64), np.array([*map(len, lists)], np.int64)
        ids = np.fromiter(chain.from_iterable(lists), np.int32)
        ends = np.concatenate([[0], np.cumsum(self.length_b[ids])])[np.cumsum(many)]
        same = np.ones(len(units), bool)
        # mostly none changes, which all bytes together and the places of their ends show
        if (ends != np.cumsum(size)).any() or b"".join(map(self.bytes_b.__getitem__, ids.tolist())) != b"".join(raw):
            same = np.array([b"".join(map(self.bytes_b.__getitem__, x)) == r for x, r in zip(lists, raw)])
        return same, size[same], ids[np.repeat(same, many)]

    def learn(self, units: list[str]) -> None:
        """Tokenise and align the units that have been numbered last."""
        same, size, ids_b = self.of_b(units)
        base, sizes = len(self.said), np.zeros((len(units), 3), np.int64)
        self.chars += int(size.sum())
        said = np.full(len(units), None, object)
        if same.any():
            at = np.flatnonzero(same)
            ids_a = np.array(self.of_a(units if same.all() else [units[k] for k in at]), np.int32)
            ends, e_a, e_b = np.cumsum(size), np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
            tables = {"u": pa.table({"u": base + at, "s": ends - size})}
            tables["a"] = pa.table({"id": ids_a, "s": e_a - self.length_a[ids_a], "e": e_a})
            tables["b"] = pa.table({"j": np.arange(len(ids_b)), "id": ids_b, "s": e_b - self.length_b[ids_b], "e": e_b})
            for name, t in tables.items():
                self.con.register(name, t)
            for name, sql in STEPS.items():
                self.con.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS {sql}")
            self.con.execute(LINKS)
            found = self.con.sql(TEXTS).to_arrow_table()
            for name in STEPS:
                self.con.execute(f"DROP TABLE {name}")
            for name in tables:
                self.con.unregister(name)
            said[at] = found.column("groups").to_numpy()
            sizes[at] = np.stack([*(np.bincount(np.searchsorted(ends, e), minlength=len(at)) for e in (e_a, e_b)), found.column("n").to_numpy()], 1)
        self.said += said.tolist()
        self.sizes = np.concatenate([self.sizes, sizes])

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], tuple[np.ndarray, ...]]:
        """Tokens of A, of B and groups of each text; its groups; and of all linked pairs (text, pair, times)."""
        if len(self.number) > KNOWN or self.chars > KNOWN_CHARS:
            self.forget()
        held = [[*map(self.number.__getitem__, self.split(t))] for t in texts]
        if self.number.new:
            self.learn(self.number.new)
            self.number.new = []
        flat = np.fromiter(chain.from_iterable(held), np.int64)
        row = np.repeat(np.arange(len(texts)), [*map(len, held)])
        sizes = self.sizes[flat]
        changed = np.zeros(len(texts), bool)
        changed[row[sizes[:, 2] == 0]] = True
        groups = ["" if c else ";".join(map(self.said.__getitem__, h)) for h, c in zip(held, changed)]
        kept = ~changed[row]
        sizes = np.stack([np.bincount(row, np.where(kept, sizes[:, k], 0), len(texts)) for k in range(3)], 1).astype(np.int64)
        self.con.register("held", pa.table({"d": row[kept], "u": flat[kept]}))
        pairs = self.con.execute(PAIRS).fetchnumpy()
        self.con.unregister("held")
        return sizes, groups, tuple(np.asarray(pairs[c], np.int64) for c in ("d", "pair", "times"))


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _aligning(a: str, b: str):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number, id_type = Aligner(a, b), TaskContext.get().partitionId() << 32, None

        def block(ids: list, texts: list) -> pa.RecordBatch:
            n = len(ids)
            sizes, groups, (row, pair, times) = aligner.texts(texts)
            whole, at = np.unique(pair, return_inverse=True)
            total = np.bincount(at, times, len(whole)).astype(np.int64)
            columns = [pa.array([number] * (n + 1)), pa.array([False] * n + [True]), pa.array([*ids, None], id_type)]
            columns += [pa.array([*sizes[:, k], 0], pa.int64()) for k in (0, 1, 2, 2)] + [pa.array([*groups, None], pa.string())]
            offsets = pa.array([*np.searchsorted(row, np.arange(n + 1)), len(pair) + len(whole)], pa.int32())
            columns += [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x))) for x in ((pair, whole), (times, total))]
            return pa.RecordBatch.from_arrays(columns, ["block", "lexicon", "doc_id", *COUNTS, "groups", "pairs", "times"])

        gc.disable()  # millions of short lists, none of them in a cycle
        ids, texts, size = [], [], 0
        for batch in batches:
            id_type = batch.schema.types[0]
            for doc, text in zip(batch.column(0), batch.column(1)):
                ids.append(doc.as_py())
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size >= BLOCK:
                    yield block(ids, texts)
                    ids, texts, size, number = [], [], 0, number + 1
        if ids:
            yield block(ids, texts)

    return align


def aligned(docs: DataFrame, a: str = A, b: str = B) -> DataFrame:
    """``docs(doc_id, text)`` -> a row for each text with its alignment, and a row for each block with the counts of its pairs.

    ``groups`` has the ids of A and of B between one common end and the next as ``a1,a2|b1;a3|b2``;
    ``pairs`` the different linked pairs, a * 2^32 + b, and ``times`` how often each is linked. Rows
    whose ``lexicon`` is true hold the pairs of a whole block and no text. Texts
    that are null, empty, or whose bytes change in a tokenizer have no tokens, an empty ``groups`` and zeros.
    Texts of any length are aligned whole. Repeated rows and null ids are texts
    like any other; other columns are ignored; no rows give no rows. Not stored: each use aligns again.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"block long, lexicon boolean, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
    return docs.select("doc_id", "text").mapInArrow(_aligning(a, b), schema)


def pair_counts(table: DataFrame) -> DataFrame:
    """Of an aligned table: ``(pair, a, b, count, best)``, best if no other pair of the same id of B is linked more often.

    Adds up the partial counts of the blocks; the pairs of one id of B are no more than A has ids.
    """
    partial = table.where("lexicon").select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("x.*")
    total = partial.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"))
    split = total.select("pair", F.shiftright("pair", 32).cast("int").alias("a"), F.expr("cast(pair & 4294967295 as int)").alias("b"), "count")
    return split.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def counted(table: DataFrame) -> DataFrame:
    """The texts of an aligned table, with ``n_best``, how many links are their B id's most frequent pair, and ``count_sum``, the counts of all links added up.

    The table is stored once; further columns stay, but for the pairs. Totals of pairs meet each block that has them, where
    a text looks up its own. Texts without tokens have zeros; ties are all best.
    """
    kept = stored(table)
    asked = kept.where("lexicon").select(F.col("block").alias("of"), F.explode("pairs").alias("pair"))
    known = asked.join(pair_counts(kept).select("pair", "count", "best"), "pair")
    texts = kept.where("not lexicon").drop("lexicon")
    out = [c for c in texts.columns if c not in ("block", "pairs", "times")]

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        order = pc.sort_indices(right, [("pair", "ascending")])
        pair, count, best = (right.column(c).take(order).to_numpy() for c in ("pair", "count", "best"))
        lists = left.column("pairs").combine_chunks()
        own, times = lists.flatten().to_numpy(), left.column("times").combine_chunks().flatten().to_numpy()
        row = np.repeat(np.arange(len(left)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        at = np.searchsorted(pair, own)
        sums = []
        for weight in (best, count) if len(own) else ():
            total = np.zeros(len(left), np.int64)
            np.add.at(total, row, times * weight[at].astype(np.int64))
            sums.append(total)
        n_best, count_sum = sums or (np.zeros(len(left), np.int64),) * 2
        return left.select(out).append_column("n_best", pa.array(n_best)).append_column("count_sum", pa.array(count_sum))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema if f.name in out)
    return texts.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(look_up, f"{schema}, n_best long, count_sum long")
