"""Alignment of tokenizers, fill-in-the-middle, and exact top-k search, each against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from nasty import documents, empty
from pyspark.sql import functions as F

from tessera.llm import alignment, infill, queries, topk

ALPHABET = "ab é\n\t 12'.,🙂数  　\x1c▁"
ODD = [None, "", " ", "   ", "\n \n", "a  b   c\n\n  d\t e", " lead", "trail  ", "x  y", "<s> </s> <|endoftext|> <0x0A>", "数据 数据  🙂 é é ", "a▁b c", "'s 't don't  'll", "ﬁ ½ Ⅷ  ．", "x" * 3000, "数" * 2000]


# 11. alignment


def byte_level():
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}


def aligned_by_hand(rows):
    """Rows of op11 for (doc_id, text), from the json file, one text at a time."""
    import sentencepiece
    from tokenizers import Tokenizer

    one, chars = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), byte_level()
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out, linked, held = [], collections.Counter(), []
    for doc, text in rows:
        a, b, links, groups = [], [], [], []
        if text:
            a, b = one.encode(f" {text}", add_special_tokens=False).ids, two.encode(text)
            of_a = [bytes(chars[c] for c in one.id_to_token(i)) for i in a]
            of_b = [bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, two.id_to_piece(i)) for i in b)]
            if not b"".join(of_a) == b"".join(of_b) == f" {text}".encode():
                a, b = [], []
        if a:
            ends_a, ends_b = np.cumsum([*map(len, of_a)]).tolist(), np.cumsum([*map(len, of_b)]).tolist()
            links = [(x, y) for x, e in zip(a, ends_a) for y, f in zip(b, ends_b) if e == f] if len(a) < 500 else [(a[ends_a.index(e)], b[ends_b.index(e)]) for e in sorted({*ends_a} & {*ends_b})]
            start = 0
            for e in sorted({*ends_a} & {*ends_b}):
                groups.append("|".join(",".join(str(i) for i, end in zip(ids, ends) if start < end <= e) for ids, ends in ((a, ends_a), (b, ends_b))))
                start = e
        linked.update(links)
        held.append(links)
        out.append([doc, len(a), len(b), len(groups), len(links), ";".join(groups)])
    best = collections.Counter()
    for (_, y), n in linked.items():
        best[y] = max(best[y], n)
    return sorted(((doc, *counts, sum(linked[p] == best[p[1]] for p in links), sum(linked[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "") for (doc, *counts, g), links in zip(out, held)), key=repr)


def run_op11(docs):
    found = alignment.counted(alignment.aligned(docs).withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups"))
    return sorted((tuple(r) for r in found.select("doc_id", *alignment.COUNTS, "n_best", "count_sum", "groups_sha256").collect()), key=repr)


def test_alignment_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 2000").collect()]
    r = random.Random(3)
    texts = ODD + ["".join(r.choice(ALPHABET) for _ in range(r.randint(1, 40))) for _ in range(300)]
    rows += [(10_000 + k, t) for k, t in enumerate(texts)] + [(10_000, "ties ties"), (None, "no number")]
    assert run_op11(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == aligned_by_hand(rows)


def test_alignment_does_not_depend_on_blocks_or_memory(spark, monkeypatch):
    rows = [(k, f"word{k % 17} and{k % 5} naïve café {k}" * (k % 4)) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    whole = run_op11(docs)
    monkeypatch.setattr(alignment, "BLOCK", 500)
    monkeypatch.setattr(alignment, "KNOWN", 20)
    table = alignment.aligned(docs)
    assert table.where("lexicon").count() > 5 and run_op11(docs) == whole == aligned_by_hand(rows)


def test_groups_and_pairs_come_out(spark):
    table = alignment.aligned(spark.createDataFrame([(1, "naïve café")], "doc_id long, text string"))
    groups = table.where("not lexicon").first().groups
    counts = alignment.pair_counts(table).collect()
    assert all(re.fullmatch(r"[\d,]+\|[\d,]+", g) for g in groups.split(";")) and len(groups.split(";")) == sum(c["count"] for c in counts)
    assert all(c.pair == c.a * 2**32 + c.b and c.best for c in counts)


def test_alignment_of_documents_that_try_it(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    short = [(i, t) for i, t in rows if len(t or "") < 6000]
    assert run_op11(documents(spark).where("coalesce(length(text), 0) < 6000")) == aligned_by_hand(short)
    assert len(run_op11(documents(spark))) == len(rows) and run_op11(empty(spark)) == []


# 12. fill-in-the-middle


def infilled_by_hand(doc, text, seed=1):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc, n, "plain", None, None, None, text
    p, q = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b, c = "".join(units[:p]), "".join(units[p:q]), "".join(units[q:])
    return (doc, n, "spm", a, b, c, f"<S>{c}<P>{a}<M>{b}") if h[3] % 100 < 20 else (doc, n, "psm", a, b, c, f"<P>{a}<S>{c}<M>{b}")


def test_infill_equals_brute_force(spark):
    r = random.Random(5)
    rows = [(k, "".join(r.choice("ab<PSM>\x01\x02em12 é🙂\n\0") for _ in range(r.randint(0, 30)))) for k in range(1500)]
    rows += [(9, "x"), (9, "x"), (None, "ab cd"), (None, None), (7, None), (8, ""), (11, "<<P<S<M> "), (12, "\x01\x02\x02e\x01m" * 50), (13, "word " * 20000), (14, "<P>")]
    found = infill.transformed(spark.createDataFrame(rows, "doc_id long, text string"))
    back = found.select("*", infill.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert sorted((tuple(x)[:7] for x in back), key=repr) == sorted((infilled_by_hand(*x) for x in rows), key=repr)
    assert sorted(x.back for x in back) == sorted(t or "" for _, t in rows)
    assert {x.form for x in back} == {"plain", "psm", "spm"} and min(len(x.prefix) for x in back if x.form != "plain") == 0


def test_infill_of_documents_that_try_it(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    assert sorted((tuple(r) for r in infill.transformed(documents(spark)).collect()), key=repr) == sorted((infilled_by_hand(*x) for x in rows), key=repr)
    assert infill.transformed(empty(spark)).count() == 0


def test_infill_moves_nothing_and_runs_no_python(spark):
    plan = queries.op12_infill(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


# 13. exact top-k search


def best_by_hand(rows, k=10):
    """(query_id, rank, vec_id, score) of rows (vec_id, integers), queries by hundreds."""
    out, asked = [], {(i, tuple(v)) for i, v in rows if i is not None and i % 100 == 0 and v is not None}
    for i, q in asked:
        found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in rows if j is not None and v is not None and j != i and len(v) == len(q))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found[:k])]
    return sorted(out)


def run_op13(spark, rows, **more):
    t = spark.createDataFrame(rows, "vec_id long, v array<long>").repartition(3)
    return sorted(tuple(r) for r in topk.search(t, t.where("vec_id % 100 = 0"), **more).collect())


@pytest.mark.parametrize("block_bytes", [32_000_000, 700])
def test_topk_equals_brute_force(spark, block_bytes):
    r = random.Random(block_bytes)
    rows = [(k, [r.randint(-3, 3) for _ in range(4)]) for k in range(-150, 450)]
    rows += [(1000 + k, [1, 1, 1, 1]) for k in range(200)]  # a large group of copies, ties all of them
    rows += [(100, [2, 0, 0, 1]), (100, [2, 0, 0, 1]), (None, [9, 9, 9, 9]), (2000, None), (2100, [1, 2]), (2101, [3]), (2200, [])]
    assert run_op13(spark, rows, block_bytes=block_bytes, fan=3) == best_by_hand(rows)


def test_topk_of_large_components(spark):
    big = 2**30
    rows = [(k, [big + k % 3, -big + k % 7, k]) for k in range(0, 320, 4)]
    assert run_op13(spark, rows) == best_by_hand(rows)
    over = run_op13(spark, [(0, [2**62, 5]), (1, [4, 0]), (2, [-4, 0]), (3, [0, 1])])
    assert over == [(0, 1, 1, 2**63 - 1), (0, 2, 3, 5), (0, 3, 2, -(2**63))]


def test_topk_few_rows_and_none(spark):
    assert run_op13(spark, [(0, [1]), (5, [2])]) == [(0, 1, 5, 2)]
    assert run_op13(spark, []) == [] and run_op13(spark, [(0, [1])]) == []


def test_vectors_that_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [0.5, -0.0001]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [-inf, 0.0]), (6, [1e300, 0.0]), (7, [0.25, 1e-9])]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("kept"))
    rows = t.where(topk.whole("embedding")).select("vec_id", topk.scaled("embedding").alias("v"), "score")
    assert {r.vec_id: r.v for r in rows.collect()} == {0: [512, -1], 6: [2**63 - 1, 0], 7: [256, 0]}
    assert [r.vec_id for r in topk.search(rows, rows.where("vec_id = 0")).orderBy("rank").collect()] == [6, 7]
