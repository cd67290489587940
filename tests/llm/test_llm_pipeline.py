"""The pipeline: stages, columns, and each stage's decisions against plain Python."""

import re

import corpus_pipeline
import numpy as np
from nasty import CLASHES, documents, empty

from tessera.llm import decontaminate, packing

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_are_those_asked_for():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near dedup", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_takes_effect(spark, tmp_path):
    docs, kept = spark.read.parquet(f"{DATA}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept.append(docs.toPandas())
        if k < 4:
            assert docs.columns == COLUMNS
    clean, cut, one, free, packed = kept
    bad = re.compile(r"\b(idiot|moron|worthless|scum|pathetic|loser)\b", re.I)
    whole = spark.read.parquet(f"{DATA}/documents.parquet").toPandas()
    assert sum(bool(bad.search(t)) for t in clean.text) < 0.5 * sum(bool(bad.search(t)) for t in whole.text)
    # lines: every run of two lines or more stays once, in its first place
    seen = set()
    for i, t in clean.sort_values("doc_id")[["doc_id", "text"]].itertuples(index=False):
        ls, gone = t.encode().split(b"\n"), set()
        for a in range(len(ls) - 1):
            pair = (ls[a], ls[a + 1])
            if any(x.strip() for x in pair):
                gone.update((a, a + 1) if pair in seen else ())
                seen.add(pair)
        want = b"\n".join(x for k, x in enumerate(ls) if k not in gone).decode()
        got = cut[cut.doc_id == i].iloc[0]
        assert got.text == want and got.n_chars == len(want)
    # near copies: one of each group stays
    from test_llm_operators import groups_by_hand

    want = groups_by_hand(list(zip(cut.doc_id, cut.text)))
    assert want <= set(one.doc_id) and len(set(one.doc_id) - want) <= 0.02 * len(want)
    # benchmark: those with a window go
    wins = {w for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect() for w in decontaminate.windows(r.text.encode(), 10)}
    sizes = {len(w) for w in wins}

    def hit(t):
        w = decontaminate.words(t.encode())
        return any(tuple(w[k : k + n]) in wins for n in sizes for k in range(len(w) - n + 1))

    assert set(free.doc_id) == {i for i, t in zip(one.doc_id, one.text) if not hit(t)}
    # packing: all ids of what is left
    encode = packing.encoder()
    assert packed.groupby("doc_id").length.sum().to_dict() == {i: len(encode(t)) + 1 for i, t in zip(free.doc_id, free.text)}
    assert packed.groupby("sequence_id").length.sum().max() <= 2048
    through = corpus_pipeline.run(spark, DATA).toPandas()
    order = ["doc_id", "piece"]
    assert np.array_equal(through.sort_values(order)[["doc_id", "piece", "length", "ids_crc32"]].to_numpy(), packed.sort_values(order)[["doc_id", "piece", "length", "ids_crc32"]].to_numpy())


def test_stages_on_documents_that_try_them(spark):
    for which in (documents, empty):
        docs = which(spark)
        columns = docs.columns
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, DATA)
            if k < 4:
                assert docs.columns == columns
                assert docs.where(" or ".join(f"{c} != 'kept'" for c in CLASHES)).count() == 0
        docs.count()
