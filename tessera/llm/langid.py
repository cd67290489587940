"""Language ID by mixture inference over n-gram likelihoods.

Each language has a smoothed distribution over hashed byte trigrams, counted
from at most ``PER_LANGUAGE`` labelled documents of each language. A word has
the likelihood of its trigrams under each language. A document is a mixture:
each word comes from one of its languages, and expectation-maximisation
estimates their proportions. Languages are then ranked by proportion, and the
set of leading languages is taken whose likelihood, less a penalty for each
member, is best; it may hold any number of the learned languages. All words of
a text take part, however long it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 16
#: At most about so many labelled documents of each language are counted.
PER_LANGUAGE = 4000
ROUNDS = 12
#: Each language of a mixture must earn so much log-likelihood, times half the log of the words.
PENALTY = 4.0
#: No word weighs more than so much in favour of one language over another.
CLIP = 12.0
#: What may be a letter; numbers such as a half or a Roman eight are among these and are none.
MAYBE = re.compile(r"[^\W\d_]")
_KEPT = np.array([0x20 if c < 0x80 and not chr(c).isalpha() else c for c in range(256)], np.uint8)


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in MAYBE.finditer(text))


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashed trigram at each letter, where words start among them, words of each text).

    Bytes that are no letters part words; trigrams see one of them on each
    side of a word. Bytes over 0x7F count as letters.
    """
    joined = np.frombuffer(b"  " + b"  ".join(t.lower() for t in texts) + b"  ", np.uint8)
    b = _KEPT[joined]
    at = np.flatnonzero(b[1:-1] != 0x20) + 1
    x = b.astype(np.uint32)
    h = (x[at - 1] * np.uint32(0x9E3779B1) ^ x[at] * np.uint32(0x85EBCA6B) ^ x[at + 1] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)
    h >>= np.uint32(32 - BITS)
    first = np.flatnonzero(b[at - 1] == 0x20)
    ends = np.cumsum([len(t) + 2 for t in texts])
    words = np.diff(np.searchsorted(at[first], ends + 1), prepend=0)
    return h, first, words


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for b in batches:
        texts, langs = b.column(1).cast(pa.binary()).to_pylist(), b.column(0).to_pylist()
        for at in range(0, len(texts), 256):
            for lang in set(langs[at : at + 256]):
                mine = [t for t, x in zip(texts[at : at + 256], langs[at : at + 256]) if x == lang and t]
                if mine:
                    counts[lang] = counts.get(lang, 0) + np.bincount(grams(mine)[0], minlength=1 << BITS)
    for lang, n in counts.items():
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(n[seen], pa.int64())], ["lang", "gram", "n"])


class Model:
    def __init__(self, counts: dict[str, np.ndarray]):
        self.langs = sorted(counts)
        n = np.stack([counts[x] for x in self.langs]).astype(float) if counts else np.zeros((0, 1 << BITS))
        self.table = np.log((n + 0.5) / (n.sum(axis=1, keepdims=True) + 0.5 * (1 << BITS))).astype(np.float32)

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the leading language of each text, and its proportion in the chosen set."""
        shares = self.mixtures(texts)
        return (shares.argmax(axis=1), shares.max(axis=1)) if self.langs else (np.zeros(len(texts), int), np.zeros(len(texts)))

    def mixtures(self, texts: list[bytes]) -> np.ndarray:
        """Of each text the proportions of all languages, 0 outside the chosen set."""
        k, (h, first, words) = len(self.langs), grams(texts)
        out, live = np.full((len(texts), k), 1 / max(1, k)), np.flatnonzero(words)
        if not k or not len(live):
            return out
        ll = np.stack([np.add.reduceat(row[h], first) for row in self.table])
        ll = np.maximum(ll - ll.max(axis=0), -CLIP)
        p, n = np.exp(ll, dtype=np.float32), words[live]
        starts = np.concatenate([[0], np.cumsum(n)[:-1]])
        pi = np.full((k, len(live)), 1 / k, np.float32)
        for _ in range(ROUNDS):
            r = p * np.repeat(pi, n, axis=1)
            r /= r.sum(axis=0)
            pi = np.add.reduceat(r, starts, axis=1) / n
        place = np.argsort(np.argsort(-pi, axis=0, kind="stable"), axis=0)
        best, chosen = np.full(len(live), -np.inf), pi
        for m in range(1, k + 1):
            # a likelihood is 1 at most here, so the penalty alone may rule out this size and all larger ones
            if (best >= -m * PENALTY * np.log(n + 1) / 2).all():
                break
            kept = np.where(place < m, pi, 0)
            kept = kept / kept.sum(axis=0)
            fits = np.add.reduceat(np.log(np.maximum((p * np.repeat(kept, n, axis=1)).sum(axis=0), 1e-12)), starts) - m * PENALTY * np.log(n + 1) / 2
            better = fits > best
            best, chosen = np.where(better, fits, best), np.where(better, kept, chosen)
        out[live] = np.clip(chosen.T, 0, 1)
        return out


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """``labelled(text, lang)`` -> model. Rows without a language are left out."""
    rows = labelled.select("lang", "text").where("lang is not null and text is not null")
    n = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    share = F.lit(1.0)
    for lang, many in n.items():
        if many > per_language:
            share = F.when(F.col("lang") == lang, per_language / many).otherwise(share)
    drawn = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share * (1 << 20))
    counts: dict[str, np.ndarray] = {x: np.zeros(1 << BITS, np.int64) for x in n}
    got = drawn.mapInArrow(_count_batches, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs, gram, many = (got.column(c).to_numpy() for c in ("lang", "gram", "n"))
    for lang in n:
        counts[lang][gram[langs == lang]] = many[langs == lang]
    return Model(counts)


MIXTURE = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))


def _predicting(model: Model):
    def blocks(texts: list[bytes], size: int = 1 << 20) -> Iterator[list[bytes]]:
        block, n = [], 0
        for t in texts:
            if block and n + len(t) > size:
                yield block
                block, n = [], 0
            block.append(t)
            n += len(t)
        if block:
            yield block

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [x if (x := t.as_py()) is not None and has_letter(x) else None for t in b.column("text")]
            raw = [(t or "").encode() for t in texts]
            shares = np.concatenate([model.mixtures(block) for block in blocks(raw)]) if raw else np.zeros((0, len(model.langs)))
            lang, score, mixture = [], [], []
            for t, row in zip(texts, shares):
                known = t is not None and bool(model.langs)
                lead = int(row.argmax()) if known else -1
                lang.append(model.langs[lead] if known else "und")
                score.append(float(row[lead]) if known else 0.0)
                mixture.append([{"lang": model.langs[i], "share": float(row[i])} for i in np.flatnonzero(row).tolist()] if known else [])
            new = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(mixture, MIXTURE)]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], [*b.schema.names, "lang_pred", "score", "mixture"])

    return predict


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """``docs(text, ...)`` -> the same rows with ``lang_pred``, ``score`` and ``mixture``.

    ``mixture`` lists the chosen languages with their proportions; ``score`` is
    that of the leading one, of equal ones the first by name. ``und`` with score 0 for null
    and empty texts, texts without a letter, and where no language was learned. Texts of any
    length are read whole; no word weighs more than ``CLIP`` in favour of one language over
    another. Repeated rows each have a result. Other columns pass through; those
    with one of these names are replaced. No rows give no rows.
    """
    docs = docs.drop("lang_pred", "score", "mixture")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("mixture", T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())])))])
    return docs.mapInArrow(_predicting(model), schema)
