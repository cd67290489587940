"""The registered queries of this subpackage, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, decontaminate, html, infill, langid, lines, neighbours, packing, secrets, simhash, substrings, topk, toxicity
from .common import held_out, table


def op1_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.without_repeats(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["stop"] - h["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = toxicity.fit_all(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, net).select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secrets.scan_history(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text"))
    counts = [F.size(r.kind).cast("long").alias(f"n_{r.kind}") for r in secrets.RULES]
    return found.withColumn("spans", secrets.listed()).select(F.col("path").alias("doc_id"), *counts, F.sha2("spans", 256).alias("base_sha256"), "spans")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.search(rows, rows.where("vec_id % 20 = 0"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~held_out(4, 2)))
    return langid.identified(docs.select("doc_id", "text"), model).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_lines_removed", "n_chunks_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_ = alignment.aligned(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    found = alignment.counted(table_.withColumn("groups_sha256", digest).drop("groups"))
    return found.select("doc_id", *alignment.COUNTS, "n_best", "count_sum", "groups_sha256")


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infill.transformed(table(spark, sf_dir, "documents"))
    chars = [F.char_length(c).cast("long").alias(f"{c}_chars") for c in ("prefix", "middle")]
    return found.select("doc_id", "n", "form", *chars, F.sha2("output", 256).alias("output_sha256"), F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(topk.whole("embedding")).select("vec_id", topk.scaled("embedding").alias("v"))
    return topk.search(rows, rows.where("vec_id % 100 = 0"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    mine = (op1_substrings, op2_html, op3_decontaminate, op4_toxicity, op5_simhash, op6_packing, op7_secrets, op8_neighbours, op9_langid, op10_lines, op11_alignment, op12_infill, op13_topk)
    return {f.__name__: f for f in mine}


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes as pairs of hex digits, all windows of 200, those whose digest occurs twice, and the bytes that they cover.
OP1_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, k, md5(substr(h, 2 * k + 1, 400)) AS m FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 199, 0))) AS k FROM d)),
r AS (SELECT doc_id, k FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
b AS (SELECT doc_id, unnest(range(0, length(h) // 2)) AS p FROM d),
c AS (SELECT b.doc_id, b.p, r.k IS NOT NULL AND b.p - r.k < 200 AS gone FROM b ASOF LEFT JOIN r ON b.doc_id = r.doc_id AND b.p >= r.k),
e AS (SELECT doc_id, p, gone, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS starts FROM c),
g AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE starts) AS n_spans FROM e GROUP BY doc_id),
t AS (SELECT c.doc_id, string_agg(substr(d.h, 2 * c.p + 1, 2), '' ORDER BY c.p) AS kept FROM c JOIN d USING (doc_id) WHERE NOT gone GROUP BY c.doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id) LEFT JOIN t USING (doc_id)
"""

WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: Windows of items and of documents as strings of words, joined where they are equal.
OP3_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents), i AS (SELECT item_id, {WORDS} AS w FROM benchmark),
iw AS (SELECT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, k + 1, k + least(10, len(w))), ' ') AS s FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 9, 1))) AS k FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, n, array_to_string(list_slice(w, k + 1, k + n), ' ') AS s FROM (SELECT doc_id, w, n, unnest(range(0, greatest(len(w) - n + 1, 0))) AS k FROM d, (SELECT DISTINCT n FROM iw))),
hit AS (SELECT doc_id, k, dw.n AS n, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.s = iw.s),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hit) GROUP BY doc_id),
q AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN q USING (doc_id)
"""


def _op7_sql() -> str:
    """Each rule's matches walked one by one, placed by the lengths of all before."""
    parts = []
    for k, r in enumerate(secrets.RULES):
        regex = r.pattern.replace("'", "''")
        keep = {"assign": f"regexp_matches(h, '{secrets.ASSIGN_KEPT.replace(chr(39), chr(39) * 2)}')", "access": "length(h) >= 20", "hex": "length(h) >= 24"}[r.kind]
        walk = rf"(?s)(.*?)(?:({regex})|\z)"
        parts.append(
            f"""SELECT doc_id, {k} AS k, '{r.kind}' AS kind, a, z FROM (
 SELECT doc_id, h, sum(length(g)) OVER o + coalesce(sum(length(h)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a, a + length(h) AS z
 FROM (SELECT doc_id, unnest(range(1, len(gs) + 1)) AS i, unnest(gs) AS g, unnest(hs) AS h FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{walk}', 1) AS gs, regexp_extract_all(coalesce(text, ''), '{walk}', 2) AS hs FROM documents))
 WINDOW o AS (PARTITION BY doc_id ORDER BY i)) WHERE h <> '' AND {keep}"""
        )
    each = " UNION ALL ".join(parts)
    return f"""WITH s AS ({each}), g AS (SELECT doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
 string_agg(kind || ':' || a::BIGINT || ':' || z::BIGINT, ',' ORDER BY a, k) AS spans FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents LEFT JOIN g USING (doc_id)"""


#: A repeated run of lines is a union of runs that occurred before: two lines, or a line and blank ones behind or before it. Runs of removed lines are counted where they begin.
OP10_SQL = r"""
WITH l AS (SELECT doc_id, i, ls[i] AS line, regexp_matches(ls[i], '[^\x09-\x0D\x20]') AS said FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text <> ''))),
u AS (SELECT *, sum(said::INT) OVER (PARTITION BY doc_id ORDER BY i) AS u, sum(said::INT) OVER (PARTITION BY doc_id ORDER BY i DESC) AS w, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS b, lead(said) OVER (PARTITION BY doc_id ORDER BY i) AS b_said FROM l),
p AS (SELECT doc_id, i, i + 1 AS z, 'p' || line || chr(10) || b AS run FROM u WHERE said AND b_said
 UNION ALL SELECT doc_id, a, i, 'f' || run FROM (SELECT doc_id, i, u, said, min(i) OVER (PARTITION BY doc_id, u) AS a, string_agg(line, chr(10)) OVER (PARTITION BY doc_id, u ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM u) WHERE u > 0 AND NOT said
 UNION ALL SELECT doc_id, i, z, 'b' || run FROM (SELECT doc_id, i, w, said, max(i) OVER (PARTITION BY doc_id, w) AS z, string_agg(line, chr(10)) OVER (PARTITION BY doc_id, w ORDER BY i DESC ROWS UNBOUNDED PRECEDING) AS run FROM u) WHERE w > 0 AND NOT said),
r AS (SELECT doc_id, i, z, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS k FROM p),
g AS (SELECT DISTINCT doc_id, unnest(range(i, z + 1)) AS i FROM r WHERE k > 1),
m AS (SELECT l.doc_id, l.i, line, g.i IS NOT NULL AS gone FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.i = l.i),
n AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS starts FROM m),
t AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_lines_removed, count(*) FILTER (WHERE starts) AS n_chunks_removed, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM n GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_lines_removed, 0) AS n_lines_removed, coalesce(n_chunks_removed, 0) AS n_chunks_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents LEFT JOIN t USING (doc_id)
"""


#: What the model must find where the article is an element of headings and paragraphs, as in all pages of the given tables: its blocks, without markup.
OP2_SQL = r"""
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM (SELECT page_id, url, array_to_string(list_filter(list_transform(
 regexp_split_to_array(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '</?(?:p|h1|br)>'),
 lambda b: trim(regexp_replace(replace(replace(replace(replace(regexp_replace(b, '</?b>', '', 'g'), '&quot;', '"'), '&quot', '"'), '&amp;', '&'), '&amp', '&'), '\s+', ' ', 'g'))), lambda b: b <> ''), chr(10)) AS text FROM pages)
"""


#: Units as a list, and its parts put together again; what an output is rebuilt to is the text itself.
OP12_SQL = r"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
n AS (SELECT doc_id, t, u, len(u) AS n, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2, ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4 FROM h),
f AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS q FROM n),
c AS (SELECT doc_id, t, n, form, array_to_string(u[1:p], '') AS a, array_to_string(u[p + 1:q], '') AS b, array_to_string(u[q + 1:n], '') AS z FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(b) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || b ELSE '<S>' || z || '<P>' || a || '<M>' || b END) AS output_sha256, sha256(t) AS restored_sha256 FROM c
"""


OP13_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score FROM e q JOIN e c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    """Fingerprints by XXH64, tokens and trained models have no SQL; tests compare those with plain Python."""
    return {"op1_substrings": OP1_SQL, "op2_html": OP2_SQL, "op3_decontaminate": OP3_SQL, "op7_secrets": _op7_sql(), "op10_lines": OP10_SQL, "op12_infill": OP12_SQL, "op13_topk": OP13_SQL}
