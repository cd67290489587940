"""Secret scans with an incremental blob ledger, in built-in functions only.

Every version of a file is addressed by the SHA-256 of its content. A ledger
holds which (blob, rule version) pairs have been scanned and what was found.
A run scans only pairs that the ledger does not have, appends them, and joins
the findings back to every path whose content is that blob.

Positions come from one regular expression per rule: ``(.*?)(?:(rule)|\\z)``
walks the text from match to match, so the lengths of both groups sum up to
the leftmost non-overlapping matches, in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut


@dataclass(frozen=True)
class Rule:
    """``likely`` is SQL over ``text`` and ``low`` (its lower case) that every match implies."""

    kind: str
    version: int
    pattern: str
    likely: str
    keep: str = "true"

    @property
    def key(self) -> str:
        return f"{self.kind}/{self.version}"


ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_KEPT = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}$"""
#: In the order in which kinds are listed. The value of an assignment that is
#: too short still uses up its text, so its length is judged after matching.
RULES = (
    Rule("assign", 1, ASSIGN, "contains(low, 'passw') or contains(low, 'secret') or contains(low, 'token') or contains(low, 'apikey') or contains(low, 'api_key')", "long_value"),
    Rule("access", 1, "AKIA[A-Z0-9]+", "contains(text, 'AKIA')", "length(hit) >= 20"),
    Rule("hex", 1, "[0-9a-f]+", "text rlike '[0-9a-f]{24}'", "length(hit) >= 24"),
)
SPANS = "array<struct<start:int,stop:int>>"
#: Matches whose lengths are summed up at a time. A list that grows is copied at each step, so steps are taken within parts of this size.
PART = 256


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def matches(rule: Rule) -> Column:
    """Spans of a rule in ``text``, as an array of (start, stop).

    The text is matched once for the gaps and once for the hits, outside of
    all lambdas; their lengths are summed up part by part, and then the parts.
    """
    # a run of hex digits or an access key that is too short can't overlap a long one, so it need not be matched
    walk = {"hex": "[0-9a-f]{24,}", "access": "AKIA[A-Z0-9]{16,}"}.get(rule.kind, rule.pattern)
    regex = _quoted(rf"(?s)(.*?)(?:({walk})|\z)")
    keep = f"x.`1` rlike {_quoted(ASSIGN_KEPT)}" if rule.keep == "long_value" else rule.keep.replace("hit", "x.`1`")
    both = f"arrays_zip(regexp_extract_all(text, {regex}, 1), regexp_extract_all(text, {regex}, 2))"
    span = "named_struct('start', a.at + length(x.`0`), 'stop', a.at + length(x.`0`) + length(x.`1`))"
    step = f"named_struct('at', a.at + length(x.`0`) + length(x.`1`), 'out', if(length(x.`1`) > 0 and ({keep}), array_append(a.out, {span}), a.out))"
    part = f"aggregate(slice(z, k * {PART} + 1, {PART}), named_struct('at', 0, 'out', cast(array() as {SPANS})), (a, x) -> {step})"
    parts = f"transform(sequence(0, (size(z) - 1) div {PART}), k -> {part})"
    moved = "transform(p.out, s -> named_struct('start', s.start + a.at, 'stop', s.stop + a.at))"
    joined = f"aggregate({parts}, named_struct('at', 0, 'out', cast(array() as array<{SPANS}>)), (a, p) -> named_struct('at', a.at + p.at, 'out', if(size(p.out) > 0, array_append(a.out, {moved}), a.out)), a -> flatten(a.out))"
    # the array of one holds what was matched, so that it is looked up and not matched anew for each part
    return F.expr(f"case when {rule.likely} then get(transform(array({both}), z -> {joined}), 0) else cast(array() as {SPANS}) end")


def scan_unseen(blobs: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blobs(blob, text)`` -> ledger rows (blob, rule, spans) of the pairs not yet in ``ledger``."""
    todo = blobs
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        todo = blobs.join(seen, "blob", "left")
        todo = todo.where(" or ".join(f"not coalesce(array_contains(seen, '{r.key}'), false)" for r in rules))
    else:
        todo = blobs.withColumn("seen", F.expr("cast(null as array<string>)"))
    todo = todo.withColumn("low", F.lower("text"))
    new = F.array(*(F.struct(F.lit(r.key).alias("rule"), F.when(F.expr(f"not coalesce(array_contains(seen, '{r.key}'), false)"), matches(r)).alias("spans")) for r in rules))
    return todo.select("blob", F.inline(new)).where("spans is not null")


def scan_history(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """``versions(path, text)`` -> (findings, ledger).

    findings has a row for each version: path, blob and one array of spans a
    kind, empty if none; ledger holds the old pairs and the new ones, to be
    kept for the next run. Null texts count as empty; repeated versions share
    one scan; without versions both hold no new rows.
    """
    text = F.coalesce("text", F.lit(""))
    paths = versions.select("path", F.sha2(text, 256).alias("blob"))
    blobs = versions.select(F.sha2(text, 256).alias("blob"), text.alias("text")).groupBy("blob").agg(F.any_value("text").alias("text"))
    new = cut(scan_unseen(blobs, ledger, rules))
    whole = new if ledger is None else ledger.select("blob", "rule", "spans").unionByName(new)
    found = whole.where("size(spans) > 0").groupBy("blob").agg(*(F.first(F.when(F.col("rule") == r.key, F.col("spans")), ignorenulls=True).alias(r.kind) for r in rules))
    out = paths.join(found, "blob", "left")
    return out.select("path", "blob", *(F.coalesce(F.col(r.kind), F.expr(f"cast(array() as {SPANS})")).alias(r.kind) for r in rules)), whole


def listed(rules: tuple[Rule, ...] = RULES) -> Column:
    """All spans of a finding as ``kind:start:end``, by start, then kind as listed."""
    def of(k: int, r: Rule) -> Column:
        return F.transform(F.col(r.kind), lambda s: F.struct(s["start"].alias("a"), F.lit(k).alias("k"), s["stop"].alias("z"), F.lit(r.kind).alias("n")))

    each = F.concat(*(of(k, r) for k, r in enumerate(rules)))
    return F.array_join(F.transform(F.array_sort(each), lambda s: F.concat_ws(":", s["n"], s["a"].cast("string"), s["z"].cast("string"))), ",")
