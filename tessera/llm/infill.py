"""Fill-in-the-middle by injected markers, in built-in functions only.

A mark that occurs in no text is appended to every unit of a text: the mark and the
escape are escaped first, so that what remains of them is ours, and one regular
expression appends the mark after each unit, escape pairs being units of
their own. The number of marks is the number of units; what stands before
the k-th mark is the first k units. Parts are unescaped and put together.
Nothing moves: a text's split follows from its id alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK, ESCAPE = "\u0001", "\u0002"
ESCAPED_ESCAPE, ESCAPED_MARK = ESCAPE + "e", ESCAPE + "m"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A run of letters or one other code point.
UNIT = "[A-Za-z]+|[^A-Za-z]"
#: Of a hundred texts, how many from which on stay plain, and how many of the others have their suffix first.
PLAIN_FROM, SUFFIX_FIRST = 90, 20


def marked(text: Column) -> Column:
    """The text, escaped, with the mark after each of its units."""
    escaped = F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPED_ESCAPE)), F.lit(MARK), F.lit(ESCAPED_MARK))
    return F.regexp_replace(escaped, f"{ESCAPE}[em]|{UNIT}", f"$0{MARK}")


def unmarked(part: Column) -> Column:
    """A part of a marked text as it was."""
    escaped = F.replace(part, F.lit(MARK), F.lit(""))
    return F.replace(F.replace(escaped, F.lit(ESCAPED_MARK), F.lit(MARK)), F.lit(ESCAPED_ESCAPE), F.lit(ESCAPE))


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 from the SHA-256 of ``seed:id``; a null id is an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def restored(output: Column, form: Column) -> Column:
    """The text that an output of some form was made from: parts end where the next marker first stands."""
    def rest(s: Column, part: Column) -> Column:
        return F.substr(s, F.char_length(part) + 4)

    body = F.substr(output, F.lit(4))
    first = F.when(form == "psm", F.substring_index(body, SUFFIX, 1)).otherwise(F.substring_index(body, PREFIX, 1))
    second = F.substring_index(rest(body, first), MIDDLE, 1)
    last = rest(rest(body, first), second)
    return F.when(form == "plain", output).when(form == "psm", F.concat(first, last, second)).otherwise(F.concat(second, last, first))


def transformed(docs: DataFrame, seed: int = 1) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, n, form, prefix, middle, suffix, output)``.

    ``n`` is how many units a text has; ``form`` is plain, psm (prefix, suffix,
    middle) or spm (suffix, prefix, middle). Plain are empty and null texts, those that
    spell a marker, and a share of the others; their ``output`` is the text, their parts are null.
    Either part of a split may be empty. Texts of any length are split whole and
    may hold any code point, the mark and the escape among them. Equal rows are
    split alike; null ids are split by the empty id; other columns are ignored; no rows give no rows.
    """
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    spelled = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | spelled | (h3 % 100 >= PLAIN_FROM)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    form = F.when(plain, "plain").when(h4 % 100 < SUFFIX_FIRST, "spm").otherwise("psm")
    rows = rows.select("doc_id", "text", form.alias("form"), marked(F.col("text")).alias("m"))
    rows = rows.withColumn("n", (F.char_length("m") - F.char_length(F.replace("m", F.lit(MARK), F.lit("")))).cast("long"))
    a, b = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    rows = rows.withColumns({"p": F.least(a, b).cast("int"), "q": F.greatest(a, b).cast("int")})
    # from the right, the n-q+1-th mark is the one after unit q; the head's last mark is not in it
    rows = rows.withColumn("head", F.expr(f"substring_index(m, '{MARK}', q)"))
    split = F.col("form") != "plain"
    parts = {
        "prefix": F.expr(f"substring_index(head, '{MARK}', p)"),
        "middle": F.expr(f"substring_index(head, '{MARK}', p - q)"),
        "suffix": F.expr(f"substring_index(m, '{MARK}', cast(q - n - 1 as int))"),
    }
    rows = rows.select("doc_id", "n", "form", "text", *(F.when(split, unmarked(x)).alias(name) for name, x in parts.items()))
    psm, spm = (F.concat(*(x for m, c in order for x in (F.lit(m), F.col(c)))) for order in (((PREFIX, "prefix"), (SUFFIX, "suffix"), (MIDDLE, "middle")), ((SUFFIX, "suffix"), (PREFIX, "prefix"), (MIDDLE, "middle"))))
    output = F.when(F.col("form") == "plain", F.col("text")).when(F.col("form") == "psm", psm).otherwise(spm)
    return rows.select("doc_id", "n", "form", "prefix", "middle", "suffix", output.alias("output"))
