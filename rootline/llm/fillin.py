"""Fill-in-the-middle transformation by escaped marker injection, in column expressions alone.

A delimiter is escaped in the text, so that it stands nowhere in it; a regular expression then appends it after each unit (a
code point, or an escape with its letter). The number of delimiters is the number of units; ``substring_index`` takes the parts
before and after the ranked delimiters; taking the delimiters out and undoing the escapes gives the parts as they were. The
order of the parts and the markers before them make the output, and the markers, which the text doesn't have, give it back.

Defined cases: a null text is the empty text, which stays plain; so does a text with a marker in it; a null id draws its
numbers from the empty string; repeated rows give the same row; other columns don't matter; an empty table gives an empty table.
Texts are worked on whole; a marked text takes two bytes for an ASCII letter, so a text may have up to 2^30 bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootline.llm.common import text_or_empty

DELIMITER, ESCAPE = "\x01", "\x02"
#: What stands for an escape and for a delimiter of the text, after the escape.
OWN_ESCAPE, OWN_DELIMITER = "e", "d"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def marked(text: Column) -> Column:
    """The text with the delimiter after each of its code points."""
    escaped = F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + OWN_ESCAPE)), F.lit(DELIMITER), F.lit(ESCAPE + OWN_DELIMITER))
    return F.regexp_replace(escaped, f"(?s){ESCAPE}.|.", f"$0{DELIMITER}")


def units(marks: Column) -> Column:
    """How many units a marked text has."""
    return (F.octet_length(marks) - F.octet_length(F.replace(marks, F.lit(DELIMITER), F.lit("")))).cast("long")


def plain(marks: Column) -> Column:
    """The text of a marked part."""
    escaped = F.replace(marks, F.lit(DELIMITER), F.lit(""))
    return F.replace(F.replace(escaped, F.lit(ESCAPE + OWN_DELIMITER), F.lit(DELIMITER)), F.lit(ESCAPE + OWN_ESCAPE), F.lit(ESCAPE))


def _cut(text: Column, count: Column) -> Column:
    return F.call_function("substring_index", text, F.lit(DELIMITER), count.cast("int"))


def draws(key: Column, seed: str = "1") -> list[Column]:
    """Four numbers below 2^32 from the SHA-256 of the seed and the key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = "1", percent: int = 90, percent_spm: int = 20) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for each document.

    The two cuts fall anywhere in the text, its ends included. ``percent`` of the texts are rearranged, and ``percent_spm`` of
    those have the suffix first (spm), the others the prefix (psm); the rest stay plain.
    """
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    own = docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text"))
    own = own.select("doc_id", "text", marked(F.col("text")).alias("marks")).select("doc_id", "text", "marks", units(F.col("marks")).alias("n"))
    stays = (F.col("n") == 0) | F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE) | (h3 % 100 >= percent)
    form = F.when(stays, "plain").when(h4 % 100 < percent_spm, "spm").otherwise("psm")
    own = own.select("*", form.alias("form"), (h1 % (F.col("n") + 1)).alias("c1"), (h2 % (F.col("n") + 1)).alias("c2"))
    p, q, n, marks = F.least("c1", "c2"), F.greatest("c1", "c2"), F.col("n"), F.col("marks")
    prefix, middle, suffix = plain(_cut(marks, p)), plain(_cut(_cut(marks, q), p - q)), plain(_cut(marks, q - n - 1))
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    moved = F.col("form") != "plain"
    output = F.when(~moved, F.col("text")).when(F.col("form") == "psm", psm).otherwise(spm)
    return own.select("doc_id", "n", "form", F.when(moved, p).alias("prefix_chars"), F.when(moved, q - p).alias("middle_chars"), output.alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    first, second = F.when(form == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX)), F.lit(MIDDLE)
    body = F.substr(output, F.lit(len(PREFIX) + 1))
    cut = lambda s, by, n: F.call_function("substring_index", s, by, F.lit(n))
    a, rest = cut(body, first, 1), cut(body, first, -1)
    b, middle = cut(rest, second, 1), cut(rest, second, -1)
    return F.when(form == "plain", output).when(form == "psm", F.concat(a, middle, b)).otherwise(F.concat(b, middle, a))


def digests(out: DataFrame) -> DataFrame:
    """The rows of fill_in_middle with the digests of the output and of the text restored from it, instead of the output."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))
