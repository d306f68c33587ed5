"""Document fingerprints by a homomorphic multiset hash, with built-in functions only.

A text is a multiset of paragraphs: its lines, those of more than ``most_words`` words cut into runs of that many.
Each paragraph is hashed to a wide vector, and the vectors are summed, modulo 2^32 in the identity lanes and in
counters of 32 bits in the sign lanes, two to a long. The sum doesn't depend on the order; adding or removing a paragraph adds or
subtracts its vector, so fingerprints of unions and edits follow from fingerprints alone (``combine``). Identity lanes
tell equal multisets from others. Each sign lane counts the paragraphs whose bit there is set; with the number of
paragraphs this is a sum of +1 and -1, and the mean square of the differences of two such sums estimates the squared
distance of the two multisets: likeness is 1 - |A - B|^2 / (|A|^2 + |B|^2), from 0 (nothing shared) to 1 (equal).

Defined cases: a null text is the empty text, with one empty paragraph; the next document is the one with the next
lower id (ties: by text hash, then any), nulls last, and after the last one comes the first, so a lone document is
its own next one; repeated rows are rows of their own; an empty table gives an empty table; other columns are not
read. No sum can overflow: a text has less than 2^31 bytes, so less than 2^31 paragraphs, and every counter and every sum
of 32-bit identity lanes has room for that many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rootline.llm.common import stored, text_or_empty

_LANES = 32  # longs for a hash; each holds two counters of 32 bits
_HASHES = 2
_IDENTITY = 8
_MASK = 1 | 1 << 32
WIDE = [*(f"s{h}_{i}" for h in range(_HASHES) for i in range(_LANES)), *(f"m{i}" for i in range(_IDENTITY))]


def paragraphs(text: Column, most_words: int = 16) -> Column:
    """The paragraphs of a text, as an array; each line ends with its line feed, the last one with one of its own."""
    space = r"[^\S\n]*+"
    return F.regexp_extract_all(F.concat(text, F.lit("\n")), F.lit(rf"(?:{space}\S++){{1,{most_words}}}+{space}\n?+|{space}\n"), F.lit(0))


def multiset_hash(rows: DataFrame, keys: list[str], paragraph: str = "paragraph") -> DataFrame:
    """Rows of (keys, paragraph) -> n and the lanes of WIDE, for each value of the keys."""
    hashed = rows.select(*keys, *[F.xxhash64(F.lit(h), F.col(paragraph)).alias(f"h{h}") for h in range(_HASHES)], *[F.xxhash64(F.lit(100 + i), F.col(paragraph)).alias(f"g{i}") for i in range(_IDENTITY // 2)])
    signs = [F.sum(F.shiftrightunsigned(f"h{h}", i).bitwiseAND(F.lit(_MASK))).alias(f"s{h}_{i}") for h in range(_HASHES) for i in range(_LANES)]
    low = F.lit(2**32 - 1)
    sums = [F.sum((F.col(f"g{i // 2}") if i % 2 == 0 else F.shiftrightunsigned(f"g{i // 2}", 32)).bitwiseAND(low)).alias(f"m{i}") for i in range(_IDENTITY)]
    return hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *signs, *sums)


def packed(wide: DataFrame, keys: list[str], name: str) -> DataFrame:
    """keys and the lanes as one struct: n, signs (an array of longs) and id (the identity lanes modulo 2^32)."""
    signs = F.array(*[c for c in WIDE if c[0] == "s"])
    return wide.select(*keys, F.struct(F.col("n"), signs.alias("signs"), F.array(*[F.col(c).bitwiseAND(F.lit(2**32 - 1)) for c in WIDE if c[0] == "m"]).alias("id")).alias(name))


def _plus(a: Column, b: Column, sign: int) -> Column:
    return F.struct(
        (a["n"] + sign * b["n"]).alias("n"), F.zip_with(a["signs"], b["signs"], lambda x, y: x + sign * y).alias("signs"),
        F.zip_with(a["id"], b["id"], lambda x, y: F.pmod(x + sign * y, F.lit(2**32))).alias("id"),
    )


def insert(a: Column, b: Column) -> Column:
    """The fingerprint of the union of two multisets."""
    return _plus(a, b, 1)


def delete(a: Column, b: Column) -> Column:
    """The fingerprint of a without b, which a contains."""
    return _plus(a, b, -1)


def text_of(fp: Column) -> Column:
    """A fingerprint as text: the identity lanes, the number of paragraphs and the counters, in hexadecimal."""
    wide = F.concat(F.transform(fp["id"], lambda x: F.lpad(F.hex(x), 8, "0")), F.array(F.lpad(F.hex(fp["n"]), 8, "0")), F.transform(fp["signs"], lambda x: F.lpad(F.hex(x), 16, "0")))
    return F.lower(F.array_join(wide, ""))


def _lane(x: Column, n: Column, shift: int) -> Column:
    """The sum of +1 and -1 in a lane: twice the set bits less the number of paragraphs."""
    return (2 * F.shiftrightunsigned(x, shift).bitwiseAND(F.lit(2**32 - 1)) - n).cast("double")


def _square(fp: Column) -> Column:
    """The squared length of a multiset, times the number of lanes."""
    return F.aggregate(fp["signs"], F.lit(0.0), lambda a, x: a + sum((_lane(x, fp["n"], s) * _lane(x, fp["n"], s) for s in (0, 32)), F.lit(0.0)))


def _distance(a: Column, b: Column) -> Column:
    """The squared length of the difference of two multisets, times the number of lanes."""
    gap = lambda x, y, s: (_lane(x, a["n"], s) - _lane(y, b["n"], s)) * (_lane(x, a["n"], s) - _lane(y, b["n"], s))
    return F.aggregate(F.zip_with(a["signs"], b["signs"], lambda x, y: gap(x, y, 0) + gap(x, y, 32)), F.lit(0.0), lambda t, x: t + x)


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1; 1 for equal fingerprints."""
    whole = _square(a) + _square(b)
    near = F.when(whole == 0, 0.0).otherwise(1 - _distance(a, b) / F.when(whole != 0, whole).otherwise(1.0))
    return F.when(a["id"] == b["id"], F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), near)))


_NONE = -(2**63)
_ORDER = ["back", "tie", "k"]


def neighbours(ids: DataFrame) -> DataFrame:
    """ids (back, tie, k, n_chars) -> the same with the place of the row before (p_) and the next row (q_) in the order of
    (back, tie, k), as a ring, and p_chars. Ordered in range partitions; only each partition's ends meet in one task, as
    many rows as there are partitions."""
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(ids.repartitionByRange(parts, *_ORDER).withColumn("pid", F.spark_partition_id()), "fingerprint-order").df
    own = F.struct(*_ORDER, "n_chars")
    w = Window.partitionBy("pid").orderBy(*_ORDER)
    inside = dealt.select(*_ORDER, "pid", F.lag(own).over(w).alias("p"), F.lead(own).over(w).alias("q"))
    ends = dealt.groupBy("pid").agg(F.min(own).alias("first"), F.max(own).alias("last"))
    up, down = Window.orderBy("pid"), Window.orderBy(F.col("pid").desc())
    ends = ends.select("pid", F.coalesce(F.lead("last").over(down), F.first("last").over(down)).alias("p_end"), F.coalesce(F.lead("first").over(up), F.first("first").over(up)).alias("q_end"))
    both = inside.join(F.broadcast(ends), "pid").withColumns({"p": F.coalesce("p", "p_end"), "q": F.coalesce("q", "q_end")})
    return both.select(*_ORDER, *[F.col(f"p.{c}").alias(f"p_{c}") for c in _ORDER], F.col("p.n_chars").alias("p_chars"), *[F.col(f"q.{c}").alias(f"q_{c}") for c in _ORDER])


def fingerprint_documents(docs: DataFrame, most_words: int = 16) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each document."""
    text = text_or_empty()
    # descending ids are ascending bitwise complements; a null id comes after all others
    base = docs.select(F.bitwise_not(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NONE))).alias("back"), F.xxhash64(text).alias("tie"), text.alias("text"))
    ids = base.groupBy("back", "tie").agg(F.min(F.length("text").cast("long")).alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    near = neighbours(ids.select("back", "tie", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("k"), "n_chars"))
    near = stored(near, "fingerprint-neighbours").df
    repeated = not near.where("k > 1").isEmpty()
    if repeated:
        base = base.dropDuplicates(["back", "tie"])
    on = [*_ORDER] if repeated else ["back", "tie"]

    # both uses of the texts read one exchange of the same three columns
    own = base.join(near, ["back", "tie"])
    heads = own.select(F.col("p_back").alias("back"), F.col("p_tie").alias("tie"), F.col("p_k").alias("k"), F.substring("text", F.lit(1), F.floor(F.col("p_chars") / 3).cast("int")).alias("head"))
    heads = heads if repeated else heads.drop("k")
    n = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), (n - F.floor(n / 3)).cast("int")), "head")
    rows = own.join(heads, on).select(*_ORDER, "q_back", "q_tie", "q_k", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    keys = [*_ORDER, "q_back", "q_tie", "q_k", "n_chars", "edited_sha256"]
    rows = rows.select(*keys[:-1], F.sha2("edited", 256).alias("edited_sha256"), F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("t")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("t")))).alias("x"))
    rows = rows.select(*keys, F.col("x.kind").alias("kind"), F.explode(paragraphs(F.col("x.t"), most_words)).alias("paragraph"))
    wide = packed(multiset_hash(rows, [*keys, "kind"]), [*keys, "kind"], "fp")
    pairs = wide.groupBy(*keys).agg(F.first(F.when(F.col("kind") == 0, F.col("fp")), True).alias("fp"), F.first(F.when(F.col("kind") == 1, F.col("fp")), True).alias("edited"))
    pairs = stored(pairs, "fingerprints").df

    nexts = pairs.select(*[F.col(c).alias(f"q_{c}") for c in _ORDER], F.col("fp").alias("next"))
    out = pairs.join(nexts, ["q_back", "q_tie", "q_k"])
    doc_id = F.nullif(F.bitwise_not("back"), F.lit(_NONE))
    return out.select(
        doc_id.alias("doc_id"), "n_chars", "edited_sha256", text_of(F.col("fp")).alias("fingerprint"), text_of(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited")).alias("near_edited"), likeness(F.col("fp"), F.col("next")).alias("near_next"),
    )
