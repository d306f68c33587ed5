"""Sequence joins and alignments.

Exact search anchors each query at its rarest minimizer, so a query meets the sequences once; similarity search
aligns all distinct pairs of sequences that share k-mers and keeps the best scores. Alignments run once for each
distinct pair in Arrow batches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rootline.functions.expressions import upper_letter
from rootline.operators import minimizers, seeds
from rootline.operators.shared import shared_table

#: BLOSUM62 (Henikoff and Henikoff 1992), rows and columns in this order.
LETTERS = "ARNDCQEGHILKMFPSTWYVBZX*"
BLOSUM62 = """
 4 -1 -2 -2  0 -1 -1  0 -2 -1 -1 -1 -1 -2 -1  1  0 -3 -2  0 -2 -1  0 -4
-1  5  0 -2 -3  1  0 -2  0 -3 -2  2 -1 -3 -2 -1 -1 -3 -2 -3 -1  0 -1 -4
-2  0  6  1 -3  0  0  0  1 -3 -3  0 -2 -3 -2  1  0 -4 -2 -3  3  0 -1 -4
-2 -2  1  6 -3  0  2 -1 -1 -3 -4 -1 -3 -3 -1  0 -1 -4 -3 -3  4  1 -1 -4
 0 -3 -3 -3  9 -3 -4 -3 -3 -1 -1 -3 -1 -2 -3 -1 -1 -2 -2 -1 -3 -3 -2 -4
-1  1  0  0 -3  5  2 -2  0 -3 -2  1  0 -3 -1  0 -1 -2 -1 -2  0  3 -1 -4
-1  0  0  2 -4  2  5 -2  0 -3 -3  1 -2 -3 -1  0 -1 -3 -2 -2  1  4 -1 -4
 0 -2  0 -1 -3 -2 -2  6 -2 -4 -4 -2 -3 -3 -2  0 -2 -2 -3 -3 -1 -2 -1 -4
-2  0  1 -1 -3  0  0 -2  8 -3 -3 -1 -2 -1 -2 -1 -2 -2  2 -3  0  0 -1 -4
-1 -3 -3 -3 -1 -3 -3 -4 -3  4  2 -3  1  0 -3 -2 -1 -3 -1  3 -3 -3 -1 -4
-1 -2 -3 -4 -1 -2 -3 -4 -3  2  4 -2  2  0 -3 -2 -1 -2 -1  1 -4 -3 -1 -4
-1  2  0 -1 -3  1  1 -2 -1 -3 -2  5 -1 -3 -1  0 -1 -3 -2 -2  0  1 -1 -4
-1 -1 -2 -3 -1  0 -2 -3 -2  1  2 -1  5  0 -2 -1 -1 -1 -1  1 -3 -1 -1 -4
-2 -3 -3 -3 -2 -3 -3 -3 -1  0  0 -3  0  6 -4 -2 -2  1  3 -1 -3 -3 -1 -4
-1 -2 -2 -1 -3 -1 -1 -2 -2 -3 -3 -1 -2 -4  7 -1 -1 -4 -3 -2 -2 -1 -2 -4
 1 -1  1  0 -1  0  0  0 -1 -2 -2  0 -1 -2 -1  4  1 -3 -2 -2  0  0  0 -4
 0 -1  0 -1 -1 -1 -1 -2 -2 -1 -1 -1 -1 -2 -1  1  5 -2 -2  0 -1 -1  0 -4
-3 -3 -4 -4 -2 -2 -3 -2 -2 -3 -2 -3 -1  1 -4 -3 -2 11  2 -3 -4 -3 -2 -4
-2 -2 -2 -3 -2 -1 -2 -3  2 -1 -1 -2 -1  3 -3 -2 -2  2  7 -1 -3 -2 -1 -4
 0 -3 -3 -3 -1 -2 -2 -3 -3  3  1 -2  1 -1 -2 -2  0 -3 -1  4 -3 -2 -1 -4
-2 -1  3  4 -3  0  1 -1  0 -3 -4  0 -3 -3 -2  0 -1 -4 -3 -3  4  1 -1 -4
-1  0  0  1 -3  3  4 -2  0 -3 -3  1 -1 -3 -1  0 -1 -3 -2 -2  1  4 -1 -4
 0 -1 -1 -1 -2 -1 -1 -1 -1 -1 -1 -1 -1 -1 -2  0  0 -2 -1 -1 -1 -1 -1 -4
-4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4  1
"""
OPEN, EXTEND = seeds.OPEN, seeds.EXTEND


def peptide_join(queries: DataFrame, query: str, proteins: DataFrame, protein: str, seq: str, k: int = 5, window: int = 16, index: DataFrame | None = None, most_broadcast: int = minimizers.MOST_BROADCAST) -> DataFrame:
    """(query, protein, start, end) for every occurrence, overlapping ones too; positions from 1, inclusive. Queries of less
    than k letters are left out.

    Queries that are long enough meet the sequences at minimizers of ``window`` k-mers, for which a stored ``index`` (of the
    same k and window) spares reading the sequences; shorter ones at every k-mer.
    """
    own = queries.select(F.col(query).alias("query")).where(F.length(query) >= k).distinct()
    long = F.length("query") >= k + window - 1
    here = proteins.select(F.col(protein).alias("protein"), F.col(seq).alias("seq"))
    sides = [(window, own.where(long), index), (1, own.where(~long), None)]
    found = [minimizers.occurrences(asked, here, k, w, stored, most_broadcast) for w, asked, stored in sides if not asked.isEmpty()]
    if not found:
        kind = here.schema["protein"].dataType.simpleString()
        return queries.sparkSession.createDataFrame([], f"query string, protein {kind}, start long, end long")
    return reduce(DataFrame.unionByName, found).withColumn("end", F.col("start") + F.length("query") - 1)


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(epitope, bucket, bitmap) -> (epitope, number) for each bit that is set; a bucket has 32,768 numbers."""
    for batch in batches:
        epitopes, numbers = [], []
        for k, (bucket, bitmap) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
            own = np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little")) + (bucket - 1) * 32768 + 1
            numbers.append(own)
            epitopes.append(np.full(len(own), k))
        at = np.concatenate([np.zeros(0, np.int64), *epitopes])
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(np.concatenate([np.zeros(0, np.int64), *numbers]))], ["epitope", "number"])


def _letter(seq: Column, pos: Column, any_case: bool) -> Column:
    own = F.substring(seq, pos, F.lit(1))
    return upper_letter(own) if any_case else own


def residue_index(numbered: DataFrame, seq: str, positions: Column, any_case: bool = False) -> DataFrame:
    """(pos, aa, bucket, bitmap, n): which of the numbered sequences have a letter (its capital, with ``any_case``) at a
    position, for an array of positions; a bitmap for each bucket of 32,768 numbers, and how many there are in all."""
    at = F.explode(F.filter("_at", lambda p: (p >= 1) & (p <= F.length(seq))))
    have = numbered.select("number", seq, positions.alias("_at")).select("number", seq, at.alias("pos")).select("number", "pos", _letter(F.col(seq), F.col("pos"), any_case).alias("aa"))
    maps = have.groupBy("pos", "aa", F.bitmap_bucket_number("number").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))
    counts = maps.groupBy("pos", "aa").agg(F.sum(F.bitmap_count("bitmap")).alias("n"))
    return maps.join(counts, ["pos", "aa"])


def residue_match(epitopes: DataFrame, epitope: str, tokens: str, proteins: DataFrame, protein: str, seq: str, rarest: int = 3, any_case: bool = False) -> DataFrame:
    """(epitope, protein) pairs where every residue of the epitope (array of (aa, pos)) stands at its position. Residues are
    capitals or become such; sequences are taken as they are, or letter by letter in ``any_case``.

    Bitmaps say which proteins have a letter at a position. Those of each epitope's ``rarest`` residues are intersected, and
    what is left is looked up; a residue that no protein has ends it. No pair of epitope and protein is a row before that.
    """
    listed = epitopes.where(F.size(tokens) > 0).select(F.col(epitope).alias("epitope"), F.col(tokens).alias("tokens"))
    listed = shared_table(listed.where(F.forall("tokens", lambda t: t["pos"] >= 1)), "residues")
    numbered = shared_table(proteins.where(F.col(seq).isNotNull()).select(F.col(protein).alias("protein"), F.col(seq).alias("_s")).withColumn("number", F.monotonically_increasing_id() + 1), "numbered")  # bitmaps count from 1
    asked = listed.select("epitope", F.explode(F.transform("tokens", lambda t: F.struct(t["pos"].cast("int").alias("pos"), upper_letter(t["aa"]).alias("aa")))).alias("t")).select("epitope", "t.*").distinct()
    positions = asked.agg(F.collect_set("pos")).scalar()  # at most as many as the longest sequence has
    index = shared_table(residue_index(numbered, "_s", positions, any_case), "residue-bitmaps")
    counts = index.groupBy("pos", "aa").agg(F.first("n").alias("n"))
    order = Window.partitionBy("epitope").orderBy("n", "pos", "aa")
    rare = asked.join(counts, ["pos", "aa"], "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= rarest)
    need = rare.groupBy("epitope").agg(F.count(F.lit(1)).alias("need"))
    both = rare.select("epitope", "pos", "aa").join(index, ["pos", "aa"]).groupBy("epitope", "bucket").agg(F.bitmap_and_agg("bitmap").alias("bitmap"), F.count(F.lit(1)).alias("have"))
    left = both.join(need, "epitope").where("have = need").where(F.bitmap_count("bitmap") > 0).select("epitope", "bucket", "bitmap")
    kind = left.schema["epitope"].dataType.simpleString()
    found = left.mapInArrow(_bits, f"epitope {kind}, number long").join(listed, "epitope").join(numbered, "number")
    return found.where(F.forall("tokens", lambda t: _letter(F.col("_s"), t["pos"], any_case) == upper_letter(t["aa"]))).select("epitope", "protein")


@lru_cache(1)
def letter_scores() -> np.ndarray:
    m = np.array([[int(x) for x in row.split()] for row in BLOSUM62.strip().splitlines()], np.int32)
    table = np.full((128, 128), m[LETTERS.index("X"), LETTERS.index("X")], np.int32)
    at = np.array([ord(c) for c in LETTERS])
    table[np.ix_(at, at)] = m
    return table


def _codes(texts: list[str], width: int) -> np.ndarray:
    """Letters as numbers, a column for each text."""
    out = np.full((width, len(texts)), 127, np.uint8)
    for k, t in enumerate(texts):
        out[: len(t), k] = np.minimum(np.frombuffer(t.encode("ascii", "replace"), np.uint8), 127)
    return out


def _tables(a: list[str], b: list[str], local: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letter scores and the three tables of Gotoh's recurrence for several pairs at once, [i, j, pair], by anti-diagonals.
    What lies beyond a pair's own lengths is never looked at."""
    n, m = max(map(len, a)), max(map(len, b))
    letters = letter_scores()[_codes(a, n)[:, None, :], _codes(b, m)[None, :, :]]
    best = np.zeros((n + 1, m + 1, len(a)), np.int32)
    up, left = np.full_like(best, -(10**9)), np.full_like(best, -(10**9))
    if not local:
        best[1:, 0] = up[1:, 0] = -OPEN - EXTEND * np.arange(n, dtype=np.int32)[:, None]
        best[0, 1:] = left[0, 1:] = -OPEN - EXTEND * np.arange(m, dtype=np.int32)[:, None]
    for d in range(2, n + m + 1):
        i = np.arange(max(1, d - m), min(n, d - 1) + 1)
        j = d - i
        u = np.maximum(best[i - 1, j] - OPEN, up[i - 1, j] - EXTEND)
        le = np.maximum(best[i, j - 1] - OPEN, left[i, j - 1] - EXTEND)
        v = np.maximum(np.maximum(best[i - 1, j - 1] + letters[i - 1, j - 1], u), le)
        up[i, j], left[i, j], best[i, j] = u, le, np.maximum(v, 0) if local else v
    return letters, best, up, left


def _row(letters: np.ndarray, best: np.ndarray, up: np.ndarray, edge: int, local: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The next row of the three tables; ``edge``: the first cell, below the last row's first. A gap in a starts behind any
    earlier column, so the best start is a running maximum."""
    at = EXTEND * np.arange(len(best), dtype=np.int32)
    up = np.maximum(best - OPEN, up - EXTEND)
    now = up.copy()
    now[1:] = np.maximum(now[1:], best[:-1] + letters)
    now[0] = edge
    if local:
        np.maximum(now, 0, out=now)
    left = np.full_like(now, -(10**9))
    left[1:] = np.maximum.accumulate(now + at)[:-1] - at[:-1] - OPEN
    return np.maximum(now, left), up, left


def _first_row(m: int, local: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    best = np.zeros(m + 1, np.int32)
    up, left = np.full_like(best, -(10**9)), np.full_like(best, -(10**9))
    if not local:
        best[1:] = left[1:] = -OPEN - EXTEND * np.arange(m, dtype=np.int32)
    return best, up, left


def align_long(a: str, b: str, local: bool = False) -> tuple[str, str, int, int, int]:
    """The same alignment as by whole tables, in memory for about 5 x sqrt(len(a)) rows of them.

    A first pass keeps every sqrt(n)-th row; the path is then walked backward, and the rows between two kept ones are worked out
    again when it gets there. So ties are broken as ever, at twice the time.
    """
    n, m = len(a), len(b)
    x, y = _codes([a], n)[:, 0], _codes([b], m)[:, 0]
    table, every = letter_scores()[:, y], max(1, math.isqrt(n))
    edge = lambda i: 0 if local else -OPEN - EXTEND * (i - 1)
    best, up, left = _first_row(m, local)
    kept, top, end = [(best, up, left)], 0, (0, 0)
    for i in range(1, n + 1):
        best, up, left = _row(table[x[i - 1]], best, up, edge(i), local)
        if not local:
            up[0] = best[0]
        elif (most := int(best.max())) > top:
            top, end = most, (i, int(best.argmax()))
        if i % every == 0:
            kept.append((best, up, left))
    if not local:
        top, end = int(best[m]), (n, m)

    at, rows = -1, []

    def row(i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        nonlocal at, rows
        if not at <= i < at + len(rows):
            part = max(0, (i - 1) // every)  # so that the row before is at hand too
            at, rows = part * every, [kept[part]]
            del kept[part + 2 :]
            for k in range(at + 1, min(at + every, n) + 1):
                now = _row(table[x[k - 1]], rows[-1][0], rows[-1][1], edge(k), local)
                if not local:
                    now[1][0] = now[0][0]
                rows.append(now)
        return rows[i - at]

    (i, j), out, state = end, [], "m"
    while i > 0 or j > 0:
        best, up, left = row(i)
        over = row(i - 1)[0] if i else None
        if state == "m":
            if local and best[j] == 0:
                break
            if i and j and best[j] == over[j - 1] + table[x[i - 1], j - 1]:
                i, j = i - 1, j - 1
                out.append((a[i], b[j]))
            else:
                state = "u" if i and best[j] == up[j] else "l"
        elif state == "u":
            state = "m" if up[j] == over[j] - OPEN else "u"
            i -= 1
            out.append((a[i], "-"))
        else:
            state = "m" if left[j] == best[j - 1] - OPEN else "l"
            j -= 1
            out.append(("-", b[j]))
    out.reverse()
    return "".join(p for p, _ in out), "".join(q for _, q in out), i + 1, j + 1, top


def _path(a: str, b: str, s: np.ndarray, best: np.ndarray, up: np.ndarray, left: np.ndarray, local: bool) -> tuple[str, str, int, int, int]:
    i, j = divmod(int(best.argmax()), len(b) + 1) if local else (len(a), len(b))
    score, x, y, state = int(best[i, j]), [], [], "m"
    while i > 0 or j > 0:
        if state == "m":
            if local and best[i, j] == 0:
                break
            if i and j and best[i, j] == best[i - 1, j - 1] + s[i - 1, j - 1]:
                i, j = i - 1, j - 1
                x.append(a[i])
                y.append(b[j])
            else:
                state = "u" if i and best[i, j] == up[i, j] else "l"
        elif state == "u":
            state = "m" if up[i, j] == best[i - 1, j] - OPEN else "u"
            i -= 1
            x.append(a[i])
            y.append("-")
        else:
            state = "m" if left[i, j] == best[i, j - 1] - OPEN else "l"
            j -= 1
            x.append("-")
            y.append(b[j])
    return "".join(reversed(x)), "".join(reversed(y)), i + 1, j + 1, score


def align_all(pairs: list[tuple[str, str]], local: bool = False, most_cells: int = 2_000_000) -> list[tuple[str, str, int, int, int]]:
    """Gotoh's affine alignment of each pair: both gapped strings, the starts (from 1) in a and b, and the score.

    A gap of n costs OPEN + (n - 1) * EXTEND, end gaps included in global mode. Where paths tie: a match before a gap in
    b before a gap in a; a local alignment ends at the first best cell by rows. Pairs of like lengths are worked on together,
    up to ``most_cells`` cells of a table; a larger pair is worked on alone and without whole tables.
    """
    large = [(len(a) + 1) * (len(b) + 1) > most_cells for a, b in pairs]
    out: list = [align_long(*p, local) if over else None for p, over in zip(pairs, large, strict=True)]
    order = sorted((k for k, over in enumerate(large) if not over), key=lambda k: (len(pairs[k][0]), len(pairs[k][1])))
    at = 0
    while at < len(order):
        end, n, m = at, 0, 0
        while end < len(order):
            a, b = pairs[order[end]]
            n, m = max(n, len(a)), max(m, len(b))
            if end > at and (n + 1) * (m + 1) * (end - at + 1) > most_cells:
                break
            end += 1
        own = order[at:end]
        letters, best, up, left = _tables([pairs[k][0] for k in own], [pairs[k][1] for k in own], local)
        for c, k in enumerate(own):
            a, b = pairs[k]
            i, j = len(a) + 1, len(b) + 1
            out[k] = _path(a, b, letters[:, :, c], *(np.ascontiguousarray(t[:i, :j, c]) for t in (best, up, left)), local)
        at = end
    return out


def align(a: str, b: str, local: bool = False) -> tuple[str, str, int, int, int]:
    return align_all([(a, b)], local)[0]


ALIGNMENT = "aligned_a string, aligned_b string, start_a int, start_b int, score int"


def _aligner(local: bool):
    @F.pandas_udf(ALIGNMENT)
    def run(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for a, b in pairs:
            whole = [(x, y) for x, y in zip(a, b, strict=True) if x and y]
            done = iter(align_all(whole, local))
            rows = [next(done) if x and y else (None,) * 5 for x, y in zip(a, b, strict=True)]
            yield pd.DataFrame(rows, columns=["aligned_a", "aligned_b", "start_a", "start_b", "score"])

    return run


def aligned(pairs: DataFrame, a: str, b: str, local: bool = False) -> DataFrame:
    """pairs with the fields of an alignment; each distinct pair of sequences is aligned once."""
    one = pairs.select(a, b).where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct()
    done = one.withColumn("_x", _aligner(local)(F.col(a), F.col(b))).select(a, b, "_x.*")
    return pairs.join(done, [a, b], "left")


def text_score(a: Column, b: Column) -> Column:
    """The score of two aligned texts of upper-case letters and gaps, as column expressions: letters by the table, gaps by runs."""
    names = [chr(65 + k) for k in range(26)]
    table = letter_scores()
    pairs = F.create_map(*[F.lit(v) for x in names for y in names for v in (x + y, int(table[ord(x), ord(y)]))])
    letters = F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(F.try_element_at(pairs, F.concat(x, y)), F.lit(0))), F.lit(0), lambda s, v: s + v)
    gaps = F.length(a) + F.length(b) - F.length(F.replace(a, F.lit("-"), F.lit(""))) - F.length(F.replace(b, F.lit("-"), F.lit("")))
    runs = F.regexp_count(a, F.lit("-+")) + F.regexp_count(b, F.lit("-+"))
    return (letters - OPEN * runs - EXTEND * (gaps - runs)).cast("int")


def kmers(seq: Column, k: int) -> Column:
    """Array of the k-mers at every position, in order; empty when the sequence is shorter than k.

    A regular expression reads each in constant time; substring() would walk from the start of the UTF-8 text each time.
    """
    return F.regexp_extract_all(seq, F.lit(f"(?s)(?=(.{{{k}}}))."), F.lit(1))


#: Karlin and Altschul's statistics of BLOSUM62 with gaps of 11 and 1.
LAMBDA, KAPPA = 0.267, 0.041


def similarity_join(
    queries: DataFrame, query: str, qseq: str, subjects: DataFrame, subject: str, sseq: str, k: int = 3, least_shared: int = 2, top: int | None = 50, evalue: float | None = None, exact: bool | None = None
) -> DataFrame:
    """The 12 alignment columns for the best subjects of each query. Bit scores and E-values follow from the raw score, the
    query's length and all letters of the subjects (without corrections for the ends); ``evalue`` keeps those up to it.

    With an ``evalue`` the distinct pairs aligned are those that are worth it (``seeds.py``): two word hits on a diagonal, an
    ungapped extension and a band with gaps that come near the score that the E-value asks for; a weak hit may be missed. ``exact``, or no ``evalue``: every
    pair that shares ``least_shared`` distinct k-mers, which for long sequences is nearly every pair. Of the alignments the
    ``top`` best of each query stay (None: all): by score, then shared k-mers or the extension's score, then subject.
    """
    qs = shared_table(queries.select(F.col(qseq).alias("_q")).where("_q is not null").distinct().withColumn("_a", F.monotonically_increasing_id()), "query-sequences")
    ss = shared_table(subjects.where(F.col(sseq).isNotNull()).groupBy(F.col(sseq).alias("_s")).agg(F.min(subject).alias("_least")).withColumn("_b", F.monotonically_increasing_id()), "subject-sequences")
    letters = subjects.agg(F.sum(F.length(sseq))).first()[0] or 0
    if exact or (exact is None and evalue is None):
        grams = lambda df, i, s: df.select(i, F.explode(F.array_distinct(kmers(F.col(s), k))).alias("kmer"))
        shared = grams(qs, "_a", "_q").join(grams(ss, "_b", "_s"), "kmer").groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= least_shared)
    else:
        asked = lambda n: (math.log(n * max(letters, 1) / evalue) + math.log(KAPPA)) / LAMBDA if evalue else 0.0
        shared = seeds.seeded_pairs(qs, "_a", "_q", ss, "_b", "_s", asked).select(F.col("query").alias("_a"), F.col("subject").alias("_b"), F.col("ungapped").alias("shared"))
    pairs = shared.join(qs, "_a").join(ss, "_b").withColumn("_x", _aligner(True)(F.col("_q"), F.col("_s"))).select("_a", "_q", "_s", "shared", "_least", "_x.*").where(F.length("aligned_a") > 0)
    bits = (LAMBDA * F.col("score") - math.log(KAPPA)) / math.log(2)
    pairs = pairs.withColumn("_bits", bits).withColumn("_e", F.length("_q") * F.lit(letters) * F.pow(F.lit(2.0), -F.col("_bits")))
    pairs = pairs if evalue is None else pairs.where(F.col("_e") <= evalue)
    # a subject among the best has one of the first sequences, and is among the first subjects that have it
    first = lambda df, by, *order: df if top is None else df.withColumn("_rn", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_rn") <= top).drop("_rn")
    best = first(pairs, "_a", F.col("score").desc(), F.col("shared").desc(), "_least")
    named = first(subjects.select(subject, F.col(sseq).alias("_s")).where("_s is not null").distinct(), "_s", subject)
    cols = F.arrays_zip(F.split("aligned_a", "").alias("x"), F.split("aligned_b", "").alias("y"))
    same = F.size(F.filter(cols, lambda c: c["x"] == c["y"]))
    gaps = F.size(F.filter(cols, lambda c: (c["x"] == "-") | (c["y"] == "-")))
    opened = F.size(F.regexp_extract_all("aligned_a", F.lit("-+"), F.lit(0))) + F.size(F.regexp_extract_all("aligned_b", F.lit("-+"), F.lit(0)))
    length = F.length("aligned_a")
    # the columns are worked out once for each pair of sequences, before it is told for each query and subject that have them
    told = best.select(
        "_q", "_s", "score", "shared", F.round(100 * same / length, 3).alias("% Identity"), length.cast("long").alias("Alignment Length"),
        (length - same - gaps).cast("long").alias("Mismatches"), opened.cast("long").alias("Gap Openings"), F.col("start_a").cast("long").alias("Query Start"),
        (F.col("start_a") + F.length(F.replace("aligned_a", F.lit("-"), F.lit(""))) - 1).cast("long").alias("Query End"), F.col("start_b").cast("long").alias("Subject Start"),
        (F.col("start_b") + F.length(F.replace("aligned_b", F.lit("-"), F.lit(""))) - 1).cast("long").alias("Subject End"), F.col("_e").alias("E-value"), F.col("_bits").alias("Bit Score"),
    )
    asking = shared_table(shared_table(told, "told").join(queries.select(F.col(query).alias("Query"), F.col(qseq).alias("_q")).distinct().hint("merge"), "_q").drop("_q"), "asking")
    found = _expanded(asking, named.withColumnRenamed(subject, "Subject"), "_s")
    done = first(found, "Query", F.col("score").desc(), F.col("shared").desc(), "Subject")
    return done.select("Query", "Subject", *told.columns[4:])


def _expanded(left: DataFrame, right: DataFrame, key: str, cell: int = 4_000_000) -> DataFrame:
    """The join of two tables with few, frequent values of a key, whose result may be far larger than both: each value's pairs
    are dealt over cells of about ``cell`` pairs, by parts of the right side, and cells over tasks by their number."""
    right = shared_table(right, "expanded")
    many = left.groupBy(key).agg(F.count(F.lit(1)).alias("_m")).join(right.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).hint("merge"), key)
    parts = shared_table(many.withColumn("_parts", F.least("_n", F.ceil(F.col("_m") * F.col("_n") / cell)).cast("int")).select(key, "_m", "_n", "_parts"), "cells")
    tasks = min(20_000, 1 + int((parts.agg(F.sum(F.col("_m").cast("double") * F.col("_n"))).first()[0] or 0) / cell))
    parts = parts.select(key, "_parts").hint("merge")
    own = left.join(parts, key).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    to = right.join(parts, key).withColumn("_part", F.pmod(F.xxhash64(*right.columns), F.col("_parts")).cast("int")).drop("_parts")
    spread = lambda df: df.repartition(tasks, key, "_part")
    return spread(own).join(spread(to).hint("merge"), [key, "_part"]).drop("_part")
