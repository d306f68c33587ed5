"""Column expressions: identifiers, text, dates and lookups. All stay inside the JVM."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Names:
    """Prefixes of identifiers; a deployment sets its own for local taxa and proteins."""

    public: str = "NCBITaxon:"
    local: str = "local-taxon:"
    protein: str = "local-protein:"
    first_local: int = 10_000_000
    home: str = "local"  # the database of what has no public parent


NAMES = Names()


def curie(taxon: Column, names: Names = NAMES) -> Column:
    """Numbers from first_local on are local taxa, other numbers public ones; '...-other' is local; the rest stays."""
    text = taxon.cast("string")
    number = text.try_cast("long")
    return F.when(number >= names.first_local, F.concat(F.lit(names.local), text)).when(number.isNotNull(), F.concat(F.lit(names.public), text)).when(text.endswith("-other"), F.concat(F.lit(names.local), text)).otherwise(text)


def taxon_id(c: Column, names: Names = NAMES) -> Column:
    """The number in an identifier, as text, without prefix and '-other'."""
    return F.regexp_replace(c, f"^(?:{names.public}|{names.local})|-other$", "")


def other_curie(c: Column, names: Names = NAMES) -> Column:
    return F.concat(F.lit(names.local), taxon_id(c, names), F.lit("-other"))


def float_text_to_long(c: Column) -> Column:
    """Ids that arrive as '57494.0'."""
    return c.try_cast("double").try_cast("long")


def blank(c: Column) -> Column:
    """Null and the empty string alike."""
    return c.isNull() | (c == "")


def discontinuous(c: Column) -> Column:
    """A sequence with a digit in it lists residues with positions."""
    return c.rlike(r"\d")


def eligible_peptide(c: Column, least: int = 5) -> Column:
    return F.coalesce((F.length(c) >= least) & ~discontinuous(c), F.lit(False))


def residues(c: Column) -> Column:
    """'H15, G16' -> array of (aa, pos)."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"[A-Za-z]\d+"), F.lit(0)), lambda t: F.struct(F.substring(t, 1, 1).alias("aa"), F.substring(t, 2, 18).try_cast("int").alias("pos")))


def normal_residue_list(c: Column) -> Column:
    """The fixed chain of replacements that turns separators into single commas; one trailing comma goes."""
    for a, b in ((",  ", ", "), (" ,", ", "), (", ", ","), (" ", ","), (",,", ",")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.regexp_replace(c, ",$", "")


def clean_sequence(c: Column) -> Column:
    return F.regexp_replace(F.upper(c), "[^A-Z]", "")


def upper_letter(c: Column) -> Column:
    """The capital of one letter, always one letter: upper() makes two of some (ß), and so moves what stands behind them."""
    up = F.upper(c)
    return F.when(F.length(up) == 1, up).when(c == "ß", F.lit("ẞ")).otherwise(F.initcap(c))


def slug(c: Column) -> Column:
    """A key for file names: spaces become hyphens, slashes underscores; brackets, dots and quotes go."""
    return F.translate(c, " /().'\"", "-_")


def escape_quotes(c: Column) -> Column:
    return F.replace(c, F.lit('"'), F.lit('\\"'))


def html_escape(c: Column) -> Column:
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")), c)


def iso_week(ts: Column) -> Column:
    """'2026-W02': the ISO year and week of a date."""
    return F.concat(F.date_part(F.lit("YEAROFWEEK"), ts).cast("string"), F.lit("-W"), F.lpad(F.date_part(F.lit("WEEK"), ts).cast("string"), 2, "0"))


def last_sunday(day: Column) -> Column:
    """The Sunday on or before a day."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def lookup(key: Column, pairs: dict, default: Column | None = None) -> Column:
    """A dictionary as an expression; a missing key gives the default (null without one)."""
    table = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    found = F.try_element_at(table, key)
    return found if default is None else F.coalesce(found, default)


def mark_mismatches(source: Column, parent: Column) -> Column:
    """The parent's residues, those unlike the source's in lower case; empty when the lengths differ."""
    pairs = F.zip_with(F.split(source, ""), F.split(parent, ""), lambda s, p: F.when(s == p, p).otherwise(F.lower(p)))
    return F.when(F.length(source) != F.length(parent), F.lit("")).otherwise(F.array_join(pairs, ""))


def union_sorted(*lists: Column) -> Column:
    """The set union of arrays in a fixed order; null arrays count as empty."""
    none = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.flatten(F.array(*[F.coalesce(x, none) for x in lists]))))


def proteome_link(proteome_id: Column, taxon: Column) -> Column:
    base = "https://www.uniprot.org/"
    return F.when(blank(proteome_id), F.concat(F.lit(base + "taxonomy/"), taxon.cast("string"))).otherwise(F.concat(F.lit(base + "proteomes/"), proteome_id))
