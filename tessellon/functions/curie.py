"""CURIE and text helpers as Column expressions; all stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that count as white space (Unicode White_Space and the four separators U+001C to U+001F).
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same as the body of a Java regular-expression class.
WS_CLASS = r"\t\n\x0b\x0c\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(df: DataFrame) -> DataFrame:
    """The frame with its computed columns behind a barrier. A filter or join above reads their values, where
    the optimizer would else move the whole expressions into each of its terms, without sharing them. Filters on
    stored columns belong below it: they would not reach the scan."""
    return df.select(F.explode(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).alias("_once")).select("_once.*")


def _visible(c: Column) -> Column:
    return F.ascii(c).between(33, 126)


def trim_ws(c: Column | str) -> Column:
    """Without white space around it; the general search runs only where an end is no visible ASCII character."""
    c = col(c)
    return F.when(_visible(c) & _visible(F.substr(c, F.lit(-1))), c).otherwise(F.btrim(c, F.lit(WHITE_SPACE)))


def not_blank(c: Column | str) -> Column:
    """False for null, empty and white space only; never null."""
    return F.coalesce(trim_ws(c) != "", F.lit(False))


def plain_curie(c: Column | str) -> Column:
    """Plain form: trimmed, prefix in upper case; null where there is no colon."""
    t = trim_ws(c)
    i = F.instr(t, ":")
    return F.when(i > 0, F.concat(F.upper(F.substr(t, F.lit(1), i - 1)), F.substr(t, i)))


def plain_value(c: Column | str) -> Column:
    """Plain form of a CURIE, other values trimmed; null where blank."""
    t = trim_ws(c)
    i = F.instr(t, ":")
    return F.when(i > 0, F.concat(F.upper(F.substr(t, F.lit(1), i - 1)), F.substr(t, i))).when(t != "", t)


def prefix(c: Column | str) -> Column:
    """All before the first colon, spelling kept; null without a colon."""
    c = col(c)
    i = F.instr(c, ":")
    return F.when(i > 0, F.substr(c, F.lit(1), i - 1))


def upper_prefix(c: Column | str) -> Column:
    return F.upper(prefix(c))


def suffix(c: Column | str) -> Column:
    """All after the first colon; the whole value without a colon."""
    c = col(c)
    return F.substr(c, F.instr(c, ":") + 1)


def numeric_suffix(c: Column | str) -> Column:
    """Suffix as a whole number, null where it is none or too large."""
    return suffix(c).try_cast("bigint")


def with_prefix(c: Column | str, new: Column | str) -> Column:
    return F.concat(F.lit(new) if isinstance(new, str) else new, F.lit(":"), suffix(c))


def upper_curie(c: Column | str) -> Column:
    return F.concat(upper_prefix(c), F.lit(":"), suffix(c))


def obo_to_curie(c: Column | str) -> Column:
    """``http://.../CL_1`` to ``CL:1``."""
    return F.regexp_replace(F.element_at(F.split(col(c), "/"), -1), "_", ":")


def curie_to_obo(c: Column | str, base: str = "http://purl.obolibrary.org/obo/") -> Column:
    return F.concat(F.lit(base), F.regexp_replace(col(c), ":", "_"))


def recurie(c: Column | str, renamed: dict[str, str]) -> Column:
    """The CURIE with its prefix renamed where ``renamed`` has it (in any letter case), else as it is."""
    p = upper_prefix(c)
    new = F.coalesce(*[F.when(p == old.upper(), F.lit(to)) for old, to in renamed.items()], prefix(c)) if renamed else prefix(c)
    return F.when(p.isNotNull(), F.concat(new, F.lit(":"), suffix(c))).otherwise(col(c))


def iri_to_curie(c: Column | str, stems: dict[str, str]) -> Column:
    """An identifier given as an IRI or a CURIE as a CURIE: of the stems that fit the longest gives the prefix; else the last
    part of the path, with ``_`` for the colon; values that are no IRI stay as they are. Null where nothing fits."""
    c = col(c)
    longest = sorted(stems.items(), key=lambda x: (-len(x[0]), x[0]))
    known = [F.when(c.startswith(stem), F.concat(F.lit(f"{p}:"), F.substr(c, F.lit(len(stem) + 1)))) for stem, p in longest]
    last = F.regexp_extract(c, r"([A-Za-z][A-Za-z0-9.]*)_([^/#?]+)$", 0)
    is_iri = c.rlike("^[a-z]+://")
    other = F.when(~is_iri & c.contains(":"), c).when(is_iri & (last != ""), F.regexp_replace(last, "^([^_]+)_", "$1:"))
    return F.coalesce(*known, other)


def normal_xref(c: Column | str, renamed: dict[str, str]) -> Column:
    """A cross-reference from an ontology: trimmed, what follows white space dropped, prefix renamed; null if it is no CURIE."""
    t = F.regexp_extract(trim_ws(c), f"^[^{WS_CLASS}]*", 0)
    return F.when(t.contains(":") & ~t.endswith(":"), recurie(t, renamed))


def suffix_order(c: Column | str) -> list[Column]:
    """Sort keys: numbers of numeric suffixes first and by size, then the other CURIEs by code point."""
    n = numeric_suffix(c)
    return [n.isNull(), n, col(c)]


def snake(c: Column | str) -> Column:
    return F.lower(F.regexp_replace(col(c), r"([a-z0-9])([A-Z])", "$1_$2"))
