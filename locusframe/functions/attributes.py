"""Feature attributes: the `key=value,value;...` bag, CIGAR strings, safe names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that safe names escape, and the order in which known tags are rendered.
UNSAFE = "*?|\\/'\"{}<>;,^()$~:.+"
TAGS = ["ID", "Parent", "Name", "Alias", "Target", "Gap", "Derives_from", "Note", "Dbxref", "Ontology_term"]


def decoded(c: Column) -> Column:
    """Percent escapes undone; a plus sign stays one."""
    return F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def parse(attr: Column) -> Column:
    """The bag as map<string, array<string>>."""
    pairs = F.filter(F.transform(F.split(attr, ";"), lambda p: F.trim(p)), lambda p: p.contains("="))
    entries = F.transform(pairs, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.transform(F.split(F.regexp_replace(p, "^[^=]*=", ""), ","), decoded).alias("v")))
    keys = F.array_distinct(F.transform(entries, lambda e: e["k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.flatten(F.transform(F.filter(entries, lambda e: e["k"] == k), lambda e: e["v"]))))


def render(bag: Column) -> Column:
    """The bag as text: known tags in their order, then the others by name."""
    rank = F.create_map(*[F.lit(x) for i, t in enumerate(TAGS) for x in (t, i)])
    entries = F.array_sort(F.transform(F.map_entries(bag), lambda e: F.struct(F.coalesce(F.try_element_at(rank, e["key"]), F.lit(len(TAGS))).alias("r"), e["key"].alias("k"), e["value"].alias("v"))))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["k"], F.lit("="), F.array_join(F.transform(e["v"], lambda x: escaped(x, ";,=%&")), ","))), ";")


def escaped(c: Column, unsafe: str = UNSAFE) -> Column:
    """Each unsafe character as a percent escape."""
    out = c
    for x in sorted(unsafe, key=lambda x: x != "%"):
        out = F.replace(out, F.lit(x), F.lit(f"%{ord(x):02X}"))
    return out


def cigar(c: Column) -> Column:
    """A Gap or CIGAR string as array<struct<op, len>>, whether lengths stand before or after letters."""
    after = F.transform(F.regexp_extract_all(c, F.lit(r"([MIDFR]\d+)"), 1), lambda x: F.struct(F.substring(x, 1, 1).alias("op"), F.substring(x, 2, 10).cast("int").alias("len")))
    before = F.transform(F.regexp_extract_all(c, F.lit(r"(\d+[MIDFR])"), 1), lambda x: F.struct(F.right(x, F.lit(1)).alias("op"), F.regexp_extract(x, r"^(\d+)", 1).cast("int").alias("len")))
    return F.when(F.trim(c).rlike(r"^[MIDFR]"), after).otherwise(before)


def md5_path(name: Column, levels: int = 2) -> Column:
    """The folders that a name's MD5 gives."""
    h = F.upper(F.md5(name))
    return F.concat_ws("/", *[F.substring(h, 2 * i + 1, 2) for i in range(levels)], name)
