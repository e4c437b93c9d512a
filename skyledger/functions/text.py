"""Text, identifier and display expressions. Each takes and returns columns; null counts as empty text unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Identifiers that name no object.
WEAK_NAMES = ("candidate", "object", "source", "star", "unknown", "none", "n/a", "na")


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def collapse(c: Column) -> Column:
    """White space runs (Unicode) as one space, ends trimmed."""
    return F.trim(F.regexp_replace(text(c), r"(?U)\s+", " "))


def gaia_release(c: Column) -> Column:
    return F.upper(F.regexp_extract(collapse(c), r"(?i)^Gaia\s+((?:E)?DR\d+)\s+(\d+)$", 1))


def gaia_number(c: Column) -> Column:
    return F.regexp_extract(collapse(c), r"(?i)^Gaia\s+((?:E)?DR\d+)\s+(\d+)$", 2)


def match_key(c: Column) -> Column:
    """Key of a source id: EDR3 counts as DR3; text that is no such id is its own lower-case key; empty stays empty."""
    release = gaia_release(c)
    family = F.when(release == "EDR3", "DR3").otherwise(release)
    return F.when(gaia_number(c) != "", F.concat(F.lit("gaia "), family, F.lit(" "), gaia_number(c))).otherwise(F.lower(collapse(c)))


def slug(c: Column, others: str = "+-", joiner: str = "_", default: str = "candidate") -> Column:
    """Runs outside letters, digits and `others` become `joiner`, which is trimmed from the ends."""
    made = F.regexp_replace(F.trim(text(c)), "[^A-Za-z0-9" + "".join("\\" + x for x in others) + "]+", joiner)
    return F.coalesce(F.nullif(F.regexp_replace(made, f"^[{joiner}]+|[{joiner}]+$", ""), F.lit("")), F.lit(default))


def folded(c: Column) -> Column:
    """Lower case for comparison: sharp s as ss, final sigma as sigma."""
    return F.replace(F.replace(F.lower(c), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


def alias(c: Column) -> Column:
    return folded(collapse(c))


def weak_identifier(c: Column) -> Column:
    """True for names that can't identify: empty, a source id, an internal candidate id, digits only, short, or a stop word."""
    v = alias(c)
    compact = F.regexp_replace(v, r"[^0-9a-z]+", "")
    return (v == "") | (gaia_number(c) != "") | v.contains(":cand-") | v.rlike(r"^\d+$") | (F.length(compact) < 4) | v.isin(*WEAK_NAMES)


def referee_name(c: Column) -> Column:
    """Upper case without spaces, hyphens and underscores."""
    return F.regexp_replace(F.upper(F.trim(text(c))), r"[\s\-_]+", "")


def strip_version(c: Column) -> Column:
    return F.regexp_replace(F.trim(text(c)), r"v\d+$", "")


def first_present(*cols: Column) -> Column:
    return F.coalesce(*(F.nullif(F.trim(text(c)), F.lit("")) for c in cols), F.lit(""))


def quantity_text(value: Column, error: Column, lower: Column, upper: Column) -> Column:
    """`value ± error`, or `value -lower +upper` with a question mark for a missing side."""
    v, e, lo, up = (F.nullif(F.trim(text(x)), F.lit("")) for x in (value, error, lower, upper))
    two = F.concat(v, F.lit(" -"), F.coalesce(lo, F.lit("?")), F.lit(" +"), F.coalesce(up, F.lit("?")))
    return F.coalesce(F.when(e.isNotNull(), F.concat(v, F.lit(" ± "), e)).when(lo.isNotNull() | up.isNotNull(), two).otherwise(v), F.lit(""))


def author_label(first: Column, count: Column, year: Column) -> Column:
    """Surname, `et al.` unless there is one author, year."""
    surname = F.trim(F.element_at(F.split(text(first), ","), 1))
    return F.trim(F.concat_ws(" ", surname, F.when(count != 1, "et al."), year.cast("string")))


def compact(c: Column, limit: int) -> Column:
    v = collapse(c)
    return F.when(F.length(v) <= limit, v).otherwise(F.concat(F.rtrim(F.left(v, F.lit(limit - 20))), F.lit(" ... [truncated]")))


def escape_pipe(c: Column) -> Column:
    return F.replace(text(c), F.lit("|"), F.lit("\\|"))


def pluralize(n: Column, one: str, many: str) -> Column:
    return F.concat(n.cast("string"), F.lit(" "), F.when(n == 1, one).otherwise(many))


def plain(c: Column) -> Column:
    """Tags become spaces, the five common entities their characters, white space collapses."""
    v = F.regexp_replace(text(c), "<[^>]+>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        v = F.replace(v, F.lit(entity), F.lit(char))
    return collapse(v)


def terms(c: Column, stop: tuple[str, ...] = ("and", "for", "from", "the", "with")) -> Column:
    """Distinct lower-case terms: numbers, and words of three letters or more that are no stop words."""
    found = F.regexp_extract_all(F.regexp_replace(F.lower(text(c)), r"\\[a-z]+", " "), F.lit(r"([a-z0-9]+(?:\.[0-9]+)?)"), F.lit(1))
    return F.array_distinct(F.filter(found, lambda t: ~t.isin(*stop) & ((F.length(t) >= 3) | t.rlike("[0-9]"))))


def letters_only(c: Column) -> Column:
    return F.regexp_replace(F.lower(text(c)), "[^a-z0-9]+", "")


def field_name(location: Column) -> Column:
    return F.substring_index(F.regexp_replace(text(location), r"\[\d+\]", ""), ".", -1)


def paragraph(c: Column, which: int) -> Column:
    """The first (1) or last (-1) paragraph with text."""
    parts = F.filter(F.transform(F.split(text(c), "\n\n"), lambda p: F.trim(p)), lambda p: p != "")
    return F.when(F.size(parts) > 0, F.element_at(parts, which)).otherwise("")


def numbered_lines(c: Column) -> Column:
    """Each line after its number and a bar; a final empty line is dropped."""
    lines = F.split(text(c), "\n", -1)
    kept = F.when((F.size(lines) > 1) & (F.element_at(lines, -1) == ""), F.slice(lines, F.lit(1), F.size(lines) - 1)).otherwise(lines)
    return F.array_join(F.transform(kept, lambda x, i: F.concat((i + 1).cast("string"), F.lit("|"), x)), "\n")


def cited_keys(c: Column) -> Column:
    r"""Sorted distinct keys of all \cite commands."""
    args = F.regexp_extract_all(text(c), F.lit(r"\\(?:no)?cite[a-zA-Z*]*(?:\[[^\]]*\])*\{([^}]*)\}"), F.lit(1))
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.flatten(F.transform(args, lambda a: F.split(a, ","))), lambda k: F.trim(k)), lambda k: k != "")))


def urls(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text(c), F.lit(r"(https?://[^\s\"'<>{}\\]+)"), F.lit(1))))


def ordered_distinct(values: Column) -> Column:
    """Distinct values by their collapsed lower-case form; the first spelling stays, in order."""
    some = F.filter(F.transform(values, collapse), lambda v: v != "")
    empty = F.array().cast("array<string>")
    return F.aggregate(some, empty, lambda a, v: F.when(F.exists(a, lambda x: F.lower(x) == F.lower(v)), a).otherwise(F.concat(a, F.array(v))))


def json_for_script(c: Column) -> Column:
    return F.replace(text(c), F.lit("</"), F.lit("<\\/"))


def public_host(url: Column) -> Column:
    """http(s) with a host that is neither local nor in a private range."""
    host = F.lower(F.regexp_extract(text(url), r"^https?://([^/:?#]+)", 1))
    private = host.rlike(r"^(localhost|.*\.local|127\..*|10\..*|192\.168\..*|169\.254\..*|172\.(1[6-9]|2[0-9]|3[01])\..*|0\.0\.0\.0)$")
    return (host != "") & host.contains(".") & ~private
