"""Texts that a model or a remote service returns: JSON out of fences, odd scripts, version rewrites, feedback."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Chinese characters of the unified block.
CJK = r"[一-鿿]"


def unfenced(c: Column) -> Column:
    """The text without a code fence around it."""
    v = F.trim(F.coalesce(c, F.lit("")))
    return F.trim(F.regexp_replace(F.regexp_replace(v, r"\A```[A-Za-z]*\s*\n?", ""), r"\n?```\z", ""))


def _valid(text: Column, first: str) -> Column:
    return F.when(text.startswith(first) & F.try_parse_json(text).isNotNull(), text)


def _between(text: Column, a: str, z: str) -> Column:
    start, end = F.locate(a, text), F.length(text) - F.locate(z, F.reverse(text)) + 1
    return F.when((start > 0) & text.contains(z) & (end > start), F.substr(text, start, end - start + 1))


def json_object(c: Column) -> Column:
    """The JSON object in a text: the whole without fences, or from the first `{` to the last `}`; null if neither parses."""
    v = unfenced(c)
    return F.coalesce(_valid(v, "{"), _valid(_between(v, "{", "}"), "{"))


def json_array(c: Column) -> Column:
    """The JSON array in a text: the whole, or from the first `[` to the last `]`; null if neither parses."""
    v = F.trim(F.coalesce(c, F.lit("")))
    return F.coalesce(_valid(v, "["), _valid(_between(v, "[", "]"), "["))


def cjk_fields(fields: Column) -> Column:
    """Names of the entries of map<name, text> that hold Chinese characters; raw values may."""
    some = F.map_filter(fields, lambda k, v: v.rlike(CJK) & ~k.rlike(r"(?:^|\.)raw_value$"))
    return F.array_sort(F.map_keys(some))


def scalar(c: Column) -> Column:
    """A number as text that JSON can hold: null, nan and infinities become empty."""
    d = c.cast("double")
    return F.when(c.isNull() | F.isnan(d) | F.abs(d).isin(float("inf")), "").otherwise(c.cast("string"))


def filled(m: Column) -> Column:
    """A map without its empty entries."""
    return F.map_filter(m, lambda k, v: v.isNotNull() & (v != ""))


def field_group(m: Column, fields: tuple[str, ...], units: dict[str, str]) -> Column:
    """map<field, struct<value, unit>> of the listed fields that a row map has, in their order."""
    each = F.array(*(F.struct(F.lit(f).alias("k"), F.struct(m[f].alias("value"), F.lit(units.get(f, "")).alias("unit")).alias("v")) for f in fields))
    return F.map_from_entries(F.filter(each, lambda e: F.coalesce(e["v"]["value"], F.lit("")) != ""))


def provider_aliases(main_id: Column, ids: Column) -> Column:
    """Names of a provider row: its main id, then the parts of its list between bars, each once whatever its case."""
    from .text import ordered_distinct

    return ordered_distinct(F.concat(F.array(main_id), F.split(F.coalesce(ids, F.lit("")), r"\|")))


def rewritten(value: Column, versions: dict[str, str]) -> Column:
    """A version by its successor; unknown ones stay."""
    out = value
    for old, new in versions.items():
        out = F.when(value == old, new).otherwise(out)
    return out


def feedback(errors: Column, limit: int) -> Column:
    """The first errors as a list, and how many more there are."""
    shown = F.array_join(F.transform(F.slice(errors, 1, limit), lambda e: F.concat(F.lit("- "), e)), "\n")
    more = F.size(errors) - limit
    return F.when(more > 0, F.concat(shown, F.lit("\n- and "), more.cast("string"), F.lit(" more"))).otherwise(shown)


def thinking(c: Column) -> Column:
    """An option text as on, off or unset (null)."""
    v = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(v.isin("1", "true", "on", "yes", "enabled"), True).when(v.isin("0", "false", "off", "no", "disabled"), False)


def equivalent(a: Column, b: Column) -> Column:
    """Whether two identifiers share a number of ten digits or more, or are equal without regard to case and space."""
    digits = lambda x: F.nullif(F.regexp_extract(F.coalesce(x, F.lit("")), r"\d{10,}", 0), F.lit(""))
    plain = lambda x: F.lower(F.regexp_replace(F.trim(F.coalesce(x, F.lit(""))), r"\s+", " "))
    return F.coalesce(digits(a) == digits(b), F.lit(False)) | ((plain(a) == plain(b)) & (plain(a) != ""))


def three_digits(c: Column) -> Column:
    """A number with three significant digits, without trailing zeros, in exponent form beyond 1e-4 and 1e3, as `%.3g` does."""
    d = c.cast("double")
    sci = F.format_string("%.2e", d)
    power = F.regexp_extract(sci, r"e([+-]\d+)$", 1).try_cast("int")
    fixed = F.when(power >= 2, F.format_string("%.0f", d)).when(power == 1, F.format_string("%.1f", d)).when(power == 0, F.format_string("%.2f", d))
    fixed = fixed.when(power == -1, F.format_string("%.3f", d)).when(power == -2, F.format_string("%.4f", d)).when(power == -3, F.format_string("%.5f", d)).otherwise(F.format_string("%.6f", d))
    trimmed = lambda x: F.when(x.contains("."), F.regexp_replace(x, r"\.?0+$", "")).otherwise(x)
    mantissa = trimmed(F.substring_index(sci, "e", 1))
    out = F.when((power < -4) | (power >= 3), F.concat(mantissa, F.lit("e"), F.substring_index(sci, "e", -1))).otherwise(trimmed(fixed))
    return F.when(d == 0, "0").when(d.isNotNull(), out)


def interval_text(median: Column, low: Column, high: Column) -> Column:
    """`median [low, high]`; the median alone without both ends; empty without a median."""
    whole = F.concat(three_digits(median), F.lit(" ["), three_digits(low), F.lit(", "), three_digits(high), F.lit("]"))
    return F.coalesce(whole, three_digits(median), F.lit(""))
