"""Personal data by weak supervision.

Four base patterns give spans that always stay. Wider candidate patterns give further spans; on base and wider spans alike,
labelers vote (format, gazetteer, context, variety, repetition). Expectation-maximisation over the counts of vote patterns
estimates how reliable each labeler is; its posteriors train a logistic classifier of spans, which decides on the wider ones.
Secrets (keys, tokens, passwords) have no base pattern; all of them are wider spans.

Built-in functions only. The counts are of vote and feature patterns (at most CELLS rows whatever the corpus), so the
estimation itself is a short loop on the driver over that table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Kinds in the order of their rendering; those without a base pattern come last.
ALL = (*KINDS, "secret")

#: The base patterns. `\\G` and the look-behinds only skip starts that cannot match, possessive quantifiers
#: only forbid steps back that cannot help; the matches are those of the plain patterns, in time linear in the text.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A text without these holds no match; the test costs less than the search.
NEEDED = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}

#: Wider candidates: spelled-out or bracketed e-mail, IPv6, long digit groups with dots or slashes, national phone numbers; of
#: secrets the forms of well-known issuers, private key blocks, values set to a telling name, and long mixed strings.
_HEX4, _NAME = r"[0-9A-Fa-f]{1,4}", r"(?i:passwo?r?d|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key|private[_-]?key|client[_-]?key)"
_SET = rf"(?<![A-Za-z0-9]){_NAME}[\"']?\x20{{0,2}}[:=]\x20{{0,2}}[\"']?"
WIDE = {
    "email": r"[A-Za-z0-9._%+-]++\x20?(?i:\[at\]|\(at\)|\{at\})\x20?[A-Za-z0-9-]++(?:(?:\x20?(?i:\[dot\]|\(dot\)|\{dot\})\x20?|\.)[A-Za-z0-9-]++)++",
    "ip": rf"(?<![0-9A-Za-z:])(?:{_HEX4}(?::{_HEX4}){{7}}|(?:{_HEX4}(?::{_HEX4}){{0,5}})?::{_HEX4}(?::{_HEX4}){{0,5}}|{_HEX4}(?::{_HEX4}){{1,6}}::)(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
    "secret": r"-----BEGIN[A-Z\x20]{0,30}PRIVATE\x20KEY-----[A-Za-z0-9+/=\s]*+(?:-----END[A-Z\x20]{0,30}PRIVATE\x20KEY-----)?"
    rf"|(?=[PpSsTtAaCc]){_SET}[^\s\"',;<>]{{6,}}+"
    r"|(?<![A-Za-z0-9+/=_.-])(?:eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+(?:\.[A-Za-z0-9_-]++)?|[A-Za-z0-9+/_-]{20,}+={0,2})(?![A-Za-z0-9+/=_-])",
}
#: Tests that a text without a candidate fails, each of one pass over the text.
WIDE_NEEDED = {
    "email": r"[\[({](?i:at)[\])}]",
    "ip": r":[0-9A-Fa-f]{0,4}:",
    "card": r"[0-9]{4}[./_][0-9]{4}",
    "phone": r"[0-9]{3}[\x20.-][0-9]{4}",
    "secret": r"\A(?:[^A-Za-z0-9+/_-]++|[A-Za-z0-9+/_-]{1,19}+(?![A-Za-z0-9+/_-]))*+[A-Za-z0-9+/_-]",  # a run of 20 or more
}

#: Twenty characters without white space.
LONG_RUN = r"\A(?:\s++|\S{1,19}+(?!\S))*+\S"

#: Top-level domains of general use and of countries with many speakers of the corpus's languages.
DOMAINS = (
    "com org net edu gov mil int info biz name pro io ai app dev co me tv cc online site shop tech cloud blog "
    "us uk ca au nz ie za in de at ch li fr be lu nl es mx ar cl pe ve uy ec it pt br pl cz sk hu ro bg gr "
    "se no dk fi is ee lv lt ru ua by tr il ae sa eg ma dz tn ng ke gh jp cn kr tw hk sg my th vn id ph pk bd lk eu"
)
#: Calling codes of the numbering zones; two and three digits where a zone has no code of one.
CALLING = "1 7 20 27 3[0-469] 4[013-9] 5[1-8] 6[0-6] 8[1246] 9[0-58] 2[1-69][0-9] 3[578][0-9] 42[0-9] 5[09][0-9] 6[789][0-9] 8[0578][0-9] 9[679][0-9]"
#: Gazetteers and cue words, by kind.
GAZETTEER = {
    "email": rf"(?i)(?:^|[.\x20)\]}}])(?:{'|'.join(DOMAINS.split())})$",
    "ip": r"^(?!0|255|(?:[0-9]{1,3}\.){3}0+$)[0-9]{1,3}\.|^(?i:2[0-9a-f]{3}|fe80|f[cd][0-9a-f]{2}|64):",
    "card": r"^(?:4|5[0-8]|2[2-7]|3[0-9]|6)",
    "phone": rf"^\+\x20?\(?(?:{'|'.join(CALLING.split())})|^\(?[2-9]",
    "secret": r"^(?:AKIA|ASIA|AIza|gh[pousr]_|github_pat_|glpat-|xox[abprs]-|[sr]k[-_]|pk_live|eyJ|SG\.|npm_|hf_|-----BEGIN)|^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{48}|[0-9a-f]{64}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{48}|[0-9A-F]{64})$",
}
CUES = {
    "email": r"(?i)\b(?:e-?mail|mail|mailto|contact|write|reach|send|from|to|cc|kontakt|schreib|correo|escrib|courriel|adresse)\b",
    "ip": r"(?i)\b(?:ip|host|address|addr|server|client|login|gateway|ping|subnet|ssh|adresse|direcci[oó]n|servidor|serveur)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|payment|pay|cvv|expir\w*|karte|kreditkarte|carte|tarjeta|pago)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|whatsapp|sms|dial|telefon|handy|rufnummer|tel[eé]fono|m[oó]vil|appel|t[eé]l[eé]phone|portable)\b",
    "secret": rf"{_NAME}|(?i)\b(?:key|bearer|authorization|credential\w*|login|schl[uü]ssel|kennwort|passwort|contrase[nñ]a|clave|mot\x20de\x20passe)\b",
}
AGAINST = r"(?i)\b(?:version|order|invoice|isbn|issn|serial|ticket|part|page|figure|section|id|ref|sku|total|commit|checksum|sha-?[0-9]*|md5|digest|hash|https?:/?)\b\W*$"
CONTEXT, NEAR = 32, 256
#: At most so many rows of votes and features: 5 kinds, 2 origins, 243 vote patterns, 12 feature patterns.
VOTES = 5
CELLS = len(ALL) * 2 * 3**VOTES * 12
SURE = 0.9


def may_hold(text: Column, kind: str) -> Column:
    """Whether a text can hold a wider candidate. Long runs without a space, and the marks of a set name, are looked for first, as
    few texts have them and the full tests cost several times as much."""
    test = text.rlike(WIDE_NEEDED[kind])
    return (text.rlike(LONG_RUN) & test) | (text.rlike("[:=]") & text.rlike(_SET)) if kind == "secret" else test


def matches(text: Column, pattern: str, needed: Column) -> Column:
    """array<struct<s, e, m>>: leftmost non-overlapping matches with their code point offsets, end exclusive.

    The pieces between the matches give the offsets; a text that fails the `needed` test is not searched.
    """
    kind = "array<struct<s:int,e:int,m:string>>"
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(a: Column, x: Column) -> Column:
        s = a["at"] + F.length(x["g"])
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.concat(a["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))).alias("out"))

    joined = F.filter(F.arrays_zip(between.alias("g"), found.alias("m")), lambda x: x["m"].isNotNull())
    return F.when(needed, F.aggregate(joined, start, step, lambda a: a["out"])).otherwise(F.array().cast(kind))


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    n = F.length(d)

    def term(i: Column) -> Column:
        v = F.substr(d, n - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(v > 9, v - 9).otherwise(v)

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), term), F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.substr(F.regexp_replace(p, "^0+(?=.)", ""), F.lit(1), F.lit(4)).cast("int") <= 255))
    if kind == "card":
        n = F.length(digits(m))
        return F.when(n.between(14, 19), luhn(digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(digits(m)).between(10, 15)
    return F.lit(True)


def with_base(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """keep columns, the text (`_t`, null as empty) and one array of valid base spans for each kind (`_email`, ...)."""
    t = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_t"))
    patterns = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE)))
    def spans(k: str) -> Column:
        return F.filter(matches(F.col("_t"), patterns[k], F.col("_t").rlike(NEEDED[k])), lambda x: valid(k, x["m"])).alias(f"_{k}")

    return t.select(*keep, "_t", *map(spans, KINDS))


def with_candidates(base: DataFrame, keep: list[str]) -> DataFrame:
    """Adds `_wide`: wider spans that touch no base span and no wider span of an earlier kind, with kind, s, e and m."""

    def tagged(c: Column, k: int) -> Column:
        return F.transform(c, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"), x["m"].alias("m")))

    all_base = F.concat(*(tagged(F.col(f"_{k}"), i) for i, k in enumerate(KINDS)))
    raw = F.concat(*(tagged(matches(F.col("_t"), WIDE[k], may_hold(F.col("_t"), k)), i) for i, k in enumerate(ALL)))
    one = base.select(*keep, "_t", all_base.alias("_base"), raw.alias("_raw"))
    touches = lambda x, y: (x["s"] < y["e"]) & (y["s"] < x["e"])
    two = one.withColumn("_free", F.filter("_raw", lambda x: ~F.exists(F.col("_base"), lambda y: touches(x, y))))
    return two.withColumn("_wide", F.filter("_free", lambda x: ~F.exists(F.col("_free"), lambda y: touches(x, y) & (y["k"] < x["k"])))).select(*keep, "_t", "_base", "_wide")


def of_kind(k: Column, make) -> Column:
    c = make(ALL[0])
    for i, name in enumerate(ALL[1:], 1):
        c = F.when(k == i, make(name)).otherwise(c)
    return c


def well_formed(kind: str, m: Column, wide: Column) -> Column:
    """The format labeler: what the base and the wider patterns leave open about the form."""
    if kind == "email":
        plain = m.rlike(r"^[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}$")
        return F.when(F.when(wide, m.rlike(r"(?i)dot\W|\.[A-Za-z]{2,24}$")).otherwise(plain), 1).otherwise(-1)
    if kind == "ip":
        return F.when(F.when(wide, m.rlike(r"[0-9]") & m.rlike(r":[^:]+:|::")).otherwise(m.rlike(r"^[1-9][0-9]{0,2}(?:\.(?:0|[1-9][0-9]{0,2})){3}$")), 1).otherwise(-1)
    if kind == "card":
        d = digits(m)
        issued = d.rlike(r"^(?:4[0-9]{15}(?:[0-9]{3})?|5[0-8][0-9]{14}|2[2-7][0-9]{14}|3[47][0-9]{13}|3[0689][0-9]{12}|6[0-9]{15,18})$")
        return F.when(wide & ~luhn(d), -1).when(issued, 1).otherwise(0)
    if kind == "phone":
        even = F.length(F.regexp_replace(m, r"[^(]", "")) == F.length(F.regexp_replace(m, r"[^)]", ""))
        return F.when(~even, -1).when(m.rlike(r"^\+[1-9]|^\([2-9]|^[2-9].*([.-])[0-9]{3}\1"), 1).otherwise(0)
    v = secret_value(m)
    mixed = v.rlike(r"[0-9]") & v.rlike(r"[A-Za-z]")
    return F.when(v.rlike(r"^-----BEGIN"), 1).when(~mixed | v.rlike(r"/.*/|^[0-9]+-[0-9]+-"), -1).when(F.length(v) >= 16, 1).otherwise(0)


def secret_value(m: Column) -> Column:
    """What a name is set to; a secret without a name is its own value."""
    return F.regexp_replace(m, f"^{_SET}", "")


def votes(x: Column, text: Column, wide: Column) -> list[Column]:
    """+1 for personal data, -1 against, 0 for no opinion: format, gazetteer, context, variety, repetition.

    variety: a value of one or two different characters is a placeholder. repetition: a value that stands in its NEAR
    characters again and again is a table's or a template's.
    """
    m, k = x["m"], x["k"]
    before = F.substr(text, F.greatest(x["s"] - CONTEXT + 1, F.lit(1)), F.least(x["s"], F.lit(CONTEXT)))
    around = F.substr(text, F.greatest(x["s"] - NEAR + 1, F.lit(1)), F.least(x["s"], F.lit(NEAR)) + (x["e"] - x["s"]) + NEAR)
    d = F.when(k == ALL.index("secret"), secret_value(m)).otherwise(digits(m))
    known = lambda n: F.when(secret_value(m).rlike(GAZETTEER[n]), 1).otherwise(0) if n == "secret" else F.when(m.rlike(GAZETTEER[n]), 1).otherwise(-1)
    gazetteer = of_kind(k, known)
    context = F.when(before.rlike(AGAINST), -1).when(of_kind(k, lambda n: before.rlike(CUES[n]) | (m.rlike(f"^{_SET}") if n == "secret" else F.lit(False))), 1).otherwise(0)
    kinds = F.size(F.array_distinct(F.split(F.left(d, F.lit(64)), "")))
    times = (F.length(around) - F.length(F.replace(around, m, F.lit("")))) / F.length(m)
    return [
        of_kind(k, lambda n: well_formed(n, m, wide)),
        gazetteer,
        context,
        F.when(F.length(d) < 7, 0).when(kinds <= 3, -1).otherwise(1),  # split adds one empty piece
        F.when(times >= 3, -1).when(times >= 2, 0).otherwise(1),
    ]


def features(x: Column) -> list[Column]:
    """Separators in the span (none, one kind, more) and the size of its digits (0 to 3)."""
    seps = F.length(F.array_join(F.array_distinct(F.split(F.regexp_replace(x["m"], "[A-Za-z0-9]", ""), "")), ""))
    n = F.length(digits(x["m"]))
    return [F.least(seps, F.lit(2)), F.when(n == 0, 0).when(n < 10, 1).when(n < 14, 2).otherwise(3)]


def cells(spans: DataFrame) -> DataFrame:
    """Counts of every pattern of kind, origin, votes and features over all candidate spans of the corpus."""
    both = F.concat(F.transform("_base", lambda x: F.struct(x.alias("x"), F.lit(False).alias("wide"))), F.transform("_wide", lambda x: F.struct(x.alias("x"), F.lit(True).alias("wide"))))
    # an outer explode: a filter on the array would be moved below it and search every text twice
    rows = spans.select("_t", F.explode_outer(both).alias("z")).where("z is not null")
    x, wide = F.col("z.x"), F.col("z.wide")
    named = [c.alias(f"v{i}") for i, c in enumerate(votes(x, F.col("_t"), wide))] + [c.alias(f"f{i}") for i, c in enumerate(features(x))]
    keys = ["k", "wide", *(f"v{i}" for i in range(VOTES)), "f0", "f1"]
    return rows.select(x["k"].alias("k"), wide.alias("wide"), *named).groupBy(*keys).agg(F.count("*").alias("n"))


def label_model(patterns: dict[tuple[int, ...], float], rounds: int = 50) -> dict[tuple[int, ...], float]:
    """Posterior that a span with these votes is personal data; labelers are independent given the truth."""
    m = len(next(iter(patterns), ()))
    prior = 0.5
    given = {z: [{v: (0.6 if v == z else 0.25 if v == 0 else 0.15) for v in (-1, 0, 1)} for _ in range(m)] for z in (-1, 1)}
    total = sum(patterns.values())
    post: dict[tuple[int, ...], float] = {}
    for _ in range(rounds if total else 0):
        for p in patterns:
            yes = prior * math.prod(given[1][j][v] for j, v in enumerate(p))
            no = (1 - prior) * math.prod(given[-1][j][v] for j, v in enumerate(p))
            post[p] = yes / (yes + no)
        weight = {1: sum(n * post[p] for p, n in patterns.items()), -1: sum(n * (1 - post[p]) for p, n in patterns.items())}
        prior = (weight[1] + 1) / (total + 2)
        for z in (-1, 1):
            for j in range(m):
                for v in (-1, 0, 1):
                    got = sum(n * (post[p] if z == 1 else 1 - post[p]) for p, n in patterns.items() if p[j] == v)
                    given[z][j][v] = (got + (2.0 if v == z else 0.5)) / (weight[z] + 3.0)
    return post


def terms(row) -> tuple[str, ...]:
    return ("bias", f"k{row['k']}", *(f"v{i}={row[f'v{i}']}" for i in range(VOTES)), f"f0={row['f0']}", f"f1={row['f1']}")


def classifier(table: list, rounds: int = 300, rate: float = 0.5, shrink: float = 1e-3) -> dict[str, float]:
    """Weights of a logistic model of spans, trained on the label model's posteriors by gradient steps over the cells."""
    patterns: dict[tuple[int, ...], float] = {}
    for r in table:
        key = tuple(r[f"v{i}"] for i in range(VOTES))
        patterns[key] = patterns.get(key, 0) + r["n"]
    post = label_model(patterns)
    rows = [(terms(r), r["n"], post[tuple(r[f"v{i}"] for i in range(VOTES))]) for r in sorted(table, key=lambda r: tuple(map(str, terms(r))))]
    total = sum(n for _, n, _ in rows)
    w: dict[str, float] = {}
    for _ in range(rounds if total else 0):
        grad: dict[str, float] = {}
        for names, n, y in rows:
            err = n / total * (y - 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w.get(t, 0.0) for t in names))))))
            for t in names:
                grad[t] = grad.get(t, 0.0) + err
        for t, g in grad.items():
            w[t] = w.get(t, 0.0) + rate * (g - shrink * w.get(t, 0.0))
    return w


def accepted(x: Column, text: Column, w: dict[str, float], sure: float) -> Column:
    """Whether the classifier is sure of a wider span; a term that training never met adds nothing."""

    def weight(name: str, value: Column, options) -> Column:
        c = F.lit(0.0)
        for o in options:
            c = F.when(value == o, w.get(f"{name}{o}", 0.0)).otherwise(c)
        return c

    z = F.lit(w.get("bias", -30.0)) + weight("k", x["k"], range(len(ALL)))
    for i, v in enumerate(votes(x, text, F.lit(True))):
        z = z + weight(f"v{i}=", v, (-1, 0, 1))
    for i, (v, options) in enumerate(zip(features(x), ((0, 1, 2), (0, 1, 2, 3)))):
        z = z + weight(f"f{i}=", v, options)
    return z >= math.log(sure / (1 - sure))


def find(docs: DataFrame, text: str = "text", keep: list[str] | None = None, sure: float = SURE) -> DataFrame:
    """keep columns, `_t` (text, null as empty), `base` and `spans`: arrays of (s, k, e), by start and kind.

    base: the valid matches of the four patterns, never dropped. spans: those and the accepted wider ones. Two passes over
    the texts, one for the counts and one for the result; only counts are shuffled. Empty tables give no weights and no rows.
    """
    keep = keep or []
    w = classifier(cells(with_candidates(with_base(docs, text, []), [])).collect())  # at most CELLS rows
    found = with_candidates(with_base(docs, text, keep), keep)
    small = lambda c: F.transform(c, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))
    more = F.filter("_wide", lambda x: accepted(x, F.col("_t"), w, sure))
    return found.select(*keep, "_t", F.sort_array(small(F.col("_base"))).alias("base"), F.sort_array(F.concat(small(F.col("_base")), small(more))).alias("spans"))


def rendered(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(F.array(*map(F.lit, ALL)), x["k"] + 1), x["s"], x["e"])), ",")


def redact(docs: DataFrame, text: str = "text", sure: float = SURE) -> DataFrame:
    """docs with each span of the text replaced by its kind in angle brackets, such as <EMAIL>; overlapping spans merge into the
    first. Null texts stay null; rows and other columns stay as they are."""
    own = [c for c in docs.columns if c != text]
    found = find(docs.select(*(F.col(f"`{c}`") for c in own), F.col(text), F.col(text).alias("_was")), text, [*own, "_was"], sure)
    t = F.col("_t")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, x: Column) -> Column:
        mark = F.concat(F.lit("<"), F.upper(F.element_at(F.array(*map(F.lit, ALL)), x["k"] + 1)), F.lit(">"))
        gone = x["s"] < a["at"]
        piece = F.when(gone, "").otherwise(F.concat(F.substr(t, a["at"] + 1, F.greatest(x["s"] - a["at"], F.lit(0))), mark))
        return F.struct(F.greatest(a["at"], x["e"]).alias("at"), F.concat(a["out"], piece).alias("out"))

    clean = F.aggregate("spans", start, step, lambda a: F.concat(a["out"], F.substr(t, a["at"] + 1, F.length(t))))
    new = F.when(F.col("_was").isNull() | (F.size("spans") == 0), F.col("_was")).otherwise(clean)
    return found.withColumn(text, new).select(*(f"`{c}`" for c in docs.columns))


def digest(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, the number of base spans by kind, base_sha256, all spans, their number and that of secrets among them, for every row; a
    null text counts as empty."""
    found = find(docs.select(id_col, text), text, [id_col])
    def count(i: int) -> Column:
        return F.size(F.filter("base", lambda x: x["k"] == i)).cast("bigint").alias(f"n_{KINDS[i]}")

    counts = map(count, range(len(KINDS)))
    return found.select(id_col, *counts, F.sha2(rendered(F.col("base")), 256).alias("base_sha256"), rendered(F.col("spans")).alias("spans"), F.size("spans").cast("bigint").alias("n_spans"), F.size(F.filter("spans", lambda x: x["k"] == ALL.index("secret"))).cast("bigint").alias("n_secret"))
