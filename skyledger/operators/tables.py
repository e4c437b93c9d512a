"""Tables out of LaTeX and HTML text, as rows."""

from __future__ import annotations

import csv
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers

#: Table environments by priority, and commands that rule off a header.
ENVIRONMENTS = ("tabular", "tabular*", "longtable", "deluxetable", "deluxetable*")
RULES = re.compile(r"\\(?:hline|toprule|midrule|bottomrule|tableline|startdata|colhead|cline\{[^}]*\})")


def uncommented(text: str) -> str:
    return "\n".join(re.sub(r"(?<!\\)((?:\\\\)*)%.*$", r"\1", line) for line in text.split("\n"))


def closing(text: str, at: int, close: str = "}") -> int:
    """Index of the delimiter that closes the one at `at`, or -1."""
    opener, depth, i = text[at], 0, at
    while i < len(text):
        if text[i] == "\\":
            i += 2
            continue
        depth += (text[i] == opener) - (text[i] == close)
        if depth == 0:
            return i
        i += 1
    return -1


def split_level(text: str, mark: str) -> list[str]:
    """Split at `mark` outside braces, unescaped; for `\\\\` an optional [..] after it goes too."""
    parts, depth, start, i = [], 0, 0, 0
    while i < len(text):
        if depth == 0 and text.startswith(mark, i):
            parts.append(text[start:i])
            i += len(mark)
            if mark == "\\\\" and (m := re.match(r"\*?\s*\[[^\]]*\]", text[i:])):
                i += m.end()
            start = i
            continue
        if text[i] == "\\":
            i += 2
            continue
        depth += (text[i] == "{") - (text[i] == "}")
        i += 1
    return [*parts, text[start:]]


def clean_cell(cell: str) -> str:
    cell = cell.strip()
    for pattern, new in ((r"\\multicolumn\{[^}]*\}\{[^}]*\}\{((?:[^{}]|\{[^{}]*\})*)\}", r"\1"), (r"\\(?:textbf|textit|mathrm|rm|bf|text|emph|colhead)\s*\{([^{}]*)\}", r"\1"), (r"\\pm", "±"), (r"\\,|\;|\\ |~", " "), (r"\\([%&_#$])", r"\1"), (r"[${}]", "")):
        cell = re.sub(pattern, new, cell)
    return " ".join(cell.split())


def latex_table(text: str) -> tuple[list[list[str]], list[list[str]]]:
    """Header and data rows of the first table by priority, padded to the widest row; rule commands part the header from the
    data, else the first row of several is the header."""
    text = uncommented(text)
    for env in ENVIRONMENTS:
        m = re.search(r"\\begin\{" + re.escape(env) + r"\}(.*?)\\end\{" + re.escape(env) + r"\}", text, re.S)
        if m:
            break
    else:
        return [], []
    body = m[1]
    while (g := re.match(r"\s*[\[{]", body)) and (end := closing(body, g.end() - 1, "]" if body[g.end() - 1] == "[" else "}")) >= 0:
        body = body[end + 1 :]
    groups = []
    for part in RULES.split(body):
        rows = [[clean_cell(c) for c in split_level(r, "&")] for r in split_level(part, "\\\\") if r.strip()]
        if rows := [r for r in rows if any(r)]:
            groups.append(rows)
    rows = [r for g in groups for r in g]
    head = len(groups[0]) if len(groups) > 1 else 1 if len(rows) > 1 else 0
    width = max(map(len, rows), default=0)
    rows = [r + [""] * (width - len(r)) for r in rows]
    return rows[:head], rows[head:]


class _Cells(HTMLParser):
    def __init__(self):
        super().__init__()
        self.rows, self.cell, self.span, self.head, self.table = [], None, (1, 1), False, 0

    def handle_starttag(self, tag, attrs):
        self.table += tag == "table"
        if self.table == 1 and tag == "tr":
            self.rows.append([])
        if self.table == 1 and tag in ("td", "th") and self.rows:
            a = dict(attrs)
            self.cell, self.head = [], tag == "th"
            self.span = tuple(int(a.get(k) or 1) if (a.get(k) or "1").isdigit() else 1 for k in ("colspan", "rowspan"))

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None:
            self.rows[-1].append((" ".join("".join(self.cell).split()), *self.span, self.head))
            self.cell = None
        if tag == "table" and self.table == 1:
            self.table = 99


def html_table(text: str) -> tuple[list[list[str]], list[list[str]]]:
    """Header and data rows of the first HTML table: a column span is filled with empty cells, a row span repeats its value."""
    p = _Cells()
    p.feed(text or "")
    held: dict[int, tuple[int, str]] = {}
    out, heads = [], []
    for cells in p.rows:
        row, todo = [], list(cells)
        while todo or len(row) in held:
            k = len(row)
            if k in held:
                n, v = held.pop(k)
                row.append(v)
                if n > 1:
                    held[k] = (n - 1, v)
                continue
            v, cs, rs, _ = todo.pop(0)
            for j in range(cs):
                row.append(v if j == 0 else "")
                if rs > 1:
                    held[k + j] = (rs - 1, v if j == 0 else "")
        out.append(row)
        heads.append(bool(cells) and all(c[3] for c in cells))
    n = 0
    while n < len(out) and heads[n]:
        n += 1
    if n == 0 and len(out) > 1 and not any(ch.isdigit() for c in out[0] for ch in c):
        n = 1
    width = max(map(len, out), default=0)
    out = [r + [""] * (width - len(r)) for r in out]
    return out[:n], out[n:]


def rows(docs: DataFrame, id_col: str, text: str, kind: str = "html") -> DataFrame:
    """id, part (header or data), row, col, value of each document's first table, parsed where the document is."""
    parse = {"html": html_table, "latex": latex_table}[kind]

    def run(batches):
        for pdf in batches:
            out = [(i, part, r, c, v) for i, t in zip(pdf[id_col], pdf[text]) for part, rs in zip(("header", "data"), parse(t or "")) for r, row in enumerate(rs) for c, v in enumerate(row)]
            yield pd.DataFrame(out, columns=[id_col, "part", "row", "col", "value"])

    return docs.select(id_col, text).mapInPandas(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, part string, row int, col int, value string")


# --- tables that a plotting package reads from a file -------------------------------------------------------------------


def option(options: str, key: str) -> str:
    """Value of a key in a comma-separated option list, without the braces around it; empty if there is none."""
    for part in split_level(options, ","):
        name, found, value = part.partition("=")
        if found and name.strip() == key:
            value = value.strip()
            return value[1:-1].strip() if value.startswith("{") and closing(value, 0) == len(value) - 1 else value
    return ""


def _arguments(text: str, at: int) -> tuple[str, str | None, int]:
    """Bracketed options, braced argument (None without one) and the end of both, from a place after a command."""
    skip = lambda i: i + len(text[i:]) - len(text[i:].lstrip())
    at, options = skip(at), ""
    if text[at : at + 1] == "[":
        end = closing(text, at, "]")
        if end < 0:
            return "", None, at + 1
        options, at = text[at + 1 : end], skip(end + 1)
    if text[at : at + 1] != "{" or (end := closing(text, at)) < 0:
        return options, None, at
    return options, text[at + 1 : end].strip(), end + 1


def reads(source: str) -> list[tuple[str, str, str]]:
    """(macro, path, options) of every file that a source reads into a macro, in order."""
    text, out = uncommented(source), []
    for m in re.finditer(r"\\pgfplotstableread(?![A-Za-z@])", text):
        options, path, end = _arguments(text, m.end())
        into = re.match(r"\s*\{?\\([A-Za-z@]+)", text[end:])
        if path is not None and into:
            out.append((into.group(1), path, options))
    return out


def plotted_table(excerpt: str, source: str, files: dict[str, str]) -> tuple[list[str], list[list[str]], str]:
    """Header, rows and error of the table that an excerpt typesets from a macro. files: texts by path; source: what stands before
    the excerpt. The last read of the macro counts."""
    text = uncommented(excerpt)
    m = re.search(r"\\pgfplotstabletypeset(?![A-Za-z@])", text)
    if not m:
        return [], [], "no table is typeset from a file"
    options, name, _ = _arguments(text, m.end())
    if name is None:
        return [], [], "the source argument is missing"
    macro = name.lstrip("\\")
    found = [r for r in reads(source) if r[0] == macro]
    if not found:
        return [], [], f"nothing is read into {macro}"
    _, path, how = found[-1]
    if path not in files:
        return [], [], f"no such data file: {path}"
    mark = {"semicolon": ";", "space": " ", "spaces": " ", "tab": "\t"}.get(option(how, "col sep").lower(), ",")
    lines = list(csv.reader(files[path].splitlines(), delimiter=mark, skipinitialspace=True))
    if not lines or not lines[0]:
        return [], [], f"no header row: {path}"
    names = lines[0]
    chosen = [c.strip() for c in split_level(option(options, "columns"), ",") if c.strip()] or names
    if missing := [c for c in chosen if c not in names]:
        return [], [], f"no such columns: {', '.join(missing)}"
    titles = {}
    for s in re.finditer(r"columns/([^/\s{}]+)/\.style\s*=\s*(?=\{)", options):
        style = options[s.end() + 1 : closing(options, s.end())]
        if title := option(style, "column name"):
            titles[s.group(1)] = clean_cell(title)
    place = [names.index(c) for c in chosen]
    data = [[row[i] if i < len(row) else "" for i in place] for row in lines[1:] if row]
    return [titles.get(c, c) for c in chosen], data, ""


def plotted_rows(tables: DataFrame, id_col: str, excerpt: str, source: str, files: str) -> DataFrame:
    """id, header, rows (arrays of texts) and error of each table; files: map<path, text>. Converted where the row is."""

    def run(batches):
        for pdf in batches:
            made = [plotted_table(e or "", s or "", dict(f) if f is not None else {}) for e, s, f in zip(pdf[excerpt], pdf[source], pdf[files])]
            yield pd.DataFrame({id_col: pdf[id_col], "header": [m[0] for m in made], "rows": [m[1] for m in made], "error": [m[2] for m in made]})

    return tables.select(id_col, excerpt, source, files).mapInPandas(run, f"`{id_col}` {tables.schema[id_col].dataType.simpleString()}, header array<string>, rows array<array<string>>, error string")


def columns_of(header: Column, rows_: Column, names: Column | None = None) -> Column:
    """array<struct<name, original_header, unit_text, data_type>> of a parsed table: header rows joined by bars, the first cell that
    looks like a unit, and the type of the cells below. Without names columns are col_001 and so on."""
    n = F.array_max(F.transform(F.concat(header, rows_), lambda r: F.size(r)))

    def one(i: Column) -> Column:
        titles = F.filter(F.transform(header, lambda r: F.coalesce(F.get(r, i), F.lit(""))), lambda v: v != "")
        unit = F.coalesce(F.get(F.filter(titles, numbers.unit_like), F.lit(0)), F.lit(""))
        name = F.format_string("col_%03d", i + 1) if names is None else F.get(names, i)
        cells = F.transform(F.filter(rows_, lambda r: i < F.size(r)), lambda r: F.get(r, i))
        return F.struct(name.alias("name"), F.array_join(titles, " | ").alias("original_header"), unit.alias("unit_text"), numbers.column_type(cells).alias("data_type"))

    none = F.array().cast("array<struct<name:string,original_header:string,unit_text:string,data_type:string>>")
    return F.when(F.coalesce(n, F.lit(0)) > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), one)).otherwise(none)


def macros_left(rows_: Column) -> Column:
    """Commands that cleaning has left in cells, each once, sorted."""
    found = F.flatten(F.transform(F.flatten(rows_), lambda v: F.regexp_extract_all(v, F.lit(r"(\\[A-Za-z@]+)"), F.lit(1))))
    return F.array_sort(F.array_distinct(found))


def converted(attempts: list[tuple[str, Column, Column]]) -> Column:
    """struct<method, rows, log> of a cascade of converters (name, rows or null, error): the first that gave rows, and what each
    attempt before it said."""
    method, rows_, log = F.lit(None).cast("string"), None, []
    for name, got, error in reversed(attempts):
        method = F.when(got.isNotNull(), name).otherwise(method)
    rows_ = F.coalesce(*(got for _, got, _ in attempts))
    done = F.lit(False)
    for name, got, error in attempts:
        log.append(F.when(~done, F.concat(F.lit(f"{name}: "), F.when(got.isNotNull(), "success").otherwise(F.coalesce(error, F.lit("failed"))))))
        done = done | got.isNotNull()
    return F.struct(method.alias("method"), rows_.alias("rows"), F.array_compact(F.array(*log)).alias("log"))
