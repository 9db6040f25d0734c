"""Text functions as column expressions: clipping, file names, links, windows, chunks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lectern.functions.coerce import strip

#: Identifiers and addresses of deposited data, in order of precedence; group 1 is the value. Fixed patterns.
ACCESSIONS = [
    r"(?i)dbGaP\s*(phs\d+(\.v\d+(\.p\d+)?)?)",
    r"(?i)\b(phs\d{6}(\.v\d+\.p\d+)?)\b",
    r"(?i)\b(GSE\d{4,})\b",
    r"(?i)\b(PRJ[E|N][A-Z]?\d{4,})\b",
    r"(?i)\b(ENA[:\s]*PRJ\w+)\b",
    r"(?i)(https?://(?:dx\.)?doi\.org/10\.5281/zenodo\.\d+)",
    r"(?i)(https?://zenodo\.org/(?:record/|records/)?\d+)",
    r"(?i)(https?://github\.com/[\w.-]+/[\w.-]+(?:-[\w.-]+)*)",
    r"(?i)(https?://figshare\.com/\S+)",
    r"(?i)(https?://datadryad\.org/\S+)",
    r"(?i)\b(ArrayExpress\s*E-[A-Z]{4}-\d+)\b",
]
#: What a text must hold in lower case for a pattern of ACCESSIONS to match: a plain search spares most texts the pattern.
HINTS = ["dbgap", "phs", "gse", "prj", "prj", "zenodo.", "zenodo.org", "github.com", "figshare.com", "datadryad.org", "arrayexpress"]
#: Headings of a data availability section. A fixed pattern.
AVAILABILITY_HEADING = r"(?i)(?:data\s+(?:and\s+code\s+)?(?:availability|accessing)|code\s+availability)"
#: Lead-ins of a sentence on deposited data. A fixed pattern.
EVIDENCE = r"(?i)(?:deposit|publicly available|accessible|available at|data availability)[^\n.]{0,160}"
#: Words that make a quoted sentence one on data. A fixed pattern.
DATA_WORDS = r"(?i)data|deposit|repository|available|accession|zenodo|github|supplement"
#: Names of supplementary files. A fixed pattern.
SUPPLEMENTARY = r"(?i)(suppl?e?m?e?n?t?|supp?\d|_s\d+[\._]|[-_]s\d+\.pdf$|app\d+|appendix|fig(ure)?\d*|table\d*)"


def clip(text: Column, width: int) -> Column:
    """A table cell: bars become slashes; a longer text ends at a word within width, with an ellipsis; empty is a dash."""
    cell = strip(F.replace(text, F.lit("|"), F.lit("/")))
    head = F.left(cell, F.lit(width))
    cut = F.when(F.contains(head, F.lit(" ")), F.regexp_replace(head, " [^ ]*$", "")).otherwise(head)
    whole = F.when(cell == "", "—").otherwise(cell)
    return F.when(F.length(cell) <= width, whole).otherwise(F.concat(F.regexp_replace(cut, "[ ,;:.-]+$", ""), F.lit("…")))


def escape_bars(text: Column) -> Column:
    return F.replace(text, F.lit("|"), F.lit("\\|"))


def escape_html(text: Column) -> Column:
    out = text
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(plain), F.lit(entity))
    return out


def fill_template(template: Column, values: dict[str, Column]) -> Column:
    """The template with each %%NAME%% replaced."""
    out = template
    for name, value in values.items():
        out = F.replace(out, F.lit(f"%%{name}%%"), value)
    return out


def file_stem(text: Column, longest: int = 80) -> Column:
    """Letters, digits, underscores, hyphens; blanks become underscores; cut to longest."""
    return F.left(F.regexp_replace(strip(F.regexp_replace(text, r"[^\w\s-]", "")), r"\s+", "_"), F.lit(longest))


def stem_of(path: Column) -> Column:
    """File name without folders and the last suffix."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")


def pmcid_in_path(path: Column) -> Column:
    """The first PMC number in a file's stem, else the stem."""
    stem = stem_of(path)
    return F.coalesce(F.nullif(F.regexp_extract(stem, r"(PMC\d+)", 1), F.lit("")), stem)


def https(url: Column) -> Column:
    """An FTP address as HTTPS; only the first occurrence."""
    return F.regexp_replace(url, "^(.*?)ftp://", "$1https://")


#: A word broken after a hyphen, and any hyphen before a line break. Fixed patterns.
WRAPPED_WORD = r"(\w)\s*-\s*\n\s*(\w)"
WRAPPED = r"-\s*\n\s*"


def unwrap(text: Column) -> Column:
    """Addresses that a line break split at a hyphen made whole."""
    whole = F.regexp_replace(F.regexp_replace(text, WRAPPED_WORD, "$1-$2"), WRAPPED, "")
    # most texts have no hyphen before a line break, which is far cheaper to see than to replace
    return F.when(F.contains(text, F.lit("\n")) & text.rlike(WRAPPED), whole).otherwise(text)


def accession_links(text: Column) -> Column:
    """Identifiers and addresses of deposited data, pattern by pattern, each once, case kept."""
    whole = unwrap(text)
    lower, none = F.lower(whole), F.array().cast("array<string>")
    # a null text gives null, as the patterns would
    found = [F.when(F.contains(lower, F.lit(hint)), F.regexp_extract_all(whole, F.lit(p), F.lit(1))).when(whole.isNotNull(), none) for p, hint in zip(ACCESSIONS, HINTS, strict=True)]
    return F.array_distinct(F.transform(F.concat(*found), strip))


def availability_window(text: Column, size: int = 6000, lead: int = 200) -> Column:
    """The part of a text around its data availability heading, else its tail."""
    # a heading holds one of two words; most texts hold neither
    lower = F.lower(text)
    at = F.when(F.contains(lower, F.lit("availability")) | F.contains(lower, F.lit("accessing")), F.regexp_instr(text, F.lit(AVAILABILITY_HEADING))).otherwise(0)
    start = F.greatest(at - lead, F.lit(1))
    return F.when(at > 0, F.substring(text, start, F.lit(size))).otherwise(F.right(text, F.lit(size)))


def evidence(text: Column, longest: int = 300) -> Column:
    """The first phrase on deposited data, null if there is none."""
    return F.nullif(F.left(strip(F.regexp_extract(text, EVIDENCE, 0)), F.lit(longest)), F.lit(""))


def quoted_statements(text: Column, most: int = 3) -> Column:
    """The first quoted sentences of 20 to 500 characters that speak of data, joined."""
    spans = F.regexp_extract_all(text, F.lit('"([^"]*)"'), F.lit(1))
    fit = F.filter(spans, lambda x: F.length(x).between(20, 500) & x.rlike(DATA_WORDS))
    return F.array_join(F.transform(F.slice(fit, 1, most), strip), " ")


def chunks(text: Column, size: int = 4000, overlap: int = 600) -> Column:
    """The trimmed text in pieces of size that overlap; a text no longer than size is one piece."""
    body = strip(text)
    stride = size - overlap
    last = F.greatest(F.ceil((F.length(body) - size) / stride).cast("int"), F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(body, i * stride + 1, F.lit(size)))


def percent(count: Column, total: Column) -> Column:
    """100 count / total to one place, half to even; 0 for no total."""
    return F.when(total == 0, F.lit(0.0)).otherwise(F.bround(F.lit(100.0) * count / total, 1))
