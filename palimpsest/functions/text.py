"""Scalar column functions over text, dates and identifiers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Unicode white space as Python's ``\s`` has it; Java needs the flag.
_SPACES = r"(?U)\s+"
# Date layouts in the order they are tried (day before month where both read), and the token looked for else.
DATE_FORMATS = ("yyyy-M-d", "yyyy/M/d", "yyyy.M.d", "d/M/yyyy", "M/d/yyyy", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "yyyy-M-d H:m:s")
DATE_TOKEN = r"\b((?:19|20)\d{2})[-/.](\d{1,2})[-/.](\d{1,2})\b"


def clean_text(col: Column) -> Column:
    """White space collapsed and trimmed; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(col, F.lit("")), _SPACES, " "))


def text_or_null(col: Column) -> Column:
    return F.nullif(clean_text(col), F.lit(""))


def word_count(col: Column) -> Column:
    return F.regexp_count(F.coalesce(col, F.lit("")), F.lit(r"(?U)\S+"))


def stable_id(prefix: str, *parts: Column) -> Column:
    """``prefix:`` and 24 hex digits of SHA-256 over the trimmed, lower-cased, non-blank parts."""
    clean = F.filter(F.array(*(F.lower(F.trim(p.cast("string"))) for p in parts)), lambda x: x.isNotNull() & (x != ""))
    return F.concat(F.lit(f"{prefix}:"), F.substring(F.sha2(F.array_join(clean, "\x1f"), 256), 1, 24))


def search_key(col: Column) -> Column:
    return F.sha2(col, 256)


def normalize_date(col: Column) -> Column:
    """ISO date of text in any of DATE_FORMATS, the first that reads, else of the first date token in it; null else."""
    day = F.trim(F.substring_index(clean_text(col), "T", 1))
    token = F.concat_ws("-", *(F.regexp_extract(day, DATE_TOKEN, i) for i in (1, 2, 3)))
    return F.date_format(F.coalesce(*(F.try_to_date(day, f) for f in DATE_FORMATS), F.try_to_date(token, "yyyy-M-d")), "yyyy-MM-dd")


def validate_date(col: Column) -> Column:
    """yyyy-MM-dd of year, month and day, a day past the month's end set to its last; null if they aren't three such numbers."""
    y, m, d = (F.regexp_extract(col, r"^(\d{1,4})-(\d{1,9})-(\d{1,9})$", i).try_cast("int") for i in (1, 2, 3))
    good = (y >= 1) & m.between(1, 12) & (d >= 1)
    first = F.make_date(F.when(good, y), F.when(good, m), F.lit(1))
    return F.date_format(F.date_add(first, F.least(d, F.day(F.last_day(first))) - 1), "yyyy-MM-dd")


def source_regions(col: Column) -> Column:
    """All ``D(page,x,y,...)`` as (page, polygon); the polygon is null unless every number reads."""
    pattern = F.lit(r"D\((\d+),([^)]*)\)")
    pages, points = F.regexp_extract_all(col, pattern, F.lit(1)), F.regexp_extract_all(col, pattern, F.lit(2))

    def region(z: Column) -> Column:
        numbers = F.transform(F.split(z["p"], ","), lambda x: F.trim(x).try_cast("double"))
        return F.struct(z["n"].cast("int").alias("page"), F.when(~F.exists(numbers, lambda x: x.isNull()), numbers).alias("polygon"))

    return F.transform(F.arrays_zip(pages.alias("n"), points.alias("p")), region)


def source_pages(col: Column) -> Column:
    """The page of every region of ``source_regions``, whose polygons aren't read."""
    return F.regexp_extract_all(col, F.lit(r"D\((\d+),([^)]*)\)"), F.lit(1)).cast("array<int>")


def element_pointer(col: Column) -> Column:
    """(kind, index) of ``/tables/3`` and the like; nulls else."""
    shape = r"^/(paragraphs|sections|tables|figures|hyperlinks)/(\d+)$"
    return F.struct(
        F.nullif(F.regexp_extract(col, shape, 1), F.lit("")).alias("kind"), F.regexp_extract(col, shape, 2).try_cast("int").alias("index")
    )


def natural_order(col: Column) -> list[Column]:
    """Sort keys: numbers first by value, then all else without case."""
    return [F.when(col.rlike(r"^[0-9]+$"), 0).otherwise(1), F.when(col.rlike(r"^[0-9]+$"), col.try_cast("decimal(38,0)")), F.lower(col), col]


def page_label(start: Column, end: Column) -> Column:
    return (
        F.when(start.isNull(), "page unknown")
        .when(end.isNull() | (end == start), F.concat(F.lit("page "), start.cast("string")))
        .otherwise(F.concat(F.lit("pages "), start.cast("string"), F.lit("-"), end.cast("string")))
    )


def excerpt(col: Column, size: int = 320) -> Column:
    return F.substring(clean_text(col), 1, size)


def preview(col: Column, size: int = 300) -> Column:
    flat = F.regexp_replace(F.coalesce(col, F.lit("")), "\n", " ")
    return F.when(F.length(flat) > size, F.concat(F.substring(flat, 1, size - 3), F.lit("..."))).otherwise(flat)


def csv_cell(col: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(F.coalesce(col, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))


def ngrams(tokens: Column, n: int) -> Column:
    """Distinct runs of ``n`` tokens; empty for shorter arrays."""
    def runs(w: Column) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) >= n, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))

    # through a lambda, so that the tokens are made once and not once a run
    return F.element_at(F.transform(F.array(tokens), runs), 1)


def usage_meter(*spellings: Column) -> Column:
    """The first spelling that reads as a number, never below zero."""
    return F.greatest(F.coalesce(*(c.try_cast("double") for c in spellings), F.lit(0.0)), F.lit(0.0))


def retry_delay(attempt: Column, hint: Column, base: float, most: float) -> Column:
    """Seconds to wait: the server's hint, else doubling from ``base`` up to ``most``."""
    return F.least(F.coalesce(hint.try_cast("double"), F.lit(base) * F.pow(F.lit(2.0), attempt - 1)), F.lit(most))


# What speaks for a keyword search.
QUOTED = "[\"\u201c][^\"\u201d]{3,}[\"\u201d]"
RECORD_CODE = r"\b[A-Z]{1,5}[- ]?\d{4,}\b"


def preferred_mode(col: Column) -> Column:
    """keyword for quoted phrases and record codes, hybrid else."""
    return F.when(col.rlike(QUOTED) | col.rlike(RECORD_CODE), "keyword").otherwise("hybrid")


def clean_list(col: Column) -> Column:
    """The distinct trimmed values of an array, without blanks, in their order."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(col, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != ""))


def capped_list(col: Column, most: int) -> Column:
    return F.slice(clean_list(col), 1, most)


def first_text(col: Column) -> Column:
    """The first element of an array that isn't blank, trimmed; null if none is."""
    return F.get(F.filter(F.transform(col, lambda x: F.trim(x)), lambda x: x != ""), F.lit(0))


def span_overlap(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Whether the half-open spans have a position in common."""
    return (start_a < end_b) & (start_b < end_a)


def json_object(col: Column) -> Column:
    """The map of a JSON object's members as text; empty for anything else."""
    read = F.from_json(F.when(F.try_parse_json(col).isNotNull() & F.ltrim(col).startswith("{"), col), "map<string,string>")
    return F.coalesce(read, F.create_map().cast("map<string,string>"))


# The tokens of evaluation, and what markdown loses before it.
TOKEN = "[\\p{L}\\p{N}]+(?:[-\u2019'][\\p{L}\\p{N}]+)*"
MARKDOWN = (
    (r"(?s)<!--.*?-->", " "),
    (r"(?i)</?(?:table|thead|tbody|tfoot|tr|td|th|br)(?:\s[^>]*)?/?>", " "),
    (r"!\[[^\]]*\]\([^)]*\)", " "),
    (r"\[([^\]]+)\]\([^)]*\)", "$1"),
)


def word_tokens(col: Column) -> Column:
    """Lower-cased words, joined over hyphens and apostrophes; curly apostrophes are made straight."""
    found = F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(f"({TOKEN})"), F.lit(1))
    return F.transform(found, lambda x: F.replace(F.lower(x), F.lit("\u2019"), F.lit("'")))


def markdown_tokens(col: Column) -> Column:
    """Tokens of markdown without comments, table tags and images; of links the text stays, common entities are read."""
    for pattern, put in MARKDOWN:
        col = F.regexp_replace(col, pattern, put)
    for name, mark in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        col = F.replace(col, F.lit(name), F.lit(mark))
    return word_tokens(col)


# Words of a query that aren't marked in a text.
UNMARKED = "and or the a an to of in on for with what where when who how is are was were".split()


def highlight_terms(col: Column, most: int = 16) -> Column:
    """Quoted phrases, then words of more than a letter, distinct, the longest first, at most ``most``."""
    phrases = F.transform(F.regexp_extract_all(col, F.lit('"([^"]+)"'), F.lit(1)), lambda x: F.trim(x))
    words = F.filter(F.split(F.regexp_replace(col, '"[^"]+"', " "), r"[^\p{L}\p{N}-]+"), lambda w: (F.length(w) > 1) & ~F.lower(w).isin(UNMARKED))
    every = F.array_distinct(F.concat(phrases, words))
    keyed = F.transform(every, lambda x, i: F.struct((-F.length(x)).alias("n"), i.alias("i"), x.alias("x")))
    return F.slice(F.transform(F.array_sort(keyed), lambda s: s["x"]), 1, most)


def table_cells(col: Column) -> Column:
    """Rows of cells of tab-separated lines; null if no line has two."""
    rows = F.transform(F.split(col, "\n"), lambda r: F.split(r, "\t"))
    return F.when(F.exists(rows, lambda r: F.size(r) > 1), rows)


def duration(seconds: Column) -> Column:
    """``2h 03m 04s`` or ``3m 04s``; "unknown" for what isn't a number."""
    told = seconds.try_cast("double")
    n = F.greatest(F.floor(told), F.lit(0)).cast("long")
    h, m, s = F.floor(n / 3600), F.floor(n % 3600 / 60), n % 60
    return F.when(told.isNull(), "unknown").when(h > 0, F.format_string("%dh %02dm %02ds", h, m, s)).otherwise(F.format_string("%dm %02ds", m, s))


def counter(done: Column, total: Column, width: int = 2) -> Column:
    """``[007/120]``: both as wide as the wider, of ``width`` digits at least; ``?`` for an unknown total."""
    digits = lambda c: F.length(F.greatest(c, F.lit(0)).cast("string"))
    w = F.greatest(F.lit(width), digits(done), F.coalesce(digits(total), F.lit(0)))
    shown = F.coalesce(F.lpad(total.cast("string"), w, F.lit("0")), F.repeat(F.lit("?"), w))
    return F.concat(F.lit("["), F.lpad(done.cast("string"), w, F.lit("0")), F.lit("/"), shown, F.lit("]"))


def reported_total(col: Column) -> Column:
    """N of ``Item(s) - a to b out of about N,NNN``; null else."""
    found = F.regexp_extract(col, r"(?i)Item\(s\)\s*-\s*[\d,]+\s*to\s*[\d,]+\s*out of about\s*([\d,]+)", 1)
    return F.replace(found, F.lit(","), F.lit("")).try_cast("long")


def expected_pages(total: Column, size: int, limit: Column | None = None) -> Column:
    """Pages of ``size`` that hold min(total, limit) rows, one at least; null for an unknown total."""
    wanted = F.greatest(F.least(total, limit) if limit is not None else total, F.lit(0))
    return F.when(total.isNotNull(), F.greatest(F.ceil(wanted / size), F.lit(1)))


def retry_after(col: Column, now: Column) -> Column:
    """Seconds to wait by a header of seconds or of an HTTP date, never below zero; null if it is neither."""
    until = F.try_to_timestamp(F.regexp_replace(col, r"^\w{3},\s*|\s*GMT$", ""), F.lit("dd MMM yyyy HH:mm:ss"))
    return F.greatest(F.coalesce(col.try_cast("double"), (F.unix_timestamp(until) - F.unix_timestamp(now)).cast("double")), F.lit(0.0))


def safe_filename(col: Column) -> Column:
    """The last part of a decoded path, odd characters as underscores, no dots or underscores at the ends, 240 characters at most."""
    name = F.regexp_extract(F.try_url_decode(F.trim(col)), r"([^/]*)/*$", 1)
    return F.substring(F.regexp_replace(F.regexp_replace(name, r"[^A-Za-z0-9._ ()-]+", "_"), r"^[._]+|[._]+$", ""), 1, 240)


def disposition_filename(col: Column) -> Column:
    """The file name that a Content-Disposition header gives; empty if none."""
    return F.coalesce(safe_filename(F.regexp_extract(col, r"(?i)filename\*?=(?:UTF-8'')?\"?([^\";]+)", 1)), F.lit(""))


def embedding_text(title: Column, heading: Column, content: Column, most: int = 24_000) -> Column:
    """Title, heading and content joined by blank lines, cut at ``most`` characters."""
    parts = F.filter(F.array(*(F.trim(F.coalesce(c, F.lit(""))) for c in (title, heading, content))), lambda x: x != "")
    return F.nullif(F.trim(F.substring(F.array_join(parts, "\n\n"), 1, most)), F.lit(""))


def error_id_valid(col: Column, prefix: str) -> Column:
    return F.coalesce(col.rlike(f"^{prefix}-[A-F0-9]{{16}}$"), F.lit(False))


def content_path(digest: Column, *above: Column, suffix: str = ".json") -> Column:
    """``above/ab/abcd....json``: where content is kept by its digest."""
    return F.concat(F.concat_ws("/", *above, F.substring(digest, 1, 2), digest), F.lit(suffix))


def portable_path(col: Column, root: str) -> Column:
    """Below ``root`` the path relative to it, with forward slashes; other paths as they are."""
    flat = F.replace(col, F.lit("\\"), F.lit("/"))
    return F.when(flat.startswith(root.rstrip("/") + "/"), F.substr(flat, F.lit(len(root.rstrip("/")) + 2))).otherwise(flat)


def absolute_path(col: Column, root: str) -> Column:
    return F.when(col.startswith("/"), col).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), col))


def rate_per_thousand(col: Column) -> Column:
    """A rate of text such as ``$1,200.50``; null if it doesn't read or is negative."""
    value = F.regexp_replace(col, r"[$,\s]", "").try_cast("double")
    return F.when(value >= 0, value)


def highlighted(text: Column, terms: Column) -> Column:
    """(text, hit) of the parts of a text, in order: those that are one of ``terms``, in any case of letters, and what lies between.

    Terms are taken as they are written; of terms that begin at one place the longest counts.  Parts are never empty, and
    together they are the text; without terms it is one part.  Null texts have no parts.
    """
    longest = F.array_sort(F.filter(F.coalesce(terms, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != "")), lambda a, b: F.length(b) - F.length(a))
    quoted = F.transform(longest, lambda x: F.regexp_replace(x, r"([^\p{L}\p{N}\s])", r"\\$1"))
    marked = F.when(F.size(longest) > 0, F.regexp_replace(text, F.concat(F.lit("(?iu)("), F.array_join(quoted, "|"), F.lit(")")), F.lit("\x01$1\x01"))).otherwise(text)
    parts = F.transform(F.split(marked, "\x01"), lambda x, i: F.struct(x.alias("text"), (i % 2 == 1).alias("hit")))
    return F.coalesce(F.filter(parts, lambda p: p["text"] != ""), F.expr("CAST(array() AS array<struct<text:string,hit:boolean>>)"))


@F.pandas_udf(T.BinaryType())
def _packed(vectors: pd.Series) -> pd.Series:
    return vectors.map(lambda v: None if v is None else np.asarray(v, "<f4").tobytes())


def packed_floats(vector: Column) -> Column:
    """A vector as 32-bit floats, low byte first; null of null and of a vector with a null in it."""
    return _packed(F.when(~F.exists(vector, lambda x: x.isNull()), vector))


@F.pandas_udf(T.ArrayType(T.FloatType()))
def unpacked_floats(blobs: pd.Series, dimensions: pd.Series) -> pd.Series:
    """The vector of a blob of 32-bit floats; null of null and of another size than ``dimensions`` floats have."""
    return pd.Series([None if b is None or n is None or pd.isna(n) or len(b) != 4 * int(n) else np.frombuffer(b, "<f4") for b, n in zip(blobs, dimensions)], dtype=object)
