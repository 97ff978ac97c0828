"""Quality rules (operator 8): line-first cleaning.

Every line with a word is judged on its own (punctuation, navigation, boilerplate, symbols);
failing lines are removed, and a document that loses too much of its text, or whose counts
fail the base rules, is rejected.  Navigation marks and boilerplate phrases count by their share of
the line's words, so a long paragraph isn't lost to one of them.

Defined results: null text counts as empty (no words, all counts 0, rejected, clean_text "");
rows are judged one by one, so repeated rows and null ids pass through; extra columns are kept
out of the result except those named in ``keep``; texts of any length are judged whole; an empty table
gives none.  Work is one Arrow pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.common import bound_batches, sliced, table

#: Phrases of boilerplate by language (compared after lower-casing, at word bounds).
BOILERPLATE = {
    "en": (
        "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie policy", "accept cookies", "uses cookies",
        "enable javascript", "javascript is disabled", "skip to content", "click here", "read more", "sign up", "log in", "lorem ipsum",
    ),
    "de": (
        "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "allgemeine geschäftsbedingungen", "cookies akzeptieren",
        "verwendet cookies", "javascript aktivieren", "zum inhalt springen", "hier klicken", "mehr lesen", "weiterlesen", "jetzt registrieren", "impressum",
    ),
    "fr": (
        "tous droits réservés", "politique de confidentialité", "conditions d'utilisation", "conditions générales", "accepter les cookies",
        "utilise des cookies", "activer javascript", "aller au contenu", "cliquez ici", "lire la suite", "s'inscrire", "se connecter", "mentions légales",
    ),
    "es": (
        "todos los derechos reservados", "política de privacidad", "términos de uso", "condiciones de uso", "aceptar cookies", "utiliza cookies",
        "activar javascript", "saltar al contenido", "haga clic aquí", "haz clic aquí", "leer más", "seguir leyendo", "iniciar sesión", "aviso legal",
    ),
}
#: A line ends in one of these, at its last word or the one before (a signature or an address may follow).
TERMINAL = ".!?…:;\"'”’“»«)]。！？；：．｡؟।။።"
#: Marks between entries of a menu: the first anywhere, the others where they stand alone; » not as the end of a quotation.
BAR, ALONE = "|", "›•·"
ODD = "!?#*$%&|<>"


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the line rules and of the document verdict."""

    min_words: int = 50
    max_repeat_percent: int = 50
    nav_marks: int = 2
    #: Marks, and words of boilerplate phrases, by the words of their line from which on the line fails.
    nav_percent: int = 20
    boilerplate_percent: int = 20
    max_odd_percent: int = 15
    max_lost_percent: int = 50
    phrases: tuple[str, ...] = tuple(p for own in BOILERPLATE.values() for p in own)


_WORDS = re.compile(r"[^ \t-\r]+")
_ODD = re.compile("[" + re.escape(ODD) + "]")
_SYMBOL = re.compile(r"[#*$%&|<>]")


@lru_cache(maxsize=1000)
def _at_bounds(phrase: str) -> re.Pattern:
    return re.compile(rf"(?<![^\W_]){re.escape(phrase)}(?![^\W_])")


def line_fails(line: str, words: list[str], rules: LineRules) -> bool:
    """The verdict on one line that has a word."""
    if 100 * len(_ODD.findall(line)) > rules.max_odd_percent * sum(map(len, words)):
        return True
    if not any(w[-1] in TERMINAL for w in words[-2:]):
        return True
    marks = line.count(BAR) + max(0, words.count("»") - words.count("«"))
    marks += sum(w in ALONE for w in words if len(w) == 1)
    if marks >= rules.nav_marks and 100 * marks >= rules.nav_percent * len(words):
        return True
    low = line.lower()
    told = sum(len(p.split()) for p in rules.phrases if p in low and _at_bounds(p).search(low))
    return told > 0 and 100 * told >= rules.boilerplate_percent * len(words)


def repeated_window_words(words: list[str]) -> int:
    """Words covered by 3-word windows that occur at least twice in ``words``."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[str, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    size = len(ids)
    if size < 2_000_000:  # three ids fit into 63 bits
        key = (w[:-2] * size + w[1:-1]) * size + w[2:]
    else:
        pair = np.unique(w[:-2] * size + w[1:-1], return_inverse=True)[1]
        key = pair * size + w[2:]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[k : n - 2 + k] |= twice
    return int(hit.sum())


def judge(text: str | None, rules: LineRules) -> tuple:
    """Counts, verdicts and the cleaned text of one whole text."""
    text = text or ""
    words: list[str] = []
    seen: set[str] = set()
    kept_lines: list[str] = []
    n_dup = lost = 0
    for line in text.split("\n"):
        own = _WORDS.findall(line)
        if not own:
            continue
        words += own
        if line in seen:
            n_dup += 1
        else:
            seen.add(line)
        if line_fails(line, own, rules):
            lost += sum(map(len, own))
        else:
            kept_lines.append(line)
    chars, n = sum(map(len, words)), len(words)
    repeat = repeated_window_words(words)
    base_failed = n < rules.min_words or 100 * repeat > rules.max_repeat_percent * n
    kept = not base_failed and 100 * lost <= rules.max_lost_percent * chars
    return n, chars, len(_SYMBOL.findall(text)), n_dup, repeat, base_failed, kept, lost, "\n".join(kept_lines)


_RESULT = [
    ("n_words", T.LongType(), pa.int64()),
    ("word_chars", T.LongType(), pa.int64()),
    ("n_symbols", T.LongType(), pa.int64()),
    ("n_dup_lines", T.LongType(), pa.int64()),
    ("n_repeat_words", T.LongType(), pa.int64()),
    ("base_failed", T.BooleanType(), pa.bool_()),
    ("kept", T.BooleanType(), pa.bool_()),
    ("lost_chars", T.LongType(), pa.int64()),
    ("clean_text", T.StringType(), pa.string()),
]


def line_quality(
    docs: DataFrame,
    *,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    rules: LineRules = LineRules(),
    with_text: bool = True,
) -> DataFrame:
    """``docs``' columns ``keep`` with every count, both verdicts and (if asked) the cleaned text.

    Columns of ``docs`` outside ``keep`` and ``text_col`` are never read, so clashing names don't matter.
    """
    bound_batches(docs.sparkSession)
    result = _RESULT if with_text else _RESULT[:-1]
    source = docs.select(*(F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)), F.col(text_col).alias("own_text"))
    schema = T.StructType([*source.schema.fields[:-1], *(T.StructField(n, t) for n, t, _ in result)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = [judge(x, rules) for x in batch.column(len(keep)).to_pylist()]
            columns = list(zip(*rows)) if rows else [()] * len(_RESULT)
            arrays = [batch.column(i) for i in range(len(keep))]
            arrays += [pa.array(columns[i], kind) for i, (_, _, kind) in enumerate(result)]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in schema.fields])

    out = source.mapInArrow(run, schema)
    return out.select(*(F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)), *(n for n, _, _ in result))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(table(spark, sf_dir, "documents"), with_text=False)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rejected documents go (null and word-free ones are), failing lines of the others go; rows with null or repeated ids are judged each for itself; an empty table gives none."""
    out = line_quality(docs, keep=("doc_id", "lang", "source")).where("kept")
    return out.select("doc_id", F.col("clean_text").alias("text"), "lang", "source", F.length("clean_text").cast("long").alias("n_chars"))


def oracle_sql(rules: LineRules = LineRules()) -> str:
    """The same counts and verdicts in DuckDB SQL."""
    quote = lambda x: x.replace("'", "''")
    edge = r"[^\p{L}\p{N}]"
    told = " + ".join(
        f"CASE WHEN contains(low, '{quote(p)}') AND regexp_matches(low, '(^|{edge}){quote(p)}($|{edge})') THEN {len(p.split())} ELSE 0 END" for p in rules.phrases
    )
    ends = quote("".join("\\" + c if c in ")].?" else c for c in TERMINAL))
    odd = "".join("\\" + c if c in "?*$|" else c for c in ODD)
    alone = ", ".join(f"'{c}'" for c in ALONE)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '{WORD_SQL}') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD_SQL}')) AS ls FROM d),
lines AS (SELECT rid, unnest(ls) AS line FROM w),
told AS (SELECT rid, line, lw, {told} AS told,
    length(line) - length(replace(line, '{BAR}', '')) + len(list_filter(lw, lambda x: x IN ({alone})))
        + greatest(0, len(list_filter(lw, lambda x: x = '»')) - len(list_filter(lw, lambda x: x = '«'))) AS marks
    FROM (SELECT rid, line, lower(line) AS low, regexp_extract_all(line, '{WORD_SQL}') AS lw FROM lines)),
judged AS (SELECT rid, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
    marks >= {rules.nav_marks} AND 100 * marks >= {rules.nav_percent} * len(lw)
    OR 100 * (length(line) - length(regexp_replace(line, '[{odd}]', '', 'g')))
       > {rules.max_odd_percent} * length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))
    OR NOT regexp_matches(line, '[{ends}]([\x20\x09-\x0D]+[^\x20\x09-\x0D]+)?[\x20\x09-\x0D]*$')
    OR told > 0 AND 100 * told >= {rules.boilerplate_percent} * len(lw) AS fails FROM told),
lost AS (SELECT rid, sum(CASE WHEN fails THEN chars ELSE 0 END) AS lost_chars FROM judged GROUP BY rid),
pos AS (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM w WHERE len(ws) >= 3),
win AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i], ws[i + 1], ws[i + 2]) AS n FROM pos),
rep AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM win WHERE n > 1) GROUP BY rid),
base AS (SELECT w.rid, doc_id, len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.lost_chars, 0)::BIGINT AS lost_chars
    FROM w LEFT JOIN rep USING (rid) LEFT JOIN lost USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed,
    NOT (n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words)
    AND 100 * lost_chars <= {rules.max_lost_percent} * word_chars AS kept,
    lost_chars
FROM base
"""


WORD_SQL = r"[^\x20\x09-\x0D]+"
