"""Operator 5: planted passages, shifts, short copies, rows without ids, and a plain version written apart."""

import random

import numpy as np

from palimpsest.llm import substring_dedup
from palimpsest.llm.substring_dedup import REACH, chunks, cuts, query, repeated_spans, without_duplicates
from tests.llm.conftest import DOCS, WORD


def words(r, n):
    return " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(2, 9))) for _ in range(n))


def plain_bounds(raw, reach=REACH):
    """Chunk bounds by the rule as it is told, position by position."""
    gear = substring_dedup._GEAR.tolist()

    def value(end):  # of the 16 bytes before a bound; none inside a character
        if end < len(raw) and raw[end] & 0xC0 == 0x80:
            return 0xFFFF
        return sum(gear[b] << age for age, b in enumerate(reversed(raw[end - 16 : end]))) & 0xFFFF

    values = {p: value(p) for p in range(16, len(raw))}
    out = [0]
    for p in range(16 + reach, len(raw) - reach):
        v = values[p]
        if v < 0xFFFF and all(values[p - k] > v for k in range(1, reach + 1)) and all(values[p + k] >= v for k in range(1, reach + 1)):
            out.append(p)
    return [*out, len(raw)] if raw else []


def plain_result(texts, ids, least=12):
    """(n_chunks, repeats, duplicates) of every row, by comparing chunk bytes."""
    parts = []
    for t in texts:
        raw = (t or "").encode()
        b = plain_bounds(raw)
        parts.append([(x, y, raw[x:y]) for x, y in zip(b, b[1:])])
    owners = {}
    for i, p in enumerate(parts):
        for _, _, c in p:
            owners.setdefault(c, set()).add(i)
    out = []
    for i, (t, p) in enumerate(zip(texts, parts)):
        raw, found = (t or "").encode(), []
        for keep in (lambda c: len(owners[c]) > 1, lambda c: len(owners[c]) > 1 and i != min(owners[c], key=lambda k: (ids[k] is None, ids[k] or 0, k))):
            spans = []
            for x, y, c in p:
                if keep(c):
                    if spans and spans[-1][1] == x:
                        spans[-1][1] = y
                    else:
                        spans.append([x, y])
            begun = lambda x: sum(1 for m in WORD.finditer(t) if len(t[: m.start()].encode()) < x)  # noqa: B023, E731
            found.append([(x, y) for x, y in spans if begun(y) - begun(x) >= least or (x == 0 and y == len(raw))])
        out.append((len(p), *found))
    return out


def odd_texts(r):
    base = [words(r, r.randint(1, 80)) for _ in range(8)] + ["été 中文 \U0001f600 " * 12, "aaaa" * 90, "", "x", None]
    rows = []
    for _ in range(60):
        some = r.choice(base)
        how = r.random()
        if some and how < 0.3:
            at = r.randint(0, len(some))
            some = some[:at] + words(r, 2) + some[at:]
        elif some and how < 0.6:
            some = f"{words(r, 9)} {some} {words(r, 5)}"
        rows.append(some)
    return rows


def compare(rows, texts, ids):
    """Rows of equal ids and texts are alike but for which of them comes first."""
    expected = plain_result(texts, ids)
    plain = sorted((str(i), n, str(a), len(d)) for i, (n, a, d) in zip(ids, expected))
    got = sorted((str(x.doc_id), x.n_chunks, str([(s.start, s.end) for s in x.repeats]), len(x.duplicates)) for x in rows)
    assert got == plain


def test_equal_to_the_plain_version(spark):
    r = random.Random(8)
    texts = odd_texts(r)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {x.doc_id: (x.n_chunks, [(s.start, s.end) for s in x.repeats], [(s.start, s.end) for s in x.duplicates]) for x in repeated_spans(docs).collect()}
    assert got == dict(enumerate(plain_result(texts, list(range(len(texts))))))


def test_null_and_repeated_ids_are_rows_of_their_own(spark):
    r = random.Random(9)
    p, q = words(r, 60), words(r, 60)
    rows = [(5, p), (5, q), (5, None), (None, q), (None, words(r, 60)), (None, p + " " + words(r, 60)), (7, words(r, 40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    compare(repeated_spans(docs).collect(), [t for _, t in rows], [i for i, _ in rows])
    cut = [(str(x.doc_id), x.text) for x in without_duplicates(docs).collect()]
    assert len(cut) == 7 and ("5", p) in cut and ("5", q) in cut and ("None", "") in cut and ("5", None) in cut


def test_texts_are_partitioned_whole():
    r = random.Random(5)
    for _ in range(300):
        text = words(r, r.randint(1, 60)) + r.choice(["", "é中" * 20])
        keys, bounds, counts, n = chunks(text)
        raw = text.encode()
        assert bounds[0] == 0 and bounds[-1] == len(raw) and (np.diff(bounds) > 0).all() and len(keys) == len(bounds) - 1
        assert bounds.tolist() == plain_bounds(raw) and n == len(WORD.findall(text)) == counts[-1]
        "".join(raw[a:b].decode() for a, b in zip(bounds, bounds[1:]))  # no character is split
    assert len(cuts(np.zeros(10_000, np.uint8))) == 0


def test_short_exact_copies_are_found(spark):
    r = random.Random(6)
    texts = [words(r, n) for n in (1, 3, 10, 40)]
    docs = spark.createDataFrame([(i, texts[i % 4]) for i in range(8)] + [(9, words(r, 10))], "doc_id long, text string")
    got = {x.doc_id: x for x in repeated_spans(docs).collect()}
    for i in range(8):
        assert got[i].n_repeat_words == got[i].n_words and got[i].n_dup_words == (got[i].n_words if i >= 4 else 0)
    assert got[9].n_repeat_words == 0


def test_planted_passages_are_found_and_others_left(spark):
    r = random.Random(1)
    passages = [words(r, r.randint(51, 120)) for _ in range(60)]
    rows = []
    for i in range(180):
        rows.append((i, f"{words(r, r.randint(0, 60))} {passages[i % 60]} {words(r, r.randint(0, 60))}", "en", "a", 0))
    clean = [(1000 + i, words(r, 150), "en", "a", 0) for i in range(60)]
    got = {x.doc_id: x for x in repeated_spans(spark.createDataFrame(rows + clean, DOCS)).collect()}
    assert all(got[i].n_repeat_words > 0 for i, *_ in rows)
    assert all(got[i].n_repeat_words == 0 for i, *_ in clean)
    assert all(got[i].n_dup_words == 0 for i in range(60)) and all(got[i].n_dup_words > 0 for i in range(60, 180))
    for i, text, *_ in rows:  # what is reported is in two rows, and little more than the passage
        for s in got[i].repeats:
            span = text.encode()[s.start : s.end].decode()
            assert any(span in other for j, other, *_ in rows if j != i and j % 60 == i % 60) and span[4:-4] in passages[i % 60]


def test_insertions_move_nothing_else():
    r = random.Random(2)
    a = words(r, 400)
    b = a[:300] + " inserted " + a[300:]
    one, two = set(chunks(a)[0].tolist()), set(chunks(b)[0].tolist())
    assert len(one) > 40 and len(one & two) > len(one) - 5


def test_query_against_the_plain_version(spark, sf_dir, documents):
    rows = query(spark, sf_dir).collect()
    compare(rows, [d.text for d in documents], [d.doc_id for d in documents])


def test_cutting_leaves_one_copy(spark):
    r = random.Random(4)
    p = words(r, 200)
    rows = [(1, p, "en", "a", 0), (2, p, "en", "a", 0), (3, "short", "en", "a", 0), (4, None, "en", "a", 0)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS _id", "2 AS row", "3 AS hits")
    got = {x.doc_id: x for x in without_duplicates(docs).collect()}
    assert got[1].text == p and got[2].text == "" and got[3].text == "short" and got[4].text is None
    assert got[2].row == 2 and got[2]._id == 1


def test_odd_rows(spark, odd_docs, no_docs):
    rows = repeated_spans(odd_docs).collect()
    assert len(rows) == 10
    by = {r.doc_id: r for r in rows}
    assert by[5].n_repeat_words > 50_000 and by[5].n_dup_words == 0 and by[6].n_dup_words > 50_000
    ones = sorted((r.n_repeat_words, r.n_dup_words) for r in rows if r.doc_id == 1)
    assert ones == [(3, 0), (3, 3)] and by[2].n_repeat_words == 0
    assert repeated_spans(no_docs).count() == 0
    assert without_duplicates(odd_docs).count() == 10 and without_duplicates(no_docs).count() == 0
