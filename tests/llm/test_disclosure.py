"""Operator 12: the base against the contract's patterns, disclosing terms against plain counts, planted names, odd rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from palimpsest.llm.disclosure import Disclosure, base_spans, disclosing_terms, merged_terms, private_spans, query, rewritten, sanitised
from tests.llm.conftest import LOWER

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(d[::-1])) % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip":
                ok = all(int(x) <= 255 for x in m.group().split("."))
            else:
                ok = kind == "email" or (13 <= len(d) <= 19 and luhn(d) if kind == "card" else 9 <= len(d) <= 15)
            if ok:
                out.append((kind, *m.span()))
    return out


def plain(docs, plan=Disclosure()):
    """(spans by row, disclosing terms) of (doc_id, text), with dictionaries of words."""
    n, rows_t, rows_e, met, texts = len(docs), Counter(), Counter(), Counter(), defaultdict(set)
    kept = []
    for _, text in docs:
        text = text or ""
        spans = plain_base(text)
        own = list(text.translate(LOWER))
        for _, a, b in spans:
            own[a:b] = "\x01" * (b - a)
        tokens = [(m.group(), *m.span()) for m in re.finditer(r"\x01+|[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(own))]
        terms = [(w, a, b, k, k + 1) for k, (w, a, b) in enumerate(tokens)]
        terms += [(f"{w} {x}", a, d, k, k + 2) for k, ((w, a, _), (x, _, d)) in enumerate(zip(tokens, tokens[1:]))]
        terms = [t for t in terms if "\x01" not in t[0]]
        kept.append((spans, terms))
        rows_t.update({t[0] for t in terms})
        near = defaultdict(set)
        for kind, a, b in spans:
            value = text[a:b].lower() if kind == "email" else text[a:b] if kind == "ip" else re.sub("[^0-9]", "", text[a:b])
            left = sum(t[1] < a for t in tokens)
            right = sum(t[1] < b for t in tokens)
            near[kind, value] |= {t[0] for t in terms if left - plan.reach <= t[3] and t[4] <= left or right <= t[3] and t[4] <= right + plan.reach}
        for e, found in near.items():
            rows_e[e] += 1
            for t in found:
                met[e, t] += 1
                texts[e, t].add("".join(own))
    doubt = {}
    for (e, t), k in met.items():
        d = math.log2(rows_t[t] / k)
        if len(texts[e, t]) >= plan.least_texts and d <= plan.general_bits and math.log2(n / rows_e[e]) - d >= plan.least_bits:
            doubt[t] = min(d, doubt.get(t, 99))
    action = {t: "removed" if d <= plan.remove_bits else "generalised" for t, d in doubt.items()}
    out = [(d[0], spans + merged_terms([(a, b, action[w]) for w, a, b, _, _ in terms if w in action])) for d, (spans, terms) in zip(docs, kept)]
    return out, action


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 4)))
    some = lambda k: " ".join(word() for _ in range(k))
    docs = [(k, some(40)) for k in range(120)]
    docs += [(200 + k, f"{some(12)}. Write to Wilma Quast at w.quast{'' if k else '+x'}@mail.example.org, {some(9)}") for k in range(6)]
    docs += [(300 + k, f"{some(15)} Wilma Quast {some(5)}") for k in range(3)]
    docs += [(400, "ask Otto Lemp 4111 1111 1111 1111 " + some(4))] * 9  # copies are one text
    docs += [(500 + k, f"{some(4)} call +49 (30) 555-0199 ext Zander {some(6)}") for k in range(4)]
    docs += [(600 + k, f"public info@example.com {some(3)}") for k in range(40)]
    return docs


def test_base_equals_the_patterns():
    rng = random.Random(4)
    for alphabet in ("a1@.-", "1.2 ", "12- +()", "+1 5(.)-", "ab@.c+1 -5_%é\n", "0123456789 -", "25.", "@."):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 45)))
            assert base_spans(text) == plain_base(text), text
    for text in ("4111 1111 1111 1111", "x 4111-1111-1111-1111 y", "4111111111111112", "a@b.c@d.e.f", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.02.3.0255", "+1 (743) 555-3824", "+1", "é@b.cd"):
        assert base_spans(text) == plain_base(text), text


def test_long_runs_take_linear_time():
    for text in ("9" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "a@" * 100_000, "+" * 200_000, "+1" + " " * 200_000, "1 " * 100_000, "-" * 300_000):
        base_spans(text)
    assert base_spans("1.1.1." + "9" * 6000) == []


def test_terms_equal_plain_counts(spark, planted):
    frame = spark.createDataFrame(planted, "doc_id long, text string")
    for plan in (Disclosure(), Disclosure(reach=3, least_texts=2, general_bits=2.0)):
        spans, action = plain(planted, plan)
        got = private_spans(frame, plan).collect()
        assert sorted((r.doc_id, tuple(map(tuple, r.spans))) for r in got) == sorted((d, tuple(s)) for d, s in spans)
        assert Counter(r.action for r in disclosing_terms(frame, plan).collect()) == Counter(action.values())


def test_a_name_that_tells_an_address_goes(spark, planted):
    frame = spark.createDataFrame(planted, "doc_id long, text string")
    text = {r.doc_id: r.text for r in sanitised(frame).collect()}
    for k in range(1, 6):
        assert "[EMAIL]" in text[200 + k] and "Wilma" not in text[200 + k] and "Quast" not in text[200 + k]
    assert all("Wilma" not in text[300 + k] for k in range(3))  # also where no address stands
    assert "Zander" not in text[500] and "[PHONE]" in text[500]
    assert "Otto Lemp [CARD]" in text[400]  # seen in one text only, however often it is copied
    assert "public [EMAIL]" in text[600]  # a third of a corpus is no secret
    assert [text[d] for d, t in planted[:120]] == [t for _, t in planted[:120]]


def test_query(spark, sf_dir, documents):
    got = {r.doc_id: r for r in query(spark, sf_dir).collect()}
    assert len(got) == len(documents)
    expected, _ = plain([(d.doc_id, d.text) for d in documents])
    for doc_id, spans in expected:
        r, line = got[doc_id], [f"{k}:{a}:{b}" for k, a, b in spans]
        base = [x for x in line if x.split(":")[0] in PATTERNS]
        assert r.spans == ",".join(line) and r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k + ":") for x in base) for k in PATTERNS]
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in got.values()) > 5


def test_rewritten_spans():
    text = "Ann 12 call a@b.cd or +1 555 000 1234"
    assert rewritten(text, [("email", 12, 18), ("removed", 0, 3), ("generalised", 4, 6), ("phone", 22, 37)]) == " [NUMBER] call [EMAIL] or [PHONE]"
    assert rewritten("xx 1.2.3.4 y", [("ip", 3, 10), ("phone", 5, 8)]) == "xx [IP] y"
    assert merged_terms([(0, 3, "generalised"), (0, 7, "removed"), (8, 9, "generalised")]) == [("generalised", 8, 9), ("removed", 0, 7)]


def test_odd_rows(spark, odd_docs, no_docs):
    rows = odd_docs.selectExpr("*", "1 AS spans", "2 AS term", "3 AS base")
    assert len(private_spans(rows).collect()) == 10 and all(r.spans == [] for r in private_spans(rows).collect())
    out = sanitised(rows)
    assert out.columns == rows.columns and sorted(map(str, out.collect())) == sorted(map(str, rows.collect()))
    assert private_spans(no_docs).collect() == [] and sanitised(no_docs).collect() == []
