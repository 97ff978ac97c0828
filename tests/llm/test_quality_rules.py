"""Operator 8: base counts against a plain version; line rules; odd rows."""

from palimpsest.llm.quality_rules import LineRules, judge, line_fails, line_quality, query, stage
from tests.llm.conftest import WORD


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(windows) < 400 else None
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), None if hit is None else len(hit)


def test_query(spark, sf_dir, documents):
    got = {r.doc_id: r for r in query(spark, sf_dir).collect()}
    assert len(got) == len(documents)
    for d in documents:
        r, expected = got[d.doc_id], plain(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == expected[:4]
        if expected[4] is not None:
            assert r.n_repeat_words == expected[4]
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_line_rules():
    body = "\n".join(" ".join(f"{w}{i}" for w in "some plain words of a line that ends well".split()) + "." for i in range(8))
    junk = "Home | News | Sport | About\nAll rights reserved.\nan unfinished line\n$$$ ### !!! buy."
    r = judge(f"{body}\n{junk}", LineRules())
    assert r[6] and r[8] == body
    many = "\n".join(f"menu entry {i} without an end at all" for i in range(40))
    assert not judge(f"{body}\n{many}", LineRules())[6]


def fails(line):
    return line_fails(line, WORD.findall(line), LineRules())


def test_lines_of_clean_text_stay():
    rest = " ".join("words that go on for a while and say something plain".split() * 4)
    for line in (
        f"« Oui », dit-il, « et non », {rest}.", "Il répond « non » puis « oui » .", f"El l·l de col·legi, i {rest}.", "The catalog in the blog in question is a dialog in itself.",
        f"To read more about the privacy policy of this state, {rest}.", "他说这是一个句子。", "هل هذا سؤال؟", "Sie sagte: „So ist es.“", "It ends well. anna", "• One item of a list ends here.",
    ):
        assert not fails(line), line


def test_lines_of_junk_fail():
    for line in (
        "Home: News Sport Weather", "Home | News | Sport.", "Home|News|About.", "Start » Rezepte » Brot.", "Start › Recipes › Bread.", "Alle Rechte vorbehalten.", "© 2020 Example. All rights reserved.",
        "Lire la suite...", "Haga clic aquí.", "Click here to read more.", "no end at all", "e.g. this line has a mark early and goes on", "$$$ win! win! win!",
    ):
        assert fails(line), line


def test_repeats_overlap():
    text = "a b c a b c d e f"
    assert judge(text, LineRules())[4] == plain(text)[4] == 6
    assert judge("a a a a", LineRules())[4] == plain("a a a a")[4] == 4
    assert judge("a b c", LineRules())[4] == 0


def test_odd_rows(spark, odd_docs, no_docs):
    rows = line_quality(odd_docs).collect()
    assert len(rows) == 10 and all(not r.kept and r.clean_text is not None for r in rows if r.doc_id in (2, 3, 4))
    assert {r.n_words for r in rows if r.doc_id == 5} == {60_000}
    assert line_quality(no_docs).count() == 0
    assert stage(spark, odd_docs, "").columns == ["doc_id", "text", "lang", "source", "n_chars"]
