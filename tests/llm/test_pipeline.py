"""The pipeline stage by stage against plain versions, and the entry's SQL."""

import duckdb
import pytest

import corpus_pipeline
from palimpsest.llm import mixing
from palimpsest.llm import queries as llm_queries
from tests.llm.conftest import LOWER, WORD
from tests.llm.test_decontaminate import plain as plain_hits
from tests.llm.test_ngram_join import plain as plain_components
from tests.llm.test_token_output import expected_index


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs.collect()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(path := str(tmp_path_factory.mktemp("stage") / "out"))
        docs = spark.read.parquet(path)
        out.append(docs.select("*", "_metadata.file_path", "_metadata.row_index").orderBy("file_path", "row_index").drop("file_path", "row_index").collect())
    return out


def test_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_join", "decontaminate", "mixing", "token_output"]


def test_quality_rules_keep_lines_of_the_text(stages):
    text = {r.doc_id: r.text for r in stages[0]}
    assert 0 < len(stages[1]) < len(stages[0])
    for r in stages[1]:
        lines = text[r.doc_id].split("\n")
        assert all(x in lines for x in r.text.split("\n")) and r.n_chars == len(r.text)


def test_one_of_each_group_stays(stages):
    expected = {c for _, n, c in plain_components([(r.doc_id, r.text) for r in stages[1]])}
    assert sorted(r.doc_id for r in stages[2]) == sorted(expected)


def test_contaminated_documents_go(spark, sf_dir, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hits = plain_hits([(r.doc_id, r.text) for r in stages[2]], items)
    assert sorted(r.doc_id for r in stages[3]) == sorted(h[0] for h in hits if not h[-1])


def test_mix_takes_parts_of_its_input(stages):
    text = {r.doc_id: r.text for r in stages[3]}
    assert all(r.text in text[r.doc_id] for r in stages[4])
    n = sum(len(WORD.findall(t)) for t in text.values())
    assert abs(sum(len(WORD.findall(r.text)) for r in stages[4]) - n) < 0.1 * n


def test_tokens(stages):
    """Ids lie in the order of the mix's rows."""
    got = sorted(stages[5], key=lambda r: r.start)
    assert [tuple(r)[:4] for r in got] == expected_index(stages[4])


def test_the_mix_is_in_order_of_its_shards(spark, stages):
    """Parts that follow one another in a document and fall into one slot do so in the mix; sources take turns."""
    docs = spark.createDataFrame(stages[3], spark.createDataFrame(stages[3]).schema)
    rows = mixing.mix_texts(docs).collect()
    key = lambda r: (r.shard, r.slot, r.src, r.part)
    in_slots = {}
    for r in sorted(rows, key=key):
        in_slots.setdefault((r.slot, r.src), []).append((r.doc_id, r.text))
    got, at = [(r.doc_id, r.text) for r in stages[4]], 0
    left = {}
    for parts in in_slots.values():
        left.setdefault(tuple(parts), 0)
        left[tuple(parts)] += 1
    longest = max(map(len, left))
    while at < len(got):  # the mix is slots one behind the other
        n = next(n for n in range(longest, 0, -1) if left.get(tuple(got[at : at + n])))
        left[tuple(got[at : at + n])] -= 1
        at += n
    assert not any(left.values())
    sources = [r.source for r in stages[4]]
    assert sum(a != b for a, b in zip(sources, sources[1:])) > 0.2 * len(sources)


def test_run(spark, sf_dir, stages):
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in stages[5])


@pytest.mark.parametrize("name", sorted(llm_queries.oracle_sql()))
def test_sql_agrees(spark, sf_dir, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    frame = llm_queries.queries()[name](spark, sf_dir)
    found = db.execute(llm_queries.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(frame.columns)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=key) == sorted(found.fetchall(), key=key)
    assert "A".translate(LOWER) == "a"


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, sf_dir, odd_docs, no_docs, name, stage):
    """Nulls in every column, word-free and long texts, repeated rows and ids, clashing columns; and no rows."""
    out = stage(spark, odd_docs, sf_dir).collect()
    ids = sorted(str(r.doc_id) for r in out)
    if name == "quality_rules":
        assert ids == []  # too few words, or words that repeat
    elif name == "ngram_join":  # texts without words stay, of each group of copies one
        assert ids == sorted(["1", "2", "3", "4", "5", "7", "None", "None"])
    elif name == "decontaminate":
        assert ids == sorted(str(r.doc_id) for r in odd_docs.collect())
    elif name == "mixing":
        assert out and all(r.text.strip() for r in out) and {r.doc_id for r in out} <= {1, 5, 6, 7, None}
    else:
        assert ids == sorted(str(r.doc_id) for r in odd_docs.collect()) and min(r.n_tokens for r in out) == 1
    assert stage(spark, no_docs, sf_dir).collect() == []
