import collections

import pytest

import corpus_pipeline
from test_llm import edit, shingles, text

ITEM = text(30, 2000)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    texts = [(i, text(60, 2100 + i) + (" vile brute" if i % 4 == 0 else "")) for i in range(80)]
    texts += [(100, edit(texts[1][1], 1, 1)), (101, texts[2][1]), (102, f"{text(20, 2001)} {ITEM} {text(9, 2002)}"), (103, ITEM.rsplit(" ", 1)[0])]
    texts += [(104, f"{text(20, 2003)} password: hunter22 end"), (105, None), (106, ""), (3, texts[3][1]), (None, text(20, 2004)), (None, None)]
    texts += [(None, texts[5][1]), (None, f"{ITEM} {text(5, 2005)}"), (7, text(30, 2006)), (None, text(20, 2004))]  # a copy, a leak, an id of two texts, a row twice
    rows = [(i, t, "en", "x", len(t or "")) for i, t in texts]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def first_of_near(rows):
    """One row of each component of distinct rows: those with an id of their own come first, by id."""
    ids = collections.Counter(i for i, _ in rows)
    rows = sorted(set(rows), key=lambda r: (r[0] is None or ids[r[0]] > 1, r[0] or 0, r[1] or ""))
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if x and 100 * len(x & y) >= 75 * len(x | y):
                    root[i] = root[j] = min(root[i], root[j])
        if all(root[r] == r for r in root):
            break
    return {r for i, r in enumerate(rows) if root[i] == i}


def plain(rows, stage):
    if stage == 1:
        return first_of_near(rows)
    if stage == 2:
        return {(i, t) for i, t in rows if ITEM.rsplit(" ", 1)[0] not in (t or "")}
    return {(i, t and t.replace("password: hunter22", "<assign>")) for i, t in rows}


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_and_run_against_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k in (1, 2, 3):
        got = pairs(corpus_pipeline.STAGES[k][1](spark, docs, sf_dir))
        assert set(got) == plain(pairs(docs), k)
    kept = pairs(corpus_pipeline.toxicity_stage(spark, docs, sf_dir))
    assert set(kept) <= set(pairs(docs)) and len(kept) < docs.count()
    for k in (1, 2, 3):
        kept = plain(kept, k)
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in out} == {i for i, _ in kept}


def test_stages_of_empty_tables(spark, sf_dir):
    none = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0
