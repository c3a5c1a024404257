"""The stages of the pipeline, each against plain Python on what it was given."""

import os
import re

import pytest

import corpus_pipeline
from sourcefold.llm.common import stored

from .brute import brute_classes, brute_counts, brute_hits, brute_spans

DIR = os.environ.get("SOURCEFOLD_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def steps(spark):
    if not os.path.isdir(DIR):
        pytest.skip("no tables")
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], DIR)))
    return out


def texts(frame):
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}


def test_stages_return_the_columns_of_documents(steps):
    assert all(s.columns == steps[0].columns for s in steps[1:-1])
    assert steps[-1].columns == ["doc_id", "lang", "source", "ids", "n_tokens"]


def test_quality_keeps_what_the_rules_keep(steps):
    given, kept = texts(steps[0]), texts(steps[1])
    wanted = set()
    for k, t in given.items():
        n, _, _, _, again = brute_counts(t)
        if n >= 50 and 100 * again <= 50 * n:
            wanted.add(k)
    assert set(kept) == wanted and all(kept[k] == given[k] for k in kept)


def test_one_document_of_each_class_stays(steps):
    given, kept = texts(steps[1]), texts(steps[2])
    classes = brute_classes(list(given.items()), 5, 80)
    assert set(kept) == {k for k, (_, _, stays) in classes.items() if stays}


def test_benchmark_text_goes(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    given, kept = texts(steps[2]), texts(steps[3])
    for k, t in given.items():
        n, hit, _ = brute_hits(t, items)
        assert (k in kept) == (not (hit and 20 * hit >= n))
        if k in kept:
            assert kept[k] == t if not hit else brute_hits(kept[k], items)[1] == 0


def test_identifiers_go_and_the_rest_stays(steps):
    given, kept = texts(steps[3]), texts(steps[4])
    labels = r"\[EMAIL\]|\[IP\]|\[CARD\]|\[PHONE\]"
    for k, t in given.items():
        spans = brute_spans(t)
        assert kept[k] == t if not spans else re.search(labels, kept[k])
    assert set(kept) == set(given)


def test_ids_are_the_librarys(steps):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    given = texts(steps[4])
    for r in steps[5].collect():
        assert r["ids"] == library.encode(given[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r["ids"])


CLASHES = ["N_words", "kept", "base_failed", "items", "Spans", "clean_text", "component_id", "ids", "_rest"]


def test_stages_take_edges_and_keep_clashing_columns(spark, tmp_path):
    good = " ".join(f"w{i}" for i in range(80))
    other = " ".join(f"v{i}" for i in range(80)) + " mail me@x.org"
    rows = [(1, good, "en", "a"), (1, good, "en", "a"), (2, good, None, None), (3, other, "en", "a"), (4, None, "en", "a"), (5, "", "en", None), (None, other.upper(), None, "b"), (6, "short", "en", "b")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in CLASHES)
    docs = spark.createDataFrame([(*r, len(r[1] or ""), *range(900, 900 + len(CLASHES))) for r in rows], schema)
    spark.createDataFrame([(1, "nothing of this stands there")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, table, str(tmp_path))
            assert found.columns == docs.columns and found.dtypes == docs.dtypes, name
            kept = found.collect()
            assert all([r[c] for c in CLASHES] == list(range(900, 900 + len(CLASHES))) for r in kept), name
            table = spark.createDataFrame(kept, schema)
        ids = corpus_pipeline.STAGES[-1][1](spark, table, str(tmp_path)).collect()
        assert len(ids) == len(kept)
        if kept:
            assert sorted((r.doc_id or -1, r.text) for r in kept) == [(-1, other.upper().replace("ME@X.ORG", "[EMAIL]")), (1, good), (3, other.replace("me@x.org", "[EMAIL]"))]
            assert all(r.n_chars == len(r.text) for r in kept)
