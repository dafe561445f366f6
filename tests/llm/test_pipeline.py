import pytest

import corpus_pipeline
from llm_fixtures import awkward, nothing  # noqa: F401
from test_near_duplicates import plain as plain_components
from tradewind.llm import quality
from tradewind.llm.util import stored, table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = table(spark, FOLDER, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), f"test-{name}")
        out.append(docs)
    return out


def test_stages_against_plain_versions(spark, outputs):
    given = table(spark, FOLDER, "documents")
    after_quality, after_dedup, clean, redacted, tokens = outputs
    assert all(o.columns == given.columns for o in outputs[:-1])
    kept = {r["doc_id"] for r in after_quality.collect()}
    assert all(quality.measure(r["text"])[0] >= 50 for r in after_quality.collect())
    good = {r["doc_id"] for r in table(spark, FOLDER, "labels").where("quality = 1").collect()}
    enough = {r["doc_id"] for r in given.collect() if quality.measure(r["text"])[0] >= 50}
    assert len(good & enough & kept) >= 0.98 * len(good & enough)
    want = {n for n, _, _, first in plain_components([(r["doc_id"], r["text"]) for r in after_quality.collect()], 5, 80) if first}
    assert {r["doc_id"] for r in after_dedup.collect()} == want
    texts = [{r["doc_id"]: r["text"] for r in o.collect()} for o in (after_dedup, clean, redacted)]
    assert texts[0].keys() == texts[1].keys() == texts[2].keys()
    assert all(r["n_chars"] == len(r["text"]) for o in (clean, redacted) for r in o.collect())
    assert any(texts[0][k] != texts[1][k] for k in texts[0]) and any(texts[1][k] != texts[2][k] for k in texts[0])
    assert {r["doc_id"]: r["decoded"] for r in tokens.collect()} == texts[2]


def test_run_gives_the_last_stage(spark, outputs):
    rows = lambda df: sorted((r["doc_id"], r["n_tokens"], tuple(r["ids"])) for r in df.collect())
    assert rows(corpus_pipeline.run(spark, FOLDER)) == rows(outputs[-1])


@pytest.mark.parametrize("n", range(5))
def test_awkward_rows(spark, awkward, nothing, n):
    stage = corpus_pipeline.STAGES[n][1]
    found = stage(spark, awkward, FOLDER)
    assert n == 4 or found.columns == awkward.columns
    assert found.count() == (14 if n > 1 else 11 if n == 1 else found.count())
    assert stage(spark, nothing, FOLDER).count() == 0
