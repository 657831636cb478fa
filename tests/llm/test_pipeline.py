from collections import Counter

import pytest

import corpus_pipeline as pipeline
from tests.conftest import SF_DIR
from tests.llm.test_jaccard import brute_force
from tests.llm.test_packing import check_places


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_exact_stage_keeps_one_of_each_text(spark, docs):
    kept = pipeline.exact_stage(spark, docs.unionByName(docs.filter("doc_id < 20")), SF_DIR)
    assert kept.columns == docs.columns
    normal = lambda t: "".join((t or "").split(" ")).replace("\n", "").replace("\t", "")
    assert sorted(normal(r["text"]) for r in kept.collect()) == sorted({normal(r["text"]) for r in docs.collect()})


def test_near_stage_keeps_the_first_of_each_component(spark, docs):
    kept = pipeline.near_stage(spark, docs, SF_DIR)
    expected = {c for _, c in brute_force({r["doc_id"]: r["text"] for r in docs.collect()}).values()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)
    assert kept.columns == docs.columns


def test_mixing_stage_repeats_as_often_as_taken(spark, docs):
    from tarmac.llm.mixing import mix_sources

    mixed = pipeline.mixing_stage(spark, docs, SF_DIR)
    taken = Counter(r["doc_id"] for r in mixed.collect())
    assert taken == Counter({r["doc_id"]: r["copies"] for r in mix_sources(docs).collect() if r["copies"]})
    assert mixed.columns == docs.columns


@pytest.mark.parametrize("stage", [s for _, s in pipeline.STAGES[:4]])
def test_stages_take_odd_rows(spark, odd, no_docs, stage):
    found = stage(spark, odd, SF_DIR)
    assert found.columns == odd.columns
    assert found.count() <= 2 * odd.count()
    assert stage(spark, no_docs, SF_DIR).count() == 0


def test_run_packs_what_the_stages_kept(spark):
    rows = pipeline.run(spark, SF_DIR).collect()
    assert check_places(rows, 4096) > 0
    assert [n for n, _ in pipeline.STAGES][0] == "quality classifier" and len(pipeline.STAGES) == 5


def test_quality_stage_keeps_clean_rows_that_share_an_id_with_junk(spark):
    folder = f"{SF_DIR}/../sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    texts = {kind: docs.join(labels.filter(f"quality = {kind} AND toxic = 0"), "doc_id", "left_semi").filter(
        "n_chars > 1000").orderBy("doc_id").limit(2).collect() for kind in (0, 1)}
    rows = [(i, *texts[kind][k][1:]) for k, i in enumerate((None, 1 << 60)) for kind in (0, 1)]
    kept = pipeline.quality_stage(spark, docs.unionByName(spark.createDataFrame(rows, docs.schema)), folder)
    assert sorted(r["text"] for r in kept.filter(f"doc_id IS NULL OR doc_id = {1 << 60}").collect()) == sorted(r["text"] for r in texts[1])


def test_near_stage_tells_rows_of_one_id_apart(spark, docs_of):
    words = [f"w{i}" for i in range(40)]
    one, like, other = " ".join(words), " ".join([*words, "end"]), " ".join(f"x{i}" for i in range(40))
    rows = [(None, one), (None, like), (None, other), (5, one.upper() + " a b"), (7, other + " y"), (7, "alone in the world of rows here"),
            (8, "p q r s t u"), (8, "p q r s t u"), (9, ""), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in pipeline.near_stage(spark, docs, SF_DIR).collect()]
    assert sorted(t for i, t in found if i is None) == []
    assert sorted((i, t) for i, t in found if i is not None) == sorted(
        [(5, rows[3][1]), (7, other + " y"), (7, rows[5][1]), (8, "p q r s t u"), (9, ""), (9, "")])
    found = pipeline.near_stage(spark, docs.filter("doc_id IS NULL"), SF_DIR).collect()
    assert len(found) == 2 and other in [r["text"] for r in found]
