import cases
import corpus_pipeline
from cadenza.llm import decontamination, simhash
from cadenza.llm.suite import QUERIES


def test_stages_take_effect_and_keep_the_columns(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smallest tables with enough labels to learn toxic words from
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.settle(stage(spark, docs, sf_dir), "test")
        assert after.schema == docs.schema, name
        assert after.join(docs.select("doc_id"), "doc_id", "left_anti").isEmpty()
        counts.append(after.count())
        if name == "simhash":
            assert simhash.near_duplicates(after).where("id <> component").isEmpty()
        docs = after
    assert counts[0] > counts[1] == counts[2] > counts[3] >= counts[4] > counts[0] / 2
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert decontamination.decontaminate(docs, benchmark).where("contaminated").isEmpty()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == counts[-1]


def test_run_gives_the_same_pieces(spark, sf_dir):
    first = {tuple(r) for r in QUERIES["pipeline"](spark, sf_dir).select("doc_id", "start", "length", "ids_crc32").collect()}
    assert first and first == {tuple(r) for r in corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "length", "ids_crc32").collect()}


def test_hostile_rows_through_the_middle_stages(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("length(text) > 100").select("text").first()[0]
    named = [(i, t, None, None, None, *("clash",) * 9) for i, t in enumerate([*cases.texts(), item], start=1)]
    nameless = [(None, t, "en", "s", 0, *(None,) * 9) for t in ("one text without an id " * 4, "one text without an id " * 4, item, None, cases.prose(77, 30), named[4][1])]
    docs = spark.createDataFrame([*named, *named[:3], named[0], *nameless], cases.DOCUMENTS)
    stages = dict(corpus_pipeline.STAGES)
    once = corpus_pipeline.settle(stages["simhash"](spark, docs, sf_dir), "test")
    ids = [r[0] for r in once.select("doc_id").collect()]
    assert once.schema == docs.schema and len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})
    assert set(range(1, 13)) <= set(ids) and 14 not in ids
    # The item and the copy of a named row are led by their named rows; the repeated text leaves one.
    assert sorted(r[0][:8] for r in once.where("doc_id is null").select("text").collect()) == sorted(["one text", cases.prose(77, 30)[:8]])
    clean = corpus_pipeline.settle(stages["decontamination"](spark, docs, sf_dir), "test")
    assert clean.where(clean.text == item).isEmpty() and clean.count() == docs.count() - 2
    lines = corpus_pipeline.settle(stages["line_dedup"](spark, once, sf_dir), "test")
    assert lines.schema == docs.schema and lines.count() == once.count()


def test_no_documents_through_the_middle_stages(spark, sf_dir):
    for name in ("line_dedup", "simhash", "decontamination"):
        assert dict(corpus_pipeline.STAGES)[name](spark, cases.nothing(spark), sf_dir).isEmpty()
