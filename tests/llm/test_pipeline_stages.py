"""The corpus pipeline, stage by stage, against what each stage should leave."""

from __future__ import annotations

import corpus_pipeline
from fleetlake.llm import mixing, pii, quality, simhash
from fleetlake.llm.common import stored

TEXT = " ".join(f"word{i}, and more text" for i in range(40))
ROWS = [
    (1, TEXT, "en", "a", 1),
    (1, TEXT, "en", "a", 1),
    (2, TEXT, "en", "b", 1),
    (3, "too short", "en", "b", 1),
    (4, None, None, None, None),
    (5, TEXT.replace("text", "prose") + " write to me@host.example today", "en", None, 1),
    (None, TEXT.replace("word", "thing"), "en", "b", 1),
]


def test_stages_on_a_small_corpus(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long").withColumnRenamed("lang", "lang")
    names = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, ""))
        assert docs.columns == corpus_pipeline.COLUMNS
        names.append((name, sorted(str(r["doc_id"]) for r in docs.collect())))
    assert names[0][1] == ["1", "1", "2", "5", "None"]
    assert names[1][1] == names[2][1] == names[3][1] == ["1", "5", "None"]
    by_id = {r["doc_id"]: r for r in docs.collect()}
    assert "me@host.example" not in by_id[5]["text"] and "<email>" in by_id[5]["text"]
    assert all(r["n_chars"] == len(r["text"]) for r in by_id.values())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    for doc_id in by_id:
        mine = sorted((p["start"], p["length"]) for p in packed if p["doc_id"] == doc_id)
        assert [s for s, _ in mine] == [sum(n for _, n in mine[:i]) for i in range(len(mine))]


def test_documents_that_share_an_id_stay_one_for_each_group(spark):
    first, copy, other = (" ".join(f"{name}{i * i}" for i in range(60)) for name in "abc")
    rows = [(1, copy), (2, copy), (2, first), (2, first), (3, other), (3, copy), (4, None), (4, "single")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], schema)
    left = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    expected = [(1, copy), (2, first), (3, other), (4, ""), (4, "single")]
    assert sorted((r["doc_id"], r["text"] or "") for r in left) == expected


def test_run_equals_the_stages_over_a_table(spark):
    directory = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    kept = quality.judge(docs).where("kept").select("doc_id")
    kept = stored(docs.join(kept, "doc_id", "left_semi"))
    groups = simhash.near_duplicates(kept)
    expected = {r[0] for r in groups.where("doc_id = component_id").select("doc_id").collect()}
    packed = corpus_pipeline.run(spark, directory)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == expected
    assert all(pii.spans(r["text"])[0] == [] for r in corpus_pipeline.personal_data(spark, kept, directory).collect())


def test_sequences_follow_the_mixture_over_several_files(spark):
    """What run() returns, against slots and places of the mixture, with files of one row group each."""
    directory, conf = "/root/testdata/sf0.001", spark.conf
    settings = {"spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.openCostInBytes": "1k", "spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.enabled": "false"}
    before = {name: conf.get(name, None) for name in settings}
    for name, value in settings.items():
        conf.set(name, value)
    try:
        docs = spark.read.parquet(f"{directory}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:3]:
            docs = stored(stage(spark, docs, directory))
        mixed = {r["doc_id"]: (r["slot"], r["place"]) for r in mixing.mix(docs).collect()}
        written = stored(corpus_pipeline.mixture(spark, docs, directory))
        assert len(written.inputFiles()) > 3
        packed = corpus_pipeline.run(spark, directory).select("doc_id", "start", "sequence_id").collect()
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)
    packed = sorted(packed, key=lambda r: r["sequence_id"])
    order = [(*mixed[r["doc_id"]], r["start"]) for r in packed]
    assert order == sorted(order) and {r["doc_id"] for r in packed} == set(mixed)


def test_stages_on_empty_tables_and_clashing_columns(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, block int, slot string, row int, key string, _file int"
    for rows in ([], [(1, TEXT, "en", "a", 1, 1, "s", 1, "k", 1), (2, TEXT.replace("word", "other").replace("text", "prose"), "en", None, 1, None, None, None, None, None)]):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, ""))
            assert docs.columns == corpus_pipeline.COLUMNS
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").select("doc_id").distinct().count() == len(rows)
