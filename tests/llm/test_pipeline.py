from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_decontam import expect
from test_packing import check as check_packing
from test_packing import true_ids
from test_simhash import brute_components, brute_print
from test_substrings import brute as brute_windows
from test_substrings import words

import __spark_entry__ as entry
import corpus_pipeline
from tidewatch.llm import toxicity

FOLDER = "/root/testdata/sf0.01"
INSULTS = "idiot moron scum pathetic worthless clown trash disgusting"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes into each stage and comes out of it, written and read again; documents with planted cases."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").orderBy("item_id").first().text
    rare = " ".join(f"passage{k}" for k in range(70))
    lines = docs.where("doc_id = 7").first().text
    planted = [
        (5001, f"{lines} {INSULTS}."), (5002, " ".join(f"only{k}" for k in range(300))),
        (5003, " ".join(f"only{k}" for k in range(300))), (5004, f"head one {rare} tail one"),
        (5005, f"head two {rare} tail two"), (5006, f"Some text before. {item} And after."), (5007, None), (5008, ""),
    ]
    extra = spark.createDataFrame([(i, t, "en", "planted", len(t or "")) for i, t in planted], docs.schema)
    read = docs.unionByName(extra)
    kept = []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(number))
        stage(spark, read, FOLDER).write.parquet(path)
        out = spark.read.parquet(path)
        kept.append((name, read, out))
        read = out
    return {name: (before, after) for name, before, after in kept}


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_stages_and_columns(stages):
    assert list(stages) == [
        "toxicity", "simhash_near_dedup", "substring_dedup", "decontamination", "packing"]
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns == corpus_pipeline.COLUMNS
            assert after.where("n_chars <> length(coalesce(text, ''))").count() == 0


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = set(texts(after))
    gone = set(texts(before)) - kept
    model = toxicity.train(before, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert gone == {r.doc_id for r in toxicity.grade(before, model).where("toxic").collect()}
    assert 5001 in gone and {5002, 5003, 5004, 5005, 5006, 5007, 5008} <= kept
    clean = {i for i, x in labels.items() if x == 0}
    assert len(clean & gone) <= 0.02 * len(clean)


def test_one_of_each_group_stays(stages):
    before, after = stages["simhash_near_dedup"]
    rows = sorted(texts(before).items())
    label = brute_components([brute_print(t) for _, t in rows], 4)
    assert texts(after) == {rows[k][0]: rows[k][1] for k in set(label)}
    assert 5002 in texts(after) and 5003 not in texts(after)


def test_repeated_passages_are_cut(stages):
    before, after = stages["substring_dedup"]
    wanted = {i: kept for i, _, _, kept in brute_windows(list(texts(before).items()), 20)}
    found = texts(after)
    assert {i: " ".join(words(t)) for i, t in found.items()} == wanted
    # the windows that end behind the passage repeat as well
    assert found[5005].split() == ["head", "two", "two"] and "passage69" in found[5004]


def test_benchmark_passages_are_cut(spark, stages):
    before, after = stages["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    was, now = texts(before), texts(after)
    assert set(was) == set(now)
    guilty = {i for i, t in was.items() if expect(t, items)[-1]}
    assert guilty
    for i, text in was.items():
        if i in guilty:
            assert not expect(now[i], items)[-1]
        else:
            assert now[i] == text


def test_sequences_hold_what_is_left(stages):
    before, after = stages["packing"]
    rows = texts(before)
    assert check_packing(after.collect(), dict(zip(rows, true_ids(rows.values()))), 2048) < 0.02


def test_run_is_the_stages_in_order(spark, stages):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    docs, wanted = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), None
    for _, stage in corpus_pipeline.STAGES:
        wanted = docs = stage(spark, docs, "/root/testdata/sf0.001")
    key = lambda frame: sorted(map(tuple, frame.select(*sorted(frame.columns)).collect()))
    assert key(found) == key(wanted)
    assert entry.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("stage", range(5))
def test_empty_and_odd_documents(spark, stage):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(None, "no id here", None, None, None), (1, None, "en", "s", None), (2, "", None, "s", 0), (3, "one", "en", None, 3)]
    frame = spark.createDataFrame(rows, docs.schema)
    run = corpus_pipeline.STAGES[stage][1]
    assert run(spark, docs.limit(0), FOLDER).count() == 0
    found = run(spark, frame.withColumn("new_text", F.lit(1)), FOLDER)
    ids = {r.doc_id for r in found.collect()}
    # two empty texts are copies of each other
    assert ids == ({None, 1, 3} if stage == 1 else {None, 1, 2, 3})


def test_rows_that_share_an_id_are_judged_one_by_one(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    prose = [r.text for r in docs.orderBy("doc_id").limit(3).collect()]
    rows = [(1, prose[0]), (2, prose[0]), (2, prose[1]), (2, prose[1]), (None, prose[2]), (None, prose[2]), (3, None), (4, "")]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], docs.schema)
    found = corpus_pipeline.drop_near_copies(spark, frame, FOLDER).collect()
    wanted = [(1, prose[0]), (2, prose[1]), (None, prose[2]), (3, None)]
    assert sorted(((r.doc_id, r.text) for r in found), key=repr) == sorted(wanted, key=repr)
