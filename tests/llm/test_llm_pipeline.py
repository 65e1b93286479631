from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from scoreloom.llm import mixing, pii, quality_rules, simhash
from scoreloom.llm.queries import END_ID, QUERIES, tokenizer
from test_llm_tokens import placed_whole, plain

FOLDER = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    whole = {r.doc_id: r.text for r in docs.collect()}
    columns, kept = docs.columns, {}
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        kept[name] = rows
        if name != "sequences":
            assert docs.columns == columns
    good = {r.doc_id for r in quality_rules.judged(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect() if r.kept}
    assert {r.doc_id for r in kept["quality"]} == good and 0 < len(good) < len(whole)
    groups = {}
    for r in simhash.linked(spark.createDataFrame(kept["quality"])).collect():
        groups.setdefault(r.component_id, []).append(r.doc_id)
    assert sorted(r.doc_id for r in kept["near_duplicates"]) == sorted(map(min, groups.values()))
    for r in kept["personal_data"]:
        assert r.text == pii.redact(whole[r.doc_id], pii.find(whole[r.doc_id]))
    copies = Counter(r.doc_id for r in kept["source_mix"])
    taken = {r.doc_id: r for r in mixing.mixed(spark.createDataFrame(kept["personal_data"])).collect()}
    assert copies == {i: -(-r.taken // r.size) for i, r in taken.items() if r.taken}
    ordered = [(r.doc_id, ids) for r, ids in zip(kept["source_mix"], plain([r.text for r in kept["source_mix"]]), strict=True)]
    placed_whole(kept["sequences"], ordered, 4096)


def test_registered():
    names = entry.queries()
    assert names["pipeline"] is pipeline.run and set(QUERIES) < set(names)
    assert [n.split("_")[0] for n in QUERIES if n.startswith("op")].__len__() >= 11
    assert tokenizer() and END_ID == 2
