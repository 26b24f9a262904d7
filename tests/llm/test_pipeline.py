import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from earshot.llm.common import fold, sift, table
from earshot.llm.components import components
from earshot.llm.decontam import contamination
from earshot.llm.queries import ORACLE, QUERIES
from earshot.llm.simhash import simhash_groups
from earshot.llm.toxicity import toxicity_scores

SF = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))
    assert QUERIES.items() <= queries().items() and ORACLE.items() <= oracle_sql().items()


def test_stages_act_on_what_their_predecessor_kept(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    calm = stages["toxicity"](spark, docs, SF).cache()
    rejected = {r["doc_id"] for r in toxicity_scores(docs, table(spark, SF, "labels")).filter("predicted = 1").collect()}
    assert {r["doc_id"] for r in calm.collect()} == {r["doc_id"] for r in docs.collect()} - rejected
    single = stages["near_duplicates"](spark, calm, SF).cache()
    groups = simhash_groups(calm).collect()
    assert {r["doc_id"] for r in single.collect()} == {r["component_id"] for r in groups}
    clean = stages["decontamination"](spark, single, SF).cache()
    leaks = {r["doc_id"] for r in contamination(single, table(spark, SF, "benchmark")).collect()}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in single.collect()} - leaks
    safe = stages["personal_data"](spark, clean, SF)
    assert safe.count() == clean.count()
    assert calm.columns == single.columns == clean.columns == safe.columns == columns
    texts = {r["doc_id"]: r["text"] for r in safe.collect()}
    final = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: r["decoded"] for r in final} == texts


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 202), (202, 200), (7, 7), (None, 3)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "u long, v long")).collect()))
    assert found == {**dict.fromkeys(range(2, 61), 1), **dict.fromkeys(range(101, 140), 100), 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_sift_keeps_all_that_matches(spark):
    rows, keys = spark.range(1000), spark.range(0, 1000, 100)
    kept = {r["id"] for r in sift(rows, keys, "id", 64).collect()}
    assert set(range(0, 1000, 100)) <= kept and len(kept) < 400


def test_fold_is_crc32_of_the_decimal_text(spark):
    import zlib

    rows = spark.createDataFrame([(7,), (-3,), (None,)], "doc_id long").select("doc_id", fold("doc_id", 7).alias("f"))
    assert {tuple(r) for r in rows.collect()} == {(i, zlib.crc32(t) % 7) for i, t in ((7, b"7"), (-3, b"-3"), (None, b""))}
