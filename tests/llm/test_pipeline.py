"""The pipeline's stages on odd rows, and their decisions on small tables."""

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from tidepanel.llm.common import written

SMALL = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, lang string, source string, n_chars int, score string, kept int, _uid int, id int, uid int, row string, C0 string, node string"


def odd_rows(spark):
    en, de = "the cat and the dog sat there with them and %s " * 12, "der hund und die katze ist nicht mit %s " * 12
    rows = [(i, (en if i % 2 else de) % tuple([f"w{i}x{j}" for j in range(12)]), "en" if i % 2 else "de", None, 5, "a", 1, 2, 3, 4, "b", "c", "d") for i in range(40)]
    same = rows[3]
    more = [(None, None), (None, ""), (50, "123"), (51, same[1]), (None, same[1]), (52, "the dog and " * 20_000), (3, same[1])]
    return spark.createDataFrame(rows + [(i, t, None, None, None, None, None, None, None, None, None, None, None) for i, t in more] + [same], ODD)


def test_each_stage_keeps_columns_and_takes_odd_rows(spark):
    docs = written(odd_rows(spark), "odd")
    for name, stage in pipeline.STAGES:
        out = written(stage(spark, docs, SMALL), name)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
            assert out.count() > 0
            if name == "near_duplicates":
                texts = [r["text"] for r in out.collect()]
                assert len(texts) == len(set(texts)) == 41
            docs = out
        assert stage(spark, docs.where("false"), SMALL).count() == 0, name


def test_decisions_on_the_given_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = {}
    for name, stage in pipeline.STAGES[:-1]:
        seen[name] = docs = written(stage(spark, docs, SMALL), name)
    start = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert seen["language"].count() >= 0.98 * start
    assert seen["near_duplicates"].groupBy("text").count().where("count > 1").count() == 0
    assert seen["repeated_passages"].count() == seen["near_duplicates"].count()
    assert seen["repeated_passages"].where(F.col("n_chars") != F.char_length("text")).count() == 0
    left = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert not [t for t in left for d in seen["decontamination"].collect() if d["text"] and t in d["text"]]
    assert pipeline.run(spark, SMALL).where("offset < 0 OR length > 2048").count() == 0
