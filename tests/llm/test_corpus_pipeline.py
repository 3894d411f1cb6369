"""The pipeline, stage by stage, on a small corpus with known answers."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.conftest import prose

VOCABULARY = public_tokenizers.path(corpus_pipeline.VOCABULARY)


def test_pipeline_keeps_what_it_should(spark, docs, tmp_path):
    item = prose(700, 60)
    passage = "\n".join(prose(600 + k, 12) for k in range(6))
    near = prose(50, 120)
    rows = [(i, prose(i, 80 + i)) for i in range(20)]
    rows += [(30, "too short"), (31, None), (32, ""), (33, "a b c a b c " * 30)]  # rejected by the rules
    rows += [(40, near), (41, near + " tail"), (42, near)]  # a near copy goes; of an exact one, its lines
    rows += [(60, f"{prose(60, 70)}\n{passage}"), (61, f"{passage}\n{prose(61, 70)}")]  # the later copy of the passage goes
    rows += [(70, f"{prose(70, 60)} {item} {prose(71, 60)}")]  # holds a benchmark item
    rows += [(80, prose(80, 90)), (80, prose(81, 90)), (None, prose(82, 90))]  # repeated and missing ids
    folder = str(tmp_path)
    docs(rows).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    got = sorted(((r.doc_id, list(r.ids)) for r in corpus_pipeline.run(spark, folder).collect()), key=repr)
    lines = passage.split("\n")
    kept = [(i, t) for i, t in rows if i not in (30, 31, 32, 33, 41, 42, 61, 70)] + [(42, "")]
    kept.append((61, "\n".join(x for x in rows[[i for i, _ in rows].index(61)][1].split("\n") if x not in lines)))
    library = Tokenizer.from_file(VOCABULARY)
    library.no_truncation()
    library.no_padding()
    want = sorted(((i, library.encode(t, add_special_tokens=False).ids) for i, t in kept), key=repr)
    assert got == want


def test_stages_return_the_columns_of_documents(spark, docs, tmp_path):
    from pyspark.sql import functions as F

    spark.createDataFrame([(1, prose(1, 60))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    table = docs([(i, prose(i, 60)) for i in range(3)]).withColumn("kept", F.lit("mine")).withColumn("n_words", F.lit(-7)).withColumn("_key", F.lit("k"))
    found = corpus_pipeline.quality_stage(spark, table, str(tmp_path))
    assert found.columns == table.columns and sorted(map(repr, found.collect())) == sorted(map(repr, table.collect()))
    empty = table.where("false")
    assert corpus_pipeline.quality_stage(spark, empty, str(tmp_path)).count() == 0
