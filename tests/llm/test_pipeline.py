import corpus_pipeline
from drawloom.llm import suffix_dedup


def test_stages_keep_the_columns_of_documents(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    last = docs.count()
    for name, f in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(f(spark, docs, d).toPandas(), docs.schema)
        n = docs.count()
        assert last * 0.5 < n <= last, name
        assert docs.select("doc_id").distinct().count() == n
        last = n
    out = corpus_pipeline.STAGES[-1][1](spark, docs, d)
    assert out.select("doc_id").distinct().count() == last


def test_cut_repeats(spark):
    shared = "é" + " ".join(str(i * 7919 % 1000) for i in range(80))
    rows = [(1, "head " + shared + " tail ü", 9), (2, shared, 9), (3, "mine " + shared, 9), (4, None, 9), (None, "alone", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in suffix_dedup.cut_repeats(df).collect()}
    assert set(got) == {1, 3, 4, None} and got[4] == (None, 9) and got[None] == ("alone", 9)
    assert got[1][0].split() == ["head", "tail", "ü"] and got[1][1] == len(got[1][0])
    assert got[3][0].split() == ["mine"]


def test_texts_are_cut_in_one_python_process_a_task(spark):
    df = spark.createDataFrame([(1, "a", 1)], "doc_id long, text string, n_chars int")
    plan = suffix_dedup.cut_repeats(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_nulls_repeats_clashes_and_empty_tables(spark, tmp_path):
    prose = lambda k, n: " ".join("".join(chr(97 + int(c)) for c in str((i + k * 1000) * 7919)) for i in range(n))
    rows = [(1, prose(1, 60)), (1, prose(1, 60)), (2, prose(1, 60).upper()), (3, prose(3, 80) + " x"), (4, prose(3, 80) + " y"), (None, prose(5, 30)), (None, prose(5, 30)), (7, None), (7, None), (8, ""), (9, prose(9, 40))]
    names = "doc_id long, text string"
    df = spark.createDataFrame(rows, names).selectExpr("*", "'x' as lang", "1 as k1", "2 as k2", "3 as key_0", "true as stays", "cast(null as string) as source", "length(text) as n_chars")
    labels = spark.createDataFrame([(9, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for name, d in (("some", df), ("none", df.limit(0))):
        folder = str(tmp_path / name)
        d.write.parquet(f"{folder}/documents.parquet")
        (labels if name == "some" else labels.limit(0)).write.parquet(f"{folder}/labels.parquet")
        out = corpus_pipeline.run(spark, folder).collect()
        docs = {r["doc_id"] for r in out if r["doc_tokens"] > 1}
        # equal texts leave the largest id, similar ones the least; of rows that agree in id and text one stays
        assert docs == ({2, 3, None, 9} if name == "some" else set())
        assert sum(r["doc_id"] is None and r["start"] == 0 for r in out) == (name == "some")
