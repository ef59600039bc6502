import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    """Every stage against what it promises, on the smallest table."""
    from muster.llm.contamination import mark_contaminated
    from muster.llm.shingles import link_documents
    from muster.llm.surrogates import entities
    from muster.llm.toxicity import fit_toxicity, score_toxicity

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "surrogates", "packing"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before, columns = {r.doc_id: r for r in docs.collect()}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF_DIR)
        after.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name == "toxicity":
            scored = score_toxicity(docs, fit_toxicity(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))).collect()
            want = {r.doc_id for r in scored if not r.predicted}
        elif name == "near_duplicates":
            want = {r.doc_id for r in link_documents(docs, size=5, percent=80).collect() if r.kept}
        elif name == "decontamination":
            marked = mark_contaminated(docs, spark.read.parquet(f"{SF_DIR}/benchmark.parquet")).collect()
            want = {r.doc_id for r in marked if not r.contaminated}
        else:
            want = set(before)
        rows = after.collect()
        assert {r.doc_id for r in rows} == want and want
        if name != "packing":
            assert after.columns == columns and len(rows) == len(want)
            for r in rows:
                same = r.text == before[r.doc_id].text
                assert same if name != "surrogates" else same == (not entities(before[r.doc_id].text or ""))
        docs, before = after, {r.doc_id: r for r in rows}


def test_no_documents(spark):
    empty = spark.createDataFrame([], spark.read.parquet(f"{SF_DIR}/documents.parquet").schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).collect() == []


def test_columns_of_any_name_nulls_and_repeated_rows(spark):
    """Columns named as the operators' own come out as they went in."""
    from pyspark.sql import functions as F

    names = ["items", "spans", "n_words", "contaminated", "score", "kept", "digest", "_id", "_several", "_text", "_digest0"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40)
    docs = docs.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names])
    odd = docs.limit(3).withColumn("text", F.lit(None).cast("string")).unionByName(docs.limit(2).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit("a " * 50_000)}))
    docs = docs.unionByName(odd).unionByName(docs.limit(5))
    for name, stage in corpus_pipeline.STAGES[1:4]:
        after = stage(spark, docs, SF_DIR)
        assert after.columns == docs.columns, name
        for r in after.collect():
            assert all(r[n] is None or r[n].startswith(f"{n} ") for n in names)
