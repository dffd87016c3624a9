import corpus_pipeline as cp


def test_stages_run_on_odd_rows_and_keep_columns(spark, tmp_path):
    rows = [(i, f"document {i} " + " ".join(f"w{(i * 31 + k * k) % 977}" for k in range(80)), "en", f"s{i % 3}", 0) for i in range(60)]
    rows += [(100 + i, rows[i][1], "en", "s0", 0) for i in range(10)] + [(200, None, None, None, None), (201, "", "en", "s1", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(200, 0, 0), (201, 0, 0)], "doc_id long, quality int, toxic int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    ids = []
    for i, (name, stage) in enumerate(cp.STAGES):
        found = stage(spark, now, str(tmp_path))
        if i + 1 < len(cp.STAGES):
            assert found.columns == docs.columns, name
        found.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        ids.append({r["doc_id"] for r in now.select("doc_id").distinct().collect()})
    assert set(range(60)) <= ids[0] and set(range(60)) <= ids[1]
    assert not ids[1] & set(range(100, 110))
    assert ids[3] <= ids[2] and ids[4] == ids[3]
    assert sum(r["length"] for r in now.collect()) > 0
    assert cp.run(spark, str(tmp_path)).count() == now.count()


def test_own_columns_null_and_repeated_ids_stay(spark, tmp_path):
    words = lambda i: " ".join(f"w{(i * 37 + k * k * 3) % 1999}" for k in range(60))
    rows = [(i, f"first line of {i}\n" + words(i), "en", f"s{i % 2}", 1.5, "own", 99, "own") for i in range(40)]
    rows += [(None, words(3), "en", "s0", 2.5, "own", 98, "own"), (None, words(90), None, None, 2.5, None, 98, "own"), (7, rows[7][1], "en", "s1", 1.5, "own", 99, "own"), (50, "x" * 300_000, "en", "s1", 0.5, "own", 97, "own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double, predicted string, removed_lines long, component_id string")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    now = docs
    for name, stage in cp.STAGES[:-1]:
        found = stage(spark, now, str(tmp_path))
        assert found.columns == docs.columns, name
        found.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        got = {(r["score"], r["predicted"], r["removed_lines"], r["component_id"]) for r in now.collect()}
        assert got <= {(r[4], r[5], r[6], "own") for r in rows}, name
        if name in ("quality", "lines", "ngrams"):
            assert now.where("doc_id is null").count() == 2 and now.where("doc_id = 50").count() == 1, name
    assert spark.read.parquet(str(tmp_path / "quality")).count() == len(rows)
    # the null id's line comes first, so document 3 loses its own; both rows of 7 are one
    lines = {r["doc_id"]: r["text"] for r in spark.read.parquet(str(tmp_path / "lines")).where("doc_id in (3, 7)").collect()}
    assert lines == {3: "first line of 3", 7: rows[7][1]}


def test_stages_run_on_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in cp.STAGES:
        found = stage(spark, docs, str(tmp_path))
        assert found.count() == 0, name
