"""The pipeline as a whole: planted rows, awkward rows, clashing names, an empty table."""

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long, `__id` int, `__again` string"
ITEM = "Thtieding. Onhe in haedea it ha with orbleat thesstea heerthly. Erensh oron nt thinorsh erresh that anonhath to thntin onst"


def write(spark, folder, rows):
    frame = spark.createDataFrame([(i, t, lang, None, None, 7, "x") for i, t, lang in rows], DOCS)
    frame.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return frame


def test_stages_and_run(spark, tmp_path):
    words = "kato mira solun tarik velon basta nido rupa gelon fisk".split()
    own = lambda i: " ".join(words[(i * 7 + k * (i % 5 + 1)) % 10] + str(i) * (k % 3 == 0) for k in range(30))
    rows = [(i, own(i), "aa") for i in range(40)]
    rows += [(100, own(3) + " end", "aa"), (101, f"kato {ITEM} mira", "aa"), (102, "kato mira a@b.cc solun", "aa"), (103, None, None), (104, "12 ½", None), (None, "kato tarik", None), (105, "kato " * 5000, "aa"), (105, "mira solun", "aa")]
    frame = write(spark, tmp_path, rows)
    kept, seen = frame, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.checkpoint(stage(spark, kept, str(tmp_path)))
        assert kept.columns == frame.columns
        seen[name] = {(r.doc_id, r.text) for r in kept.collect()}
    ids = {name: {i for i, _ in found} for name, found in seen.items()}
    assert {103, 104}.isdisjoint(ids["language"]) and set(range(40)) | {100, 101, 102, 105, None} <= ids["language"]
    assert ids["language"] - ids["near_duplicates"] == {100} and sum(i == 105 for i, _ in seen["near_duplicates"]) == 2
    assert ids["near_duplicates"] - ids["decontamination"] == {101}
    assert (102, "kato mira [EMAIL] solun") in seen["pii"] and len(seen["pii"]) == len(seen["decontamination"])
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == ids["pii"] and sum(r.n_tokens for r in packed if r.doc_id == 105) == 5002


def test_empty_documents(spark, tmp_path):
    write(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
