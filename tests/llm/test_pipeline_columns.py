"""Pipeline stages on documents whose further columns clash with names that stages use."""

import re

SCHEMA = ("source string, n_deleted int, doc_id long, `a.b` string, text string, __id string, Text string, __hash long, n_chars int, "
          "component string, `__quality` double")


def test_stages_keep_columns_of_any_name(spark):
    import corpus_pipeline
    line = "a line of words that recurs in many of the documents here, word for word, all twenty words of it again and again"
    texts = [f"document number {i} speaks of matter {i * 7} and of nothing else at all\n{line}" for i in range(6)]
    texts += [texts[0], None, "", "write to jane.doe7@example.com today about the matter in hand"]
    rows = [("s", i, i, f"ab{i}", t, f"x{i}", f"T{i}", i, len(t or ""), "c", 0.5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA)
    keyed = {r[2]: r for r in rows}
    for name, stage in corpus_pipeline.STAGES[1:4]:
        spark.conf.set("spark.sql.caseSensitive", "true")
        try:
            found = stage(spark, docs, "").collect()
            none = stage(spark, docs.limit(0), "")
            assert none.columns == docs.columns and none.count() == 0
        finally:
            spark.conf.unset("spark.sql.caseSensitive")
        assert {r.doc_id for r in found} <= set(keyed) and len({r.doc_id for r in found}) == len(found)
        for r in found:
            was = keyed[r.doc_id]
            assert [r[i] for i in range(len(was)) if i not in (4, 8)] == [was[i] for i in range(len(was)) if i not in (4, 8)]
            assert r[8] == len(r[4] or "")
        by_id = {r.doc_id: r[4] for r in found}
        if name == "lines":
            assert line in by_id[0] and all(line not in by_id[i] for i in range(1, 6))
        elif name == "near_duplicates":
            assert 6 not in by_id and {7, 8, 9} <= set(by_id)
        else:
            assert not re.search("jane.doe7@", by_id[9]) and by_id[0] == texts[0]


def test_packing_in_small_blocks_gives_the_same_pieces(spark):
    from roomledger.llm.packing import pack_documents
    docs = spark.createDataFrame([(i, None if i == 5 else f"word{i} ünd {i * i} more-words! " * (i % 40)) for i in range(150)],
                                 "doc_id long, text string")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    whole = sorted(pack_documents(docs).select(*columns).collect())
    assert sorted(pack_documents(docs, block_bytes=300, cache_words=20).select(*columns).collect()) == whole


def test_packing_stage_bounds_its_workers(spark, monkeypatch):
    import corpus_pipeline
    seen = {}

    def watched(docs, **bounds):
        seen.update(bounds)
        return spark.createDataFrame([], "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")

    monkeypatch.setattr(corpus_pipeline, "pack_documents", watched)
    corpus_pipeline.packed_sequences(spark, None, "")
    assert seen["block_bytes"] <= 1 << 20 and seen["cache_words"] <= 100_000
