"""The bounded sample of labelled documents: filled up past long, missing and repeated ones."""

from roomledger.llm.common import labelled_sample


def test_sample_is_filled_up(spark):
    docs = [(i, "long " * 50 if i % 4 else f"text {i}") for i in range(200)] + [(0, "text 0 again"), (None, "no id"), (4, None)]
    labels = [(i, i // 4 % 2) for i in range(400)] + [(8, 1), (None, 1), (12, None)]
    frames = (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"))
    texts, ys = labelled_sample(*frames, "quality", 20, 40)
    assert all(ys.count(y) in (20, 21) for y in (0, 1))  # 21 with both rows of a repeated id
    marks = dict(labels[:400])
    assert all(t in ("", "text 0 again") or marks[int(t.split()[1])] == y for t, y in zip(texts, ys))
    every, all_ys = labelled_sample(*frames, "quality", 1000, 40)
    assert sorted(every) == sorted([t or "" for i, t in docs if i is not None and len(t or "") <= 40])
    none = labelled_sample(frames[0].limit(0), frames[1], "quality", 20, 40)
    assert none == ([], [])


def test_queries_hold_out_their_folds(tmp_path, spark):
    """Labels of held-out rows are no input: changing all of them changes no score."""
    import zlib

    from roomledger.llm.quality_classifier import op7_quality_classifier
    docs = [(i, ("good plain words here " * 30) if i % 2 else ("BUY!! $$ ## " * 30) + str(i)) for i in range(60)]
    labels = [(i, i % 2) for i in range(60)]
    held = {i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0}
    results = []
    for name, rows in (("one", labels), ("two", [(i, 1 - y if i in held else y) for i, y in labels])):
        folder = tmp_path / name
        spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame(rows, "doc_id long, quality int").write.parquet(str(folder / "labels.parquet"))
        results.append({r.doc_id: (r.held_out, r.score, r.predicted) for r in op7_quality_classifier(spark, str(folder)).collect()})
    assert results[0] == results[1] and {i for i, r in results[0].items() if r[0]} == held
    assert all(r[2] == i % 2 for i, r in results[0].items())
