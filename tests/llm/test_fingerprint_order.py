"""Fingerprint chain: ties of ids whose texts share a long prefix."""

import hashlib


def test_repeated_ids_with_long_common_prefixes_keep_their_order(spark):
    from roomledger.llm.fingerprints import edited, fingerprint_chain
    rows = [(1, "p" * 40 + c) for c in "dbca"] + [(None, "first"), (2, None), (3, "tail of the table")]
    got = {(r.doc_id, r.n_chars, r.edited_sha256) for r in
           fingerprint_chain(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    order = sorted(((d is not None, d or 0, t or "", d) for d, t in rows))
    want = set()
    for k, (_, _, t, d) in enumerate(order):
        following = order[(k + 1) % len(order)][2]
        want.add((d, len(t), hashlib.sha256(edited(t, following).encode()).hexdigest()))
    assert got == want
