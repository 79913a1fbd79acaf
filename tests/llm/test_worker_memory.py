"""Steps that follow each other in the same Python workers hand their memory back."""

import tracemalloc

from riskframe.llm import op2_neardup as N
from riskframe.llm import op3_bpe as B
from riskframe.llm import op5_pii as P


def test_steps_of_the_near_duplicates_hand_memory_back(spark, monkeypatch):
    whole, wrapped = N.trimmed, []
    monkeypatch.setattr(N, "trimmed", lambda run: wrapped.append(run.__qualname__.split(".")[0]) or whole(run))
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " more"), (3, "something else that is short"), (4, None)], "doc_id long, text string")
    rows = {r.doc_id: r.class_id for r in N.find_classes(docs).collect()}
    assert rows == {1: 1, 2: 1, 3: 3, 4: 4}
    assert {"chunk_parts", "verify", "block_links"} <= set(wrapped)


def test_a_group_of_texts_keeps_equal_words_once():
    codec = B.codec(*B.public_vocabulary())
    texts = [" ".join(f"common{i % 50}" for i in range(300))] * 500
    codec.documents([[1], texts[:1]])
    tracemalloc.start()
    try:
        _, n_tokens, _, _ = codec.documents([list(range(500)), texts])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(n_tokens) == 500 and min(n_tokens) >= 300
    assert peak < 8e6  # an object a word and place are 15 MB


def test_merge_table_is_made_of_plain_numbers():
    ranks = B.load_ranks(B.public_vocabulary()[0])
    tracemalloc.start()
    try:
        table = B.merge_table(ranks)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    rows = set(zip(*(c.to_pylist() for c in table.columns), strict=True))
    assert len(rows) == table.num_rows > 50_000
    names = {k: t for t, k in ranks.items()}
    assert all(names[left] + names[right] == names[k] for left, right, k in rows)
    assert peak < 5e6
    assert B.merge_table({b"a": 0}).num_rows == 0


def test_term_counts_of_personal_data_hand_memory_back(spark, monkeypatch):
    whole, wrapped = P.trimmed, []
    monkeypatch.setattr(P, "trimmed", lambda run: wrapped.append(run.__qualname__.split(".")[0]) or whole(run))
    docs = spark.createDataFrame([(1, "write to ann@example.org now"), (2, None), (3, "write it")], "doc_id long, text string")
    counts = P.term_counts(docs, spark.createDataFrame([("write",), ("absent",)], "term string"))
    assert {r.term: r.df for r in counts.collect()} == {"write": 2}
    assert wrapped == ["term_counts"]
