import numpy as np

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tessera.llm import packing, pii, quality, superminhash, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_equal_operators_one_by_one(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r.text for r in source.collect()}
    model = toxicity.train(*toxicity.training_sample(source, labels, lambda i: ~toxicity.held_out(i)))
    clean = {i: t for i, t in rows.items() if model.score([(t or "").encode()])[0] < toxicity.THRESHOLD}
    good = {i: t for i, t in clean.items() if quality.verdicts([(t or "").encode()])["kept"][0]}
    sets = {i: set(superminhash.shingle_sets([t.encode()])[0].tolist()) for i, t in good.items()}
    comp = {i: i for i in good}
    changed = True
    while changed:
        changed = False
        for a in good:
            for b in good:
                if a < b and sets[a] and sets[b] and comp[a] != comp[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    changed = True
    one = {i: t for i, t in good.items() if comp[i] == i}
    field = pii.train(pii.training_texts(source.filter(source.doc_id.isin(list(one)))))
    want = {}
    for i, t in one.items():
        ids = np.frombuffer(packing.token_bytes([pii.redact(t, pii.find_spans(t, field)[1]).encode()], corpus_pipeline.public_tokenizers.path("word_bpe_49k.json"))[0], "<u4")
        want[i] = len(ids)
    got = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        assert r.doc_tokens == want[r.doc_id]
    assert got == want
    assert len(one) < len(good) <= len(clean) <= len(rows)


def test_registration():
    names = set(queries())
    assert {f"op{n}_" for n in range(1, 14)} == {n.split("_")[0] + "_" for n in names if n.startswith("op")}
    assert "pipeline" in names and "pipeline" not in oracle_sql()
    assert len(corpus_pipeline.STAGES) == 5
