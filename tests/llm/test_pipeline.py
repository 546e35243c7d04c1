import corpus_pipeline
from prepwise.llm import mixing, pieces, toxicity

from .brute import exact_groups, simhash_components

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "mixing", "sentencepiece"]
    outs = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        outs.append((docs, spark.read.parquet(f"{tmp_path}/{k}")))
        docs = outs[-1][1]
    # toxicity: what the scorer rejects goes
    scores = {r["doc_id"]: r["predicted"] for r in toxicity.score_documents(outs[0][0], labels).collect()}
    assert {r["doc_id"] for r in outs[0][1].collect()} == {i for i, p in scores.items() if not p}
    # exact and near duplicates: brute force
    rows = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    assert sorted(r["doc_id"] for r in outs[1][1].collect()) == sorted(g[0] for g in exact_groups(rows(outs[1][0])) if g[3])
    assert sorted(r["doc_id"] for r in outs[2][1].collect()) == sorted(set(simhash_components(rows(outs[2][0]))[1].values()))
    # mixing: as many rows as copies
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(outs[3][0]).collect()}
    got = {}
    for r in outs[3][1].collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {i: c for i, c in copies.items() if c}
    # pieces: decoding gives the texts back
    texts = dict(rows(outs[3][1]))
    vocabulary = pieces.Vocabulary.load()
    for r in outs[4][1].collect():
        assert r["round_trip"] and vocabulary.decode(r["ids"]) == texts[r["doc_id"]]
    assert corpus_pipeline.run(spark, SF).count() == outs[4][1].count()
