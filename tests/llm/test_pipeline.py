import corpus_pipeline as P
from prefspark.llm import decontaminate, pii, quality, sentencepiece

SF = "/root/testdata/sf0.01"


def test_stages_work_on_what_the_one_before_kept(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = [docs]
    for name, stage in P.STAGES:
        path = scratch(name)
        stage(spark, seen[-1], SF).write.parquet(path)
        seen.append(spark.read.parquet(path))
    assert all(d.columns == columns for d in seen[:-1])
    ids = [{r["doc_id"] for r in d.collect()} for d in seen]
    assert all(a >= b for a, b in zip(ids, ids[1:]))
    kept = {r["doc_id"] for r in quality.query(spark, SF).where("kept").collect()}
    assert ids[1] == kept
    from test_simhash_dedup import brute, fingerprint

    rows = [(r["doc_id"], r["text"]) for r in seen[1].collect()]
    assert ids[2] == set(brute([i for i, _ in rows], [fingerprint(t) for _, t in rows]))
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    bad = {r["id"] for r in decontaminate.contaminated(seen[2], items).collect()}
    assert bad and ids[3] == ids[2] - bad
    marked = {r["id"] for r in pii.find(seen[3]).where("size(base) > 0").collect()}
    before, after = ({r["doc_id"]: r["text"] for r in d.collect()} for d in seen[3:5])
    assert {i for i in before if before[i] != after[i]} == marked
    last = seen[-1].collect()
    assert all(r["round_trip"] for r in last) and {r["doc_id"] for r in last} == ids[4]
    text = {r["doc_id"]: r["text"] for r in seen[4].collect()}
    spelled = sentencepiece.Vocabulary().spelling
    assert all(b"".join(spelled[i] for i in r["ids"])[1:].decode() == text[r["doc_id"]] for r in last[:50])


def test_run_is_the_stages(spark):
    out = P.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "ids", "n_tokens"} <= set(out.columns) and out.count() > 0
