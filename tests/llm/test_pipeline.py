from __future__ import annotations

import duckdb

import corpus_pipeline
from tests.llm.test_decontamination import by_hand as leaks
from tests.llm.test_simhash import groups_by_hand, plain_fingerprint
from threatsieve.llm import pieces, quality, surrogates


def test_every_stage_by_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "pii_surrogates", "sentencepiece_encoding"]
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept.append({r.doc_id: r for r in docs.collect()})
        assert k == 4 or docs.columns == columns
    before = {i: t for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()}
    model = quality.fit_on(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = dict(zip(before, model.scores(quality.feature_matrix((t or "").encode() for t in before.values())), strict=True))
    assert set(kept[0]) == {i for i, score in scores.items() if score >= 0.3}
    groups = groups_by_hand({i: plain_fingerprint(r.text or "") for i, r in kept[0].items()})
    assert set(kept[1]) == set(groups.values())
    items = duckdb.sql(f"SELECT item_id, text FROM '{sf_dir}/benchmark.parquet'").fetchall()
    found = {i for i, _ in leaks([(i, r.text) for i, r in kept[1].items()], items)}
    assert set(kept[2]) == set(kept[1]) - found
    assert {i: r.text for i, r in kept[3].items()} == {i: surrogates.replaced(r.text, surrogates.DEFAULT_KEY)[0] for i, r in kept[2].items()}
    coder = pieces.lattice(pieces.default_model(), 3)
    assert set(kept[4]) == set(kept[3]) and all(r.decodes for r in kept[4].values())
    assert all(coder.decode(kept[4][i].ids) == r.text for i, r in kept[3].items())


def test_run_is_the_stages_in_order(spark, sf_dir, tmp_path):
    small = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 0")
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    small.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
