import shutil
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))

import __spark_entry__  # noqa: E402
import corpus_pipeline  # noqa: E402
from addrlink.llm import packing, quality_classifier, quality_rules, simhash  # noqa: E402
from addrlink.llm.queries import ORACLES, QUERIES, tokenizer  # noqa: E402

from .test_simhash import brute_components, brute_fingerprint  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {t.stem} AS SELECT * FROM '{t}'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert Counter(map(tuple, got.select(*want.columns).collect())) == Counter(want.fetchall())


def test_registered():
    names = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "simhash", "packing"]


def test_pipeline_by_brute_force(spark, tmp_path):
    """Every stage written and read again, and held against a plain version on its own input."""
    docs, step = spark.read.parquet(f"{SF}/documents.parquet"), {}
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        step[name] = (docs, spark.read.parquet(str(tmp_path / name)))
        docs = step[name][1]
        if k < 3:
            assert docs.columns == columns

    before, after = step["quality_rules"]
    kept = Counter(r["doc_id"] for r in quality_rules.judge(before).where("kept").collect())
    assert Counter(r["doc_id"] for r in after.collect()) == kept and 0 < len(kept) < before.count()

    before, after = step["quality_classifier"]
    model = quality_classifier.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    rows = before.collect()
    good = [r["doc_id"] for r, s in zip(rows, model.score([r["text"] for r in rows])) if s >= 0.5]
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(good)

    before, after = step["simhash"]
    rows = before.collect()
    least = brute_components([(r["doc_id"], brute_fingerprint(r["text"])) for r in rows])
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(set(least.values()))

    before, after = step["packing"]
    assert Counter(r["doc_id"] for r in after.where("piece = 0").collect()) == Counter(r["doc_id"] for r in before.collect())
    total = after.agg({"length": "sum"}).first()[0]
    assert after.select("sequence_id").distinct().count() <= 1.02 * total / packing.CAPACITY + 1


def test_pipeline_of_odd_rows(spark, tmp_path, odd_docs):
    """Nulls, repeats, long texts and extra columns go through every stage."""
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    shutil.copytree(f"{SF}/labels.parquet", tmp_path / "labels.parquet") if Path(f"{SF}/labels.parquet").is_dir() else \
        shutil.copy(f"{SF}/labels.parquet", tmp_path / "labels.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {4} <= {r["doc_id"] for r in pieces}
    assert simhash.RADIUS == 4 and tokenizer(spark, "word_bpe_49k.json")
