"""The pipeline's stages and run() against plain versions, and the operators' SQL."""

from collections import Counter

import numpy as np
import pandas as pd
import pytest
from test_operators import ITEMS, PAGES, make_docs, plain_words, shingle_set, split

import corpus_pipeline
from shardlog.llm import queries


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("sf"))
    rows = [(*r[:5],) for r in make_docs() if r[0] is not None] + [(5000 + i, f"scum vermin filthy number w{i} w{i + 1} w{i + 2} w{i + 7}", "en", "s", 40) for i in range(30)] + [(6000, "so alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").where("item_id in (1, 5)").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(r[0], 1, int(r[0] >= 5000 and r[0] < 6000)) for r in rows if r[0] % 2 == 0], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, rows, seen = docs.columns, docs.collect(), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        path = f"{sf}/out-{name}"
        out.write.parquet(path)
        seen[name], before = spark.read.parquet(path).collect(), rows
        if name == "packing":
            break
        assert out.columns == columns
        docs, rows = spark.read.parquet(path), seen[name]
        if name == "toxicity":
            assert not {r.doc_id for r in rows} & set(range(5000, 5030))
            assert len(rows) == len(before) - 30
        if name == "near_dedup":
            sets = [(r.doc_id, shingle_set(r.text)) for r in rows]
            for k, (i, a) in enumerate(sets):
                for j, b in sets[:k]:
                    assert i != j and not (a and 100 * len(a & b) >= 75 * len(a | b))
        if name == "substring_dedup":
            assert len(rows) == len(before)
            for a, b in zip(sorted(before), sorted(rows), strict=True):
                assert len(split(b.text)) <= len(split(a.text))
        if name == "decontamination":
            assert 6000 in {r.doc_id for r in before} and {r.doc_id for r in rows} == {r.doc_id for r in before if "alpha beta gamma delta epsilon zeta eta theta iota kappa" not in " ".join(plain_words(r.text))}
    assert {r.doc_id for r in seen["packing"]} == {r.doc_id for r in rows}
    whole = corpus_pipeline.run(spark, sf).collect()
    key = lambda rs: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rs)
    assert key(whole) == key(seen["packing"])


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, sf, name, tmp_path):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet/*.parquet'")
    rng = np.random.default_rng(1)
    spark.createDataFrame([(i, rng.normal(0, 0.2, 64).tolist()) for i in range(120)], "vec_id long, embedding array<float>").write.mode("overwrite").parquet(f"{sf}/embeddings.parquet")
    c.sql(f"create view embeddings as select * from '{sf}/embeddings.parquet/*.parquet'")
    spark.createDataFrame(PAGES, "page_id long, url string, html string").write.mode("overwrite").parquet(f"{sf}/pages.parquet")
    c.sql(f"create view pages as select * from '{sf}/pages.parquet/*.parquet'")
    got = queries.QUERIES[name](spark, sf).toPandas()
    want = c.sql(queries.ORACLE[name]).df()
    cols = sorted(got.columns)
    text = lambda v: "null" if v is None or v is pd.NA or v != v else str(int(v)) if isinstance(v, float) else str(v)
    rows = lambda d: Counter(tuple(map(text, x)) for x in d[cols].astype(object).itertuples(index=False, name=None))
    assert cols == sorted(want.columns) and rows(got) == rows(want)
