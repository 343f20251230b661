import hashlib
import shutil

from corpus_fixtures import SMALL, prepared  # noqa: F401
import corpus_pipeline
import numpy as np
import pytest
from test_llm_near import brute as near
from test_llm_tokens import THEIRS

from quadrille.llm.langid import keep_identified, learn
from quadrille.llm.mixing import mix, quality_weights


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The small tables, with copies, near copies and rows that the first stage rejects."""
    where = tmp_path_factory.mktemp("tables")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(120)
    rows = [tuple(r) for r in docs.collect()]
    last = max(r[0] for r in rows)
    more = [(last + 1, rows[3][1].upper(), "en", "src1", 1), (last + 2, "1234 5678", "en", "src1", 9), (last + 3, None, "en", None, 0)]
    spark.createDataFrame(rows + more, docs.schema).write.parquet(f"{where}/documents.parquet")
    shutil.copy(f"{SMALL}/labels.parquet", f"{where}/labels.parquet")
    return str(where)


def test_rows_of_the_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [(r.doc_id, r.text) for r in keep_identified(docs, learn(docs)).collect()]
    assert docs.count() - len(kept) == 2
    last = {}
    for i, t in sorted(kept):
        last["".join(c.lower() if "A" <= c <= "Z" else c for c in t)] = i
    kept = [(i, t) for i, t in kept if i in last.values()]
    classes = near(kept)
    kept = [(i, t) for i, t in kept if classes[i][0] == i]
    ids = [i for i, _ in kept]
    plan = mix(docs.where(docs.doc_id.isin(ids)), quality=quality_weights(spark.read.parquet(f"{folder}/labels.parquet")))
    copies = {r.doc_id: r.copies for r in plan.collect()}
    want = []
    for i, t in kept:
        ids = THEIRS.encode_ordinary(t)
        digests = [hashlib.sha256(b).hexdigest() for b in (np.array(ids, "<u4").tobytes(), t.encode())]
        want += [(i, len(ids), *digests)] * copies[i]
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(want)


def test_stages_keep_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "encoding"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns, name
        assert stage(spark, docs.limit(0), folder).count() == 0, name
