import random

import pytest

import corpus_pipeline
from llm_helpers import SF_SMALL, make_docs, sentence


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Toxic rows, a passage many documents share, copies and near copies, clean rows, nulls."""
    rng = random.Random(11)
    rows, labels = [], []
    passage = sentence(rng, 60)
    for i in range(300):
        text = "\n".join(sentence(rng, rng.randint(8, 60)) for _ in range(rng.randint(1, 3)))
        if i % 6 == 0:
            text += "\nsuch a nincompoop and blatherskite you are"
        if i % 10 == 1:
            text += "\n" + passage
        rows.append((i, text, "en", f"s{i % 4}"))
        labels.append((i, 1, int(i % 6 == 0)))
    for k in range(20):  # one line each, so that line dedup leaves an empty text of the later ones
        rows.append((400 + k, rows[7][1], "en", "s1"))
        w = rows[8][1].replace("\n", " ").split()
        w[k % len(w)] = f"edit{k}"
        rows.append((500 + k, "\n".join(" ".join(w[j:j + 4]) for j in range(0, len(w), 4)), "en", "s2"))
    rows += [(None, None, None, None), (900, "", "en", "s3")]
    top = str(tmp_path_factory.mktemp("sf"))
    make_docs(spark, rows, clash=True).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    return top, rows, passage


def test_stages_act_and_keep_the_columns(spark, folder, tmp_path):
    top, rows, passage = folder
    docs = spark.read.parquet(f"{top}/documents.parquet")
    columns, kept = docs.columns, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, top)
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert out.columns == columns, name
        kept.append(docs.collect())
    toxic = {r[0] for r in rows if r[0] is not None and r[0] < 300 and r[0] % 6 == 0}
    after = [r.doc_id for r in kept[0]]
    assert len(toxic & set(after)) <= 2 and len(after) >= len(rows) - len(toxic) - 2
    assert len(kept[1]) == len(kept[0]) and sum(passage in (r.text or "") for r in kept[1]) == 1
    ids = [r.doc_id for r in kept[2]]
    near = [i for i in ids if i is not None and 500 <= i < 520]
    assert len(near) < 20 and len(ids) == len(set(ids)) and None in ids and 900 in ids
    assert {r.doc_id for r in kept[3]} <= set(ids) and kept[3]
    tokens = {}
    for r in kept[4]:
        tokens[r.sequence_id] = tokens.get(r.sequence_id, 0) + r.length
    assert tokens and max(tokens.values()) <= 4096


def test_run_equals_its_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    from eventide.llm.common import materialize
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF_SMALL), "stage")
    drop = ["sequence_id", "offset", "start", "length", "ids", "ids_crc32"]  # placement follows file order
    one = sorted(map(str, docs.drop(*drop).distinct().collect()))
    assert one == sorted(map(str, corpus_pipeline.run(spark, SF_SMALL).drop(*drop).distinct().collect()))
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "n-gram Jaccard join", "mixing", "packing"]
