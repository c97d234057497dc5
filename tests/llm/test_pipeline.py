import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as engine
import corpus_pipeline
from corpusloom.llm.byte_bpe import encoder
from corpusloom.llm.queries import ORACLES, QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_registration():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES) < set(engine.queries())
    assert "pipeline" in engine.queries()


@pytest.fixture
def tables(spark, tmp_path):
    rng = random.Random(8)
    prose = lambda k: " ".join(f"w{rng.randrange(10**6)}" for _ in range(k))
    item = prose(30)
    clean = ["\n".join(prose(rng.randrange(20, 60)) for _ in range(4)) for _ in range(12)]
    shared = prose(60)
    texts = {k: text for k, text in enumerate(clean)}
    texts[20] = clean[3]  # copy
    texts[21] = clean[4].replace("w1", "v1", 1)  # near copy
    texts[22] = prose(40) + "\n" + prose(20) + " " + item + " " + prose(20)
    texts[23] = "too short"
    texts[24] = "again and again " * 40
    texts[25] = prose(80) + "\n" + shared
    texts[26] = prose(80) + "\n" + shared
    texts[27] = None
    texts[28] = ""
    rows = [(k, t, "en", f"s{k % 2}", None if t is None else len(t)) for k, t in texts.items()]
    rows.append((None, prose(90), None, None, None))
    rows.append(rows[5])
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), texts, shared


def test_stages_take_effect(spark, tables):
    sf_dir, texts, shared = tables
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.work_table(stage(spark, docs, sf_dir))
        assert docs.columns == COLUMNS
        rows = docs.collect()
        assert all(row["n_chars"] in (None, len(row["text"])) for row in rows)
        kept[name] = {row["doc_id"]: row["text"] for row in rows}
    assert set(kept["quality_rules"]) == {*range(12), 20, 21, 22, 25, 26, None}
    lines = kept["line_dedup"]
    assert 20 not in lines and 21 not in lines
    assert lines[25] == texts[25] and lines[26] == texts[26].split("\n")[0]
    assert all(lines[k] == texts[k] for k in range(12))
    assert len(rows) == len(kept["jaccard_join"]) - 1  # the repeated row went before
    assert set(kept["jaccard_join"]) == set(lines)
    assert set(kept["decontamination"]) == set(lines) - {22}
    ran = {row["doc_id"]: row for row in corpus_pipeline.run(spark, sf_dir).collect()}
    own = encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert set(ran) == set(kept["decontamination"])
    for key, row in ran.items():
        ids = np.array(own.encode_ordinary(kept["decontamination"][key]), "<u4")
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()


def test_similar_documents_leave_one_of_each_group(spark):
    base = " ".join(f"a{k}" for k in range(50))
    rows = [(3, base, "en", "s", 0), (1, base + " more", "en", "s", 0), (2, base.upper(), "en", "s", 0)]
    rows += [(None, base, "en", "s", 0), (9, "other words here", None, None, None), (9, "other words here", None, None, None)]
    rows += [(4, None, None, None, None), (5, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = corpus_pipeline.drop_similar_documents(spark, docs, "").collect()
    assert sorted(row["doc_id"] for row in found) == [1, 4, 5, 9]


def test_documents_without_id_or_of_one_id_stay_apart(spark):
    rows = [(key, f"text {n} of its own", "en", "s", n) for n, key in enumerate([None, None, 7, 7])]
    rows += [(None, "leak " * 20 + "of words", None, None, 9), (7, None, None, None, None), (7, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = corpus_pipeline.drop_similar_documents(spark, docs, "").collect()
    assert sorted(map(str, map(tuple, found))) == sorted({str(row) for row in rows})
    extra = docs.withColumn("own_0", F.lit(1)).withColumn("_leak", F.lit(2)).withColumn("key", F.lit(3))
    found = corpus_pipeline.drop_similar_documents(spark, extra, "")
    assert found.columns == extra.columns and found.count() == len(set(rows))


def test_a_leak_without_id_goes_alone(spark, tmp_path):
    words = " ".join(f"word{n}" for n in range(30))
    rows = [(None, f"before {words} after", "en", "s", 1), (None, "something else", "en", "s", 1), (1, "clean", "en", "s", 1)]
    items = spark.createDataFrame([(1, words)], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("_leak", F.lit(1))
    found = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert found.columns == docs.columns
    assert sorted(row["text"] for row in found.collect()) == ["clean", "something else"]


def test_empty_documents(spark, tables):
    sf_dir = tables[0]
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0
