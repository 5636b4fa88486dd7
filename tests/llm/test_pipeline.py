import random
import uuid

import corpus_pipeline
from shardloom.llm.common import materialize, scratch_root

rng = random.Random(2)
EN = "the of and to in that is was with for on are by this it as be at or from have".split()
DE = "der die und das nicht ist ein mit auf für sich dem des im den eine als auch".split()


def words(lang, n=60):
    return " ".join(rng.choice(lang) + rng.choice(lang) for _ in range(n))


def test_stages(spark, tmp_path):
    rows = [(i, words(EN if i % 3 else DE), "en" if i % 3 else "de", "s", 1, "x", "y") for i in range(120)]
    rows += [(200 + i, " ".join(w + "###" for w in words(EN).split()), "en", "s", 1, "x", "y") for i in range(60)]
    copy = rows[5][1]
    rows += [(300, copy, "de", "s", 1, "x", "y"), (301, copy + " end", "de", "s", 1, "x", "y"), (302, None, "en", "s", 0, "x", "y"), (303, "", "en", "s", 0, "x", "y"), (304, words(EN) + " password=abcdefgh1", "en", "s", 1, "x", "y"), (7, rows[7][1], "en", "s", 1, "x", "y")]
    kind = "doc_id long, text string, lang string, source string, n_chars long, score string, blob string"
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200), 0) for i in [*range(120), *range(200, 260)]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, str(tmp_path)), f"test-{name}")
        if name != "packing":
            assert docs.columns == names
            kept[name] = sorted(r["doc_id"] for r in docs.collect())
    assert 302 not in kept["language"] and 303 not in kept["language"] and len(kept["language"]) == len(rows) - 2
    assert [i for i in kept["quality"] if 200 <= i < 260] == [] and len([i for i in kept["quality"] if i < 120]) >= 119
    assert 300 not in kept["near_dedup"] and 301 not in kept["near_dedup"] and kept["near_dedup"].count(7) == 1
    assert kept["secrets"] == kept["near_dedup"]
    assert {r["doc_id"] for r in docs.collect()} == set(kept["secrets"])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def test_different_texts_of_one_id_stay(spark):
    a, b, c, d = (words(EN) for _ in range(4))
    rows = [(7, a, 1), (7, b, 2), (7, c, 3), (7, a, 1), (3, a + " end", 4), (9, b + " end", 5), (9, d, 6), (8, None, 7), (8, "", 8), (8, None, 7), (None, a, 9), (None, a, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place long")
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert got.columns == docs.columns
    # a is kept as 3's, b as 7's, though 9 has it as well
    want = [(7, b, 2), (7, c, 3), (3, a + " end", 4), (9, d, 6), (8, None, 7), (8, "", 8), (None, a, 9), (None, a, 9)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_secrets_of_earlier_runs_are_not_scanned_again(spark, monkeypatch):
    name = f"shardloom/test-ledger-{uuid.uuid4().hex}"  # a process may get the number, and so the folder, of an earlier one
    monkeypatch.setattr(corpus_pipeline, "LEDGER", name)
    docs = spark.createDataFrame([(1, "my password=abcdefgh1"), (2, "clean"), (3, None)], "doc_id long, text string")
    want = [(1, "my [secret]"), (2, "clean"), (3, None)]
    ledger = lambda: spark.read.parquet(f"{scratch_root(spark)}/{name}").count()
    assert sorted(map(tuple, corpus_pipeline.without_secrets(spark, docs, "").collect())) == want and ledger() == 3
    more = docs.unionByName(spark.createDataFrame([(4, "token=zzzzzzzz9")], docs.schema))
    assert sorted(map(tuple, corpus_pipeline.without_secrets(spark, more, "").collect())) == [*want, (4, "[secret]")] and ledger() == 4


def test_empty_documents(spark, tmp_path):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([], kind)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0
