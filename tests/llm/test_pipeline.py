from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.rows import prose
from tests.llm.test_packing import check
from tests.llm.test_rules import junk
from tests.llm.test_simhash import slow_classes, slow_fingerprint


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    letters = {"aa": "abcdefghij", "bb": "klmnopqrst"}
    rows = []
    for i in range(240):
        lang = "aa" if i % 2 else "bb"
        text = junk(i // 6) if i % 6 == 0 else prose(i, 30 + i % 80, letters[lang])
        rows.append((i, text, lang, f"s{i % 3}", len(text)))
    rows += [(1000 + i, rows[2 * i + 1][1], "aa", "s0", None) for i in range(20)]
    rows += [(2000, None, None, None, None), (2001, "", "aa", None, 0), (2002, "1234 5678 " * 30, None, "s1", 300), (None, prose(500, 90), None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 6 != 0), 0) for i in range(240)]
    spark.createDataFrame(labels, "doc_id long, quality long, toxic long").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages(spark, folder, tmp_path):
    from tokenizers import Tokenizer

    from tidegauge.llm.common import vocabulary

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "packing":
            assert docs.columns == columns
            kept[name] = docs.collect()
    clean = {i for i in range(240) if i % 6}
    ids = {r.doc_id for r in kept["quality classifier"]}
    assert len(ids & clean) >= 0.97 * len(clean) and len([i for i in range(0, 240, 6) if i in ids]) <= 4
    after = {r.doc_id for r in kept["language id"]}
    assert after <= ids and not after & {2000, 2001, 2002} and len(after & clean) == len(ids & clean)
    # one document of each class of near copies stays
    before = [r for r in kept["language id"]]
    label = slow_classes([slow_fingerprint(r.text) for r in before])
    stays = Counter()
    unique = {r.doc_id for r in kept["simhash near-dedup"]}
    for r, x in zip(before, label):
        stays[x] += r.doc_id in unique
    assert set(stays.values()) == {1}
    mixed = kept["mixing to weights"]
    assert {r.doc_id for r in mixed} <= unique and max(Counter(r.doc_id for r in mixed).values()) <= 3
    tokenizer = Tokenizer.from_file(vocabulary(corpus_pipeline.VOCABULARY))
    check(tokenizer, [(r.doc_id, r.text) for r in mixed], docs.collect())
    again = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, again.collect())) == sorted(map(str, docs.collect()))


def test_registered_queries_read_their_tables(spark):
    import __spark_entry__

    names = [n for n in __spark_entry__.queries() if n.startswith("op") and n[2:3].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in __spark_entry__.queries()
