import os
import random

import pytest

import corpus_pipeline
from gondola.llm import simhash
from gondola.session import shared_dir


def tables(folder, spark):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice(["ta", "re", "no", "li", "me", "su"]) for _ in range(rnd.randint(2, 5)))
    texts = {i: "\n".join(" ".join(word() for _ in range(25)) for _ in range(2)) for i in range(150)}
    passage = " ".join(word() for _ in range(14))
    for i in range(0, 60, 2):
        texts[i] += " blargsnurf " + word()
    texts[101] = texts[100] + " " + word()
    texts[103] += "\n" + texts[105].split("\n")[0]
    texts[107] += " " + passage
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()] + [(500, None, None, None, None), (501, "", "en", "s", 0)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, columns).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i < 60 and i % 2 == 0)) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return texts


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    return path, tables(path, spark)


def test_each_stage_on_its_own_input(spark, folder):
    path, texts = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    kept, rows = [], {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        kept.append({r[0]: r for r in docs.collect()})
        if name != "tokens":
            assert docs.columns == columns
    toxic, lines, near, clean, tokens = kept
    assert rows.keys() - toxic.keys() == {i for i in range(0, 60, 2)}
    assert lines.keys() == toxic.keys() and lines[103].text == texts[103].rsplit("\n", 1)[0] or lines[105].text != texts[105]
    assert all(len(r.text or "") == (r.n_chars or 0) for r in lines.values())
    prints = {i: simhash.fingerprint_bits((r.text or "").encode()) for i, r in lines.items()}
    gone = {i for i, p in prints.items() if any(j < i and (p ^ q).bit_count() <= 3 for j, q in prints.items())}
    assert lines.keys() - near.keys() == gone
    assert near.keys() - clean.keys() == {107} and tokens.keys() == clean.keys()


def test_run_returns_the_last_stage(spark, folder):
    path, _ = folder
    scratch = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(scratch))
    got = corpus_pipeline.run(spark, path)
    # Only the last stage's table stays.
    assert [n.rsplit("-", 1)[1] for n in set(os.listdir(scratch)) - before] == [str(len(corpus_pipeline.STAGES) - 1)]
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 80
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity"


def test_empty_tables_and_clashing_columns(spark, folder, tmp_path):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), path).count() == 0, name
    more = {c: "x" for c in ("_doc", "_key", "_gone", "_d", "_k", "row", "key", "bad", "gone", "print", "node", "id")}
    wide = docs.selectExpr("*", *[f"'{v}' as `{c}`" for c, v in more.items()]).limit(20)
    twice = wide.unionByName(wide.selectExpr("doc_id", "concat(text, ' twice') as text", *[f"`{c}`" for c in wide.columns[2:]]))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, twice, path).columns == twice.columns, name
