"""The pipeline's stages on planted cases, and its registration."""

import random

import corpus_pipeline
from stratus.llm.common import saved, table
from stratus.llm.queries import ORACLE, QUERIES


def test_stages_remove_what_was_planted_and_keep_the_rest(spark, tmp_path):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice(["lo", "ver", "ta", "min", "ku", "sa", "pel"]) for _ in range(rng.randint(2, 5)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, text(120), "en", f"s{i % 3}", 0) for i in range(240)]
    toxic = set(range(0, 60, 2))
    for i in toxic:
        rows[i] = (i, " ".join(w for v in rows[i][1].split() for w in ((v, "grobnik") if rng.random() < 0.05 else (v,))) + " grobnik", *rows[i][2:])
    item = text(30) + ". " + text(8)
    rows += [(300, rows[100][1].replace(" ", "  "), "en", "s0", 0), (301, rows[101][1] + " tail", "en", "s1", 0),
             (302, text(50) + " " + item + " " + text(50), "en", "s2", 0), (303, None, "en", None, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(240)], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = table(spark, str(tmp_path), "documents"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = saved(stage(spark, docs, str(tmp_path)), name)
        seen.append(before - {r.doc_id for r in docs.select("doc_id").collect()})
        assert name == "mixing" or docs.columns == columns
    # of copies equal but for white space the longer stays
    assert seen == [toxic, {100}, {301}, {302}, set()]
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {r.doc_id for r in docs.collect()}


def test_every_operator_is_registered():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
    assert ORACLE.keys() <= QUERIES.keys()
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_take_odd_tables(spark, tmp_path):
    """Clashing column names, null everything, repeated rows, no rows."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, _id string, toxic int, quality string, "
              "size string, doc string, body int, _source string, target string, digest string, item_id long, u int")
    extra = (None, "x", 1, "q", "s", "d", 3, "_", "t", "g", 9, 1)
    texts = [None, "", " ", "a b c d e f g", "a b c d e f g", "w" * 30_000, "\U0001F600 é", "a  b c d e f g"]
    rows = [(None if i % 3 == 0 else i % 5, t, None, None if i % 2 else "s", *extra) for i, t in enumerate(texts * 2)]
    labels = "doc_id long, quality long, toxic long, text string, source string"
    for name, data, kind in (("documents", rows, schema), ("labels", [(1, 1, 0, "x", "y"), (1, None, None, None, None), (None, 0, 1, "", "")], labels),
                             ("benchmark", [(None, None, 1), (1, "", None)], "item_id long, text string, doc_id long"),
                             ("embeddings", [(1, [0.0, 1.0], 3), (None, [1.0, 0.0], None), (2, None, 1)],
                              "vec_id long, embedding array<float>, component int")):
        spark.createDataFrame(data, kind).write.parquet(f"{tmp_path}/full/{name}.parquet")
        spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/none/{name}.parquet")
    for folder, n in (("full", len(rows)), ("none", 0)):
        docs = table(spark, f"{tmp_path}/{folder}", "documents")
        for name, stage in corpus_pipeline.STAGES:
            out = saved(stage(spark, docs, f"{tmp_path}/{folder}"), name)
            assert out.count() <= n and (name == "mixing" or out.columns == docs.columns), name
            docs = out
        for name, query in QUERIES.items():
            got = query(spark, f"{tmp_path}/{folder}").count()
            # op11 reads the vectors: two of them, along one component with variance
            assert got == {"op1_decontaminate": 0, "op11_whitening": 2 if n else 0}.get(name, n), name
