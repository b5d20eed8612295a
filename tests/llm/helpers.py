"""Small tables for the tests."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _doc long"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", 0, 7) for i, t in zip(ids, texts)], SCHEMA)
