from pyspark.sql import functions as F

import corpus_pipeline
from speechtable import settings
from speechtable.llm import quality_rules
from tests.llm.brute import covered, texts
from tests.llm.test_jaccard import brute_kept
from tests.llm.test_models import base_counts


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        kept.append(settings.materialize(stage(spark, kept[-1], sf), f"stage-{k}"))
    assert all(df.columns == columns for df in kept[:-1])
    rows = [{r["doc_id"]: r["text"] for r in df.collect()} for df in kept[:-1]]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    # Rules: base failures go, texts stay as they are, clean documents stay.
    passed = {i for i, t in rows[0].items() if (c := base_counts(t))[0] >= 50 and 2 * c[4] <= c[0]}
    assert rows[1].keys() <= passed and all(rows[1][i] == rows[0][i] for i in rows[1])
    assert all(i in rows[1] for i in passed if labels.get(i) == 1)
    assert {i for i in rows[1] if labels.get(i) == 1} == {i for i in rows[2] if labels.get(i) == 1}
    assert sum(labels.get(i) == 0 for i in rows[2]) <= 0.2 * sum(v == 0 for v in labels.values())
    # Near duplicates: the smallest id of each component stays.
    assert sorted(rows[3]) == brute_kept(rows[2])
    # Repeats: only bytes that the rule names go, and none is left but parts of characters.
    gone = covered({i: t.encode() for i, t in rows[3].items()}, 50)
    for i, text in rows[3].items():
        at, left = 0, []
        for ch in text:
            size = len(ch.encode())
            if not all(gone[i][at : at + size]):
                left.append(ch)
            at += size
        assert rows[4][i] == "".join(left)
    packed = kept[-1].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("total")).collect()
    assert {r["doc_id"] for r in packed} == rows[4].keys() and all(r["n"] == r["total"] for r in packed)


def test_clashing_columns_nulls_and_ties(spark, sf):
    text = " ".join(f"wort{i}" for i in range(80))
    rows = [(1, text, "a", 1, 0.5), (1, text, "a", 1, 0.5), (2, text + " ende", "b", None, None), (None, text, None, 3, 0.1), (3, None, "c", 1, 0.2), (4, "", "d", 2, 0.1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, id int, score double")
    for stage in (corpus_pipeline.rules, corpus_pipeline.classifier, corpus_pipeline.near_duplicates, corpus_pipeline.repeated_passages):
        assert stage(spark, docs, sf).columns == docs.columns
    near = corpus_pipeline.near_duplicates(spark, docs, sf).collect()
    assert sorted(((r["doc_id"] or 0), r["kept"]) for r in near if r["text"]) in ([(0, None), (1, "a")], [(0, None), (1, "a"), (2, "b")])
    assert corpus_pipeline.run.__doc__ and len(corpus_pipeline.STAGES) == 5
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_columns_of_any_name_travel_along(spark, sf):
    text = " ".join(f"wort{i}" for i in range(80))
    names = ["_row", "_place", "a.b", "c`d", "_w", "_lines", "words", "row", "doc", "id", "place", "_kept"]
    rows = [(i, text if i < 3 else f"{text} {'neu ' * i}", *(f"{n}{i}" for n in names)) for i in range(5)] + [(None, "kurz", *names)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, sf)
        assert found.columns == docs.columns
        for r in found.collect():
            i = "" if r[0] is None else r[0]
            assert list(r)[2:] == [f"{n}{i}" for n in names]
    assert {r[0] for r in corpus_pipeline.near_duplicates(spark, docs, sf).collect()} >= {None, 0}
    counted = quality_rules.judge(docs, [0] * 64)
    assert counted.columns[: len(docs.columns)] == docs.columns and {r["_w"] for r in counted.collect()} == {"_w", *(f"_w{i}" for i in range(5))}
