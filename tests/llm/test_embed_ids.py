from speechtable.llm import embed
from tests.llm.test_embed import SCHEMA, brute


def test_one_id_with_several_vectors_and_labels(spark):
    rows = [(1, [1.0, 0.0], 1, None), (1, [0.0, 1.0], 1, None), (1, [1.0, 0.0], 2, None), (2, [1.0, 0.01], 1, None), (3, [0.01, 1.0], 1, None),
            (4, [1.0, 0.01], 2, None), (5, [1.0, 0.02], 2, None), (6, [1.0, 1.0], 1, None)]
    got = embed.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["id"], r["n_links"], r["component_id"]) for r in got) == brute(rows)
