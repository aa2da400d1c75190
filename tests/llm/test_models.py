import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from speechtable.llm import kneser, quality_rules, queries, rule_ensemble
from tests.llm.brute import WORD, texts


def tokens(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) + ["\n"]


def brute_model(train):
    c, pairs = Counter(), Counter()
    for t in train:
        before = "\n"
        for w in t:
            c[w] += 1
            pairs[before, w] += 1
            before = w
    kinds, types = len(c), len(pairs)
    left = Counter(w for _, w in pairs)
    of = lambda counts: kneser.discounts({f"c{k}": n for k, n in Counter(counts).items()})
    dw, dp = of(left.values()), of(pairs.values())
    spare = sum(dw[min(n, 3)] for n in left.values()) / types
    gone = defaultdict(float)
    for (h, _), n in pairs.items():
        gone[h] += dp[min(n, 3)]

    def p(h, w):
        lower = max(left[w] - dw[min(left[w], 3)], 0) / types + spare / (kinds + 1)
        if h not in c:
            return lower
        n = pairs[h, w]
        return max(n - dp[min(n, 3)], 0) / c[h] + gone[h] / c[h] * lower

    return c, p


def test_kneser_equals_plain_counts(spark, sf):
    want = texts(spark, sf)
    train = {i: t for i, t in want.items() if zlib.crc32(str(i).encode()) % 5 != 1}
    c, p = brute_model([tokens(t) for t in train.values()])
    assert abs(sum(p("\n", w) for w in c) + p("\n", "not a word") - 1) < 1e-9
    total, kinds = sum(c.values()), len(c)
    rows = {r["doc_id"]: r for r in queries.QUERIES["op6_lm_scoring"](spark, sf).collect()}
    assert rows.keys() == want.keys()
    for i, text in want.items():
        t, r = tokens(text), rows[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i not in train, len(t), sum(w in c for w in t), total)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in t), rel_tol=1e-9)
        assert math.isclose(r["score"], sum(math.log10(p(h, w)) for h, w in zip(["\n", *t], t)), rel_tol=1e-9)


def test_kneser_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "The the THE\x0bthe", "x"), (3, "a " * 30000, "x"), (None, "the", "x")],
                                 "doc_id long, text string, n string")
    none = kneser.train(docs.limit(0))
    assert all(r["score"] == 0 and r["n_known"] == 0 for r in kneser.score(docs, none).collect())
    model = kneser.train(docs)
    assert model.tokens == 5 + 4 + 30000 + 1
    got = sorted((r["id"] or 0, r["n_tokens"]) for r in kneser.score(docs, model).collect() if math.isfinite(r["score"]))
    assert got == [(0, 2), (1, 1), (2, 1), (3, 5), (3, 30001)]
    assert kneser.score(docs.limit(0), model).count() == 0


def base_counts(text):
    w = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(w, w[1:], w[2:]))
    place = {k for i, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for k in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in text or ""), dup, len(place)


def bucket(*words):
    import xxhash

    seed = 42
    for word in words:
        seed = xxhash.xxh64_intdigest(word.encode(), seed)
    return (seed - (1 << 64) if seed >> 63 else seed) % quality_rules.BUCKETS


def test_quality_rules_equal_plain_counts(spark, sf):
    want = texts(spark, sf)
    good = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    grams = {}
    for i, t in want.items():
        w = WORD.findall(t)
        grams[i] = [bucket(x) for x in w] + [bucket(x, y) for x, y in zip(w, w[1:])]
    raw, target = Counter(), Counter()
    for i, g in grams.items():
        raw.update(g)
        if i in good:
            target.update(g)
    share = sum(target.values()) / sum(raw.values())
    weight = {b: round(1e6 * math.log((target[b] + quality_rules.PRIOR) / (raw[b] * share + quality_rules.PRIOR))) for b in raw}
    for r in queries.QUERIES["op3_quality_rules"](spark, sf).collect():
        i = r["doc_id"]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base_counts(want[i])
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        score = sum(weight[b] for b in grams[i]) / len(grams[i]) / 1e6
        assert r["base_failed"] == failed and abs(r["score"] - score) < 1e-9
        assert r["kept"] == (not failed and score >= quality_rules.THRESHOLD)


def test_quality_rules_edges(spark):
    rows = [(1, None), (2, ""), (3, "\x0b \n\t"), (4, "a\n\na\n a\na"), (5, "word " * 20000), (5, "a b c a b c"), (None, "é #*$ <|>&%")]
    docs = spark.createDataFrame([(i, t, "k", 7) for i, t in rows], "doc_id long, text string, kept string, _x int")
    got = quality_rules.judge(docs, [0] * 8).collect()
    assert sorted((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == sorted(base_counts(t) for _, t in rows)
    assert all(r["_x"] == 7 for r in got)
    trusted = spark.createDataFrame([(None,), (9,)], "doc_id long")
    assert set(quality_rules.weights(docs, trusted, buckets=16)) == {0}
    assert quality_rules.judge(docs.limit(0), [0] * 8).count() == 0


def test_one_pass_counts_both_multinomials(spark):
    rows = [(1, "a b"), (1, "a"), (2, "a c"), (None, "a b"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    flagged = docs.selectExpr("text", "doc_id <=> 1 AS good")
    got = {r["bucket"]: (r["n"], r["n_flagged"]) for r in quality_rules.bucket_counts(flagged, "text", quality_rules.BUCKETS, "good").collect()}
    assert got == {bucket("a"): (4, 2), bucket("b"): (2, 1), bucket("c"): (1, 0), bucket("a", "b"): (2, 1), bucket("a", "c"): (1, 0)}
    # Repeated trusted ids count once, null ids trust nobody.
    weight = quality_rules.weights(docs, spark.createDataFrame([(1,), (1,), (None,)], "doc_id long"))
    share = 4 / 10
    for place, (n, good) in got.items():
        assert weight[place] == round(1e6 * math.log((good + quality_rules.PRIOR) / (n * share + quality_rules.PRIOR)))


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op8_quality_classifier"](spark, sf)
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.95


def test_rules_from_printed_trees():
    text = """RandomForestClassificationModel: numTrees=1
  Tree 0 (weight 1.0):
    If (feature 0 <= 1.5)
     If (feature 2 > 0.25)
      Predict: 0.0
     Else (feature 2 <= 0.25)
      Predict: 1.0
    Else (feature 0 > 1.5)
     Predict: 1.0
"""
    got = {r.tests for r in rule_ensemble.paths(text)}
    a, b = rule_ensemble.STATS[0], rule_ensemble.STATS[2]
    assert got == {((a, "<=", 1.5),), ((a, ">", 1.5),), ((a, "<=", 1.5), (b, ">", 0.25)), ((a, "<=", 1.5), (b, "<=", 0.25))}


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(1, None, 5, "s"), (1, "", 5, "s"), (2, "a | b", 5, "s"), (None, "x " * 9000, 5, "s")], "doc_id long, text string, words int, score string")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    for labelled, score in ((labels, 1 - 1e-6), (labels.limit(0), 0.5)):
        got = rule_ensemble.classify(docs, labelled, F.lit(True)).collect()
        assert len(got) == 4 and all(abs(r["score"] - score) < 1e-9 for r in got)
    assert rule_ensemble.classify(docs.limit(0), labels, F.lit(True)).count() == 0


def test_native_plans_have_no_python(spark, sf):
    for name in ("op3_quality_rules", "op9_chat_formatting"):
        plan = queries.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_registered():
    names = entry.queries()
    assert {f"op{k}" for k in range(1, 11)} | {"pipeline"} <= {n.split("_")[0] for n in names}


@pytest.mark.parametrize("c,want", [({}, [0, 0.5, 0.5, 0.5]), ({"c1": 4}, [0, 1, 1, 1])])
def test_discounts_without_counts(c, want):
    assert kneser.discounts(c).tolist()[:2] == want[:2]
