"""Term weights against a plain count, and their plan."""

import math
from collections import Counter

from staylytics.operators import reviews


def test_weights_of_repeated_documents(spark):
    rows = [(1, "red room blue"), (1, "blue red"), (2, "red red room"), (3, ""), (4, None), (None, "room blue room")]
    df = spark.createDataFrame(rows, "doc_id long, review string")
    tf = {}
    for key, text in rows:
        words = (text or "").split()
        tf.setdefault(key, Counter()).update(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
    df_of = Counter(t for key in tf for t in tf[key])
    want = {}
    for key, counts in tf.items():
        w = {t: c * (math.log((1 + len(rows)) / (1 + df_of[t])) + 1) for t, c in counts.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        want.update({(key, t): x / norm for t, x in w.items() if key is not None})
    got = {(r["doc_id"], r["term"]): r["weight"] for r in reviews.term_weights(df, "doc_id", "review", []).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_the_vocabulary_is_not_repeated(spark):
    df = spark.createDataFrame([(1, "red room"), (2, "blue room")], "doc_id long, review string")
    plan = reviews.term_weights(df, "doc_id", "review")._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in plan
