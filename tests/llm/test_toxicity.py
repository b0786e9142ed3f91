import numpy as np

from drawloom.llm.toxicity import Model, drop_toxic, fit, fit_features, graded, likelihood, score

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = fit(docs, labels.where("doc_id % 4 <> 0"), max_rows=3000)
    assert model.thresholds == sorted(model.thresholds)
    held = score(docs, model).join(labels.where("doc_id % 4 = 0").selectExpr("doc_id", "toxic as label"), "doc_id").select("toxic", "label", "expected_severity").collect()
    clean = [r for r in held if not r["label"]]
    bad = [r for r in held if r["label"]]
    assert sum(r["toxic"] for r in clean) / len(clean) < 0.02
    assert sum(r["toxic"] for r in bad) / len(bad) > 0.75  # about a sixth of the labels have no ground in the text
    assert np.mean([r["expected_severity"] for r in bad]) > 10 * np.mean([r["expected_severity"] for r in clean])


def test_likelihood_and_gradients_equal_brute_force():
    r = np.random.default_rng(0)
    lists = [r.choice(9, r.integers(0, 6), replace=False) for _ in range(50)]
    row, column = np.repeat(np.arange(50), [len(x) for x in lists]), np.concatenate(lists).astype(int)
    grades, w, theta = r.integers(0, 4, 50), r.normal(size=9), np.array([-0.5, 0.4, 1.7])

    def plain(w, theta):
        below = lambda k, eta: 0.0 if k < 0 else 1.0 if k == 3 else 1 / (1 + np.exp(eta - theta[k]))
        return -np.mean([np.log(below(g, sum(w[x])) - below(g - 1, sum(w[x]))) for g, x in zip(grades, lists)])

    value, grad_w, grad_theta = likelihood(w, theta, row, column, grades)
    step = lambda n, i: np.eye(n)[i] * 1e-6
    assert abs(value - plain(w, theta)) < 1e-9
    assert np.allclose(grad_w, [(plain(w + step(9, i), theta) - plain(w - step(9, i), theta)) / 2e-6 for i in range(9)], atol=1e-6)
    assert np.allclose(grad_theta, [(plain(w, theta + step(3, i)) - plain(w, theta - step(3, i))) / 2e-6 for i in range(3)], atol=1e-6)


def test_fit_predicts_held_out_grades():
    r = np.random.default_rng(0)
    name = lambda i: "w" + chr(97 + i // 8) + chr(97 + i % 8)
    words = [sorted({name(int(i)) for i in r.integers(0, 60, 12)}) for _ in range(3000)]
    bad = {name(i) for i in range(4)}
    hurt = np.array([sum(w in bad for w in ws) for ws in words])
    m = fit_features(words[:1500], np.minimum(hurt[:1500], 3))
    above = m.severity([" ".join(ws) for ws in words[1500:]])
    found = (above >= 0.5).sum(1)
    assert (found == np.minimum(hurt[1500:], 3)).mean() > 0.95
    assert {x for x in m.weights if m.weights[x] > 1} == bad


def test_grades_of_toxic_rows_follow_severity():
    r = np.random.default_rng(1)
    words, hurt = [], []
    for i in range(4000):
        bad = int(r.integers(1, 7)) if i % 3 == 0 else 0
        words.append(sorted({f"w{int(x)}" for x in r.integers(10, 90, 12)} | {f"bad{int(x)}" for x in r.choice(8, bad, replace=False)}))
        hurt.append(bad)
    grades = graded((np.array(hurt) > 0).astype(int), words, (0.5,))
    mean = [np.mean(np.array(hurt)[grades == g]) for g in range(3)]
    assert mean[0] == 0 and mean[1] + 2 < mean[2]


def test_nulls_empty_and_no_labels(spark):
    df = spark.createDataFrame([(1, "you awful bad thing"), (None, None), (3, ""), (3, "fine")], "doc_id long, text string").selectExpr("*", "1 as grade", "true as toxic")
    model = Model({"awful": 4.0}, [2.0, 3.0])
    got = {str(r["doc_id"]) + str(r["toxic"]): r["grade"] for r in score(df, model).collect()}
    assert got == {"1True": 2, "NoneFalse": 0, "3False": 0}
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert drop_toxic(df, none).count() == 4 and drop_toxic(df.limit(0), none).count() == 0
    assert graded(np.array([1, 0]), [["a"], ["a"]]).tolist() == [1, 0]


def test_long_texts_and_repeated_ids(spark):
    words = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(17_000))
    rows = [(i, f"fine text {chr(97 + i % 26)} " + ("vile " if i % 2 else "")) for i in range(200)] + [(7, "another vile text"), (300, words), (301, words + " vile")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = df.selectExpr("doc_id", "cast(text like '%vile%' as int) as toxic").distinct()
    kept = drop_toxic(df, labels)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, t in rows if "vile" not in t}
