"""MLlib classifier: class guard, save / load round trip, result flattening."""

from pyspark.sql import functions as F

from quire.operators import model as MD


def test_train_save_load_and_flatten(spark, tmp_dir):
    rows = ([(i, "the cat and the dog with the", "en") for i in range(8)]
            + [(100 + i, "der die und das mit sich", "de") for i in range(8)]
            + [(200 + i, "el y los las", "es") for i in range(3)])  # fewer than 5: left out
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    model = MD.train_classifier(df, "text", "label", min_docs=5, max_iter=10, num_features=1 << 10)
    assert model.stages[-1].getLabels() == ["de", "en"]
    MD.save_model(model, f"{tmp_dir}/m")
    again = MD.load_model(f"{tmp_dir}/m")
    s1 = {r.doc_id: r.doc_type for r in MD.score(model, df, "doc_id").collect()}
    s2 = {r.doc_id: r.doc_type for r in MD.score(again, df, "doc_id").collect()}
    assert s1 == s2 and s1[0] == "en" and s1[100] == "de"
    nested = spark.createDataFrame(
        [(1, [("memo", 0.9, [(1,), (2,)]), (None, 0.2, [])])],
        "id long, documents array<struct<doc_type:string,confidence:double,"
        "bounding_regions:array<struct<page_number:int>>>>")
    flat = MD.flatten_results(nested, "id").collect()
    assert [(r.doc_type, r.pages) for r in flat] == [("memo", [1, 2])]


# ---- the model of counts -------------------------------------------------------------

TRAIN = [("a", "red red blue"), ("a", "red"), ("b", "blue green, Green"), ("b", "the"), ("c", "lonely"), ("a", None), (None, "red")]


def by_hand(train, texts, min_docs=2):
    import math
    import re

    words = lambda t: re.findall(r"\w+", (t or "").lower())
    docs = {}
    for y, t in train:
        if y is not None and t is not None:
            docs.setdefault(y, []).append(words(t))
    docs = {y: d for y, d in sorted(docs.items()) if len(d) >= min_docs}
    vocab = {w for d in docs.values() for ws in d for w in ws}
    n = sum(map(len, docs.values()))
    out = []
    for t in texts:
        s = {}
        for y, d in docs.items():
            all_words = [w for ws in d for w in ws]
            s[y] = math.log(len(d) / n) + sum(math.log((all_words.count(w) + 1) / (len(all_words) + len(vocab))) for w in words(t) if w in vocab)
        best = max(s, key=s.get)
        out.append((best, round(s[best], 9), round(1 / sum(math.exp(x - s[best]) for x in s.values()), 9)))
    return out


def test_counts_give_the_predictions_computed_by_hand(spark, tmp_dir):
    from quire.operators import count_model as CM

    train = spark.createDataFrame(TRAIN, "y string, t string")
    texts = ["red blue", "Green unknown green", "", None, "the the red", "nothing known"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    model = CM.fit(train, "t", "y", min_docs=2)
    CM.save(model, f"{tmp_dir}/m")

    def got(m):
        return [(r["doc_type"], round(r["log_score"], 9), round(r["confidence"], 9)) for r in CM.score(m, docs, "id", "t").orderBy("id").collect()]

    assert model.labels() == ["a", "b"]
    assert got(CM.load(spark, f"{tmp_dir}/m")) == got(model) == by_hand(TRAIN, texts)


def test_models_of_parts_add_up(spark):
    from quire.operators import count_model as CM

    parts = [spark.createDataFrame(TRAIN[:3], "y string, t string"), spark.createDataFrame(TRAIN[3:], "y string, t string")]
    both = CM.merge(*[CM.fit(p, "t", "y", min_docs=1) for p in parts])
    whole = CM.fit(parts[0].unionByName(parts[1]), "t", "y", min_docs=1)
    assert both.labels() == whole.labels() == ["a", "b", "c"]
    assert sorted(map(tuple, both.terms.collect())) == sorted(map(tuple, whole.terms.collect()))
    assert sorted(map(tuple, both.classes.collect())) == sorted(map(tuple, whole.classes.collect()))


def test_a_model_of_nothing(spark):
    from quire.operators import count_model as CM

    model = CM.fit(spark.createDataFrame([], "y string, t string"), "t", "y")
    assert CM.score(model, spark.createDataFrame([(1, "x")], "id int, t string"), "id", "t").count() == 0


def test_ties_go_to_the_first_label(spark):
    from quire.operators import count_model as CM

    model = CM.fit(spark.createDataFrame([("b", "x"), ("a", "x")], "y string, t string"), "t", "y", min_docs=1)
    r = CM.score(model, spark.createDataFrame([(1, "x")], "id int, t string"), "id", "t").first()
    assert r["doc_type"] == "a" and r["confidence"] == 0.5


def test_a_class_is_trained_by_as_many_tasks_as_its_rows_have(spark, monkeypatch):
    from quire.operators import count_model as CM
    from quire.sources import files as FS

    df = spark.createDataFrame([(y, f"x w{i}") for i in range(20) for y in "ab"], "y string, t string").repartition(4)
    seen, counts = [], CM.word_counts
    monkeypatch.setattr(CM, "word_counts", lambda docs, *a: (seen.append(docs.rdd.getNumPartitions()), counts(docs, *a))[1])
    assert CM.fit(df, "t", "y").classes.first()["tokens"] == 40

    written = MD.cut_lineage
    monkeypatch.setattr(MD, "cut_lineage", lambda data, name: (seen.append(data.rdd.getNumPartitions()), written(data, name))[1])
    MD.train_classifier(df, "t", "y", max_iter=1, num_features=64)
    assert seen == [4, 4]
    none = df.limit(4).unionByName(spark.createDataFrame([(None, "x")] * 9, "y string, t string"))
    assert FS.of_qualifying_classes(none, "y", 5).count() == 0
