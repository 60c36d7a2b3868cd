"""Defined cases of the classifier, language, mixing and page operators, and brute force."""

import re
import time

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shopmetrics.llm import op3_langid, op5_quality_classifier, op6_quality_rules, op9_html, op10_mixing
from tests.conftest import SF_SMALL

CLASH = "doc_id long, text string, lang string, source string, l_id int, grade int, f_id int, cells int, h int, at int, n int"


def test_langid_needs_a_letter(spark):
    rows = [(1, "½ ² ① 5"), (2, "́́"), (3, "12 ... _"), (4, "été déjà vu " * 30)]
    docs = spark.createDataFrame([(i, t, "fr", "s", 1, 1, 1, 1, 1, 1, 1) for i, t in rows], CLASH)
    got = {r["doc_id"]: r for r in op3_langid.predict(docs, {"fr": op3_langid.top_grams(*op3_langid.gram_counts(rows[3][1]))}).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 4)] == ["und", "und", "und", "fr"] and got[4]["score"] == 1.0
    # a vowel sign stays inside its word
    assert len(op3_langid.gram_counts("कि")[0]) == len(op3_langid.gram_counts("ab")[0])
    assert op3_langid.predict(docs.limit(0), {}).count() == 0


def test_langid_distance_is_out_of_place(spark):
    profiles = {"a": np.array([5, 3, 9, 7]), "b": np.array([3, 5, 1, 2])}
    mine = np.array([3, 5, 7, 8])
    want = {k: sum(abs(list(p).index(g) - i) if g in p else op3_langid.PROFILE for i, g in enumerate(mine)) for k, p in profiles.items()}
    ready = [(k, np.sort(p), np.argsort(p, kind="stable")) for k, p in profiles.items()]
    lang, score = op3_langid.nearest(mine, ready)
    assert lang == min(want, key=want.get) and abs(score - (1 - want[lang] / (op3_langid.PROFILE * 4))) < 1e-12


def test_classifier_with_clashing_columns_and_a_hot_id(spark):
    texts = {1: "good clean words of prose here", 2: "bad nasty toxic stuff there"}
    rows = [(i % 2 + 1, texts[i % 2 + 1], None, None, 7, 7, 7, 7, 7, 7, 7) for i in range(200)] + [(None, None, None, None, 1, 1, 1, 1, 1, 1, 1)]
    docs = spark.createDataFrame(rows, CLASH)
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (2, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = op5_quality_classifier.fit(docs, labels)
    assert model is not None
    scored = op5_quality_classifier.score(docs.select("doc_id", "text"), F.coalesce("text", F.lit("")), model).select("doc_id", "verdict.*").distinct().collect()
    grade = {r["doc_id"]: r["expected_grade"] for r in scored}
    assert grade[1] > grade[2] and len(scored) == 3
    # the tail is the logistic of the summed weights against the upper threshold
    weights, cut = model
    cells = docs.filter("doc_id = 1").limit(1).select(op5_quality_classifier.features(F.col("text"), op5_quality_classifier.letters(F.col("text"))).alias("c")).first()["c"]
    tail = 1 / (1 + np.exp(cut[-1] - weights[cells].sum()))
    assert abs(tail - next(r["tail_prob"] for r in scored if r["doc_id"] == 1)) < 1e-5


def test_rules_base_counts_equal_brute_force(spark):
    got = {r["doc_id"]: r for r in op6_quality_rules.op6_quality_rules(spark, SF_SMALL).collect()}
    for doc_id, text in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect():
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        where: dict = {}
        for i in range(len(words) - 2):
            where.setdefault(tuple(words[i:i + 3]), []).append(i)
        again = {j for at in where.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again))
        r = got[doc_id]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["score"] >= op6_quality_rules.MIN_SCORE)


def mixed(spark, rows, parts):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, h int, at int").repartition(parts)
    plan = op10_mixing.plan_mix(docs, op10_mixing.word_count())
    return plan.select("row.*", "size", "target", (F.col("size") * F.size("draws")).alias("taken")).toPandas()


def test_mix_meets_targets_with_null_and_repeated_ids(spark):
    """A source of rows without ids, one of a single id, and one of equal rows come near their targets."""
    rows = [(None, "w " * (3 + i % 5) + str(i), "a", 1, 1) for i in range(1500)] + [(7, "v " * (2 + i % 7) + str(i), "b", 1, 1) for i in range(1500)]
    rows += [(9, "x y z", "c", 1, 1)] * 3000 + [(i, "u " * 5, None, 1, 1) for i in range(1500)] + [(-1, None, "d", 1, 1)]
    got = mixed(spark, rows, 5)
    by = got.fillna({"source": "~"}).groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    assert (abs(by.taken - by.target) <= by.most).all() and (got.taken <= 2 * got["size"]).all() and len(got) == len(rows)
    again = mixed(spark, rows, 3)  # equal rows change places, their draws do not
    key = ["doc_id", "text", "source", "taken"]
    assert sorted(map(str, got[key].values.tolist())) == sorted(map(str, again[key].values.tolist()))


def test_page_time_grows_with_its_length():
    for piece in ("<b ", '<a "', "<div>x", "<script ", "<ul><b>", "<li>x</li>", "<p><b><div>x</div>", '<a class="'):
        spent = []
        for n in (20_000, 80_000):
            start = time.perf_counter()
            op9_html.extract(piece * n, None)
            spent.append(time.perf_counter() - start)
        assert spent[1] < 9 * spent[0] + 0.2, piece  # four times the length


def test_pages_without_end_and_odd_rows(spark, tmp_dir):
    assert op9_html.extract("<p>a < b <c and <b>d</b>", None) == "a < b d"  # <c and <b> is one tag
    assert op9_html.extract("<p>x</p><!-- <p>y", None) == "x" and op9_html.extract("<script>a", None) == ""
    nested = "<div>" * 5000 + "deep" + "</div>" * 5000
    assert op9_html.extract(nested, None) == "deep"
    rows = [(1, None, "<p>a</p>", 1, 1), (1, None, "<p>a</p>", 1, 1), (None, "http://h/", None, 1, 1), (2, "x", "", 1, 1)]
    schema = "page_id long, url string, html string, path int, host int"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/pages.parquet")
    got = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in op9_html.op9_html(spark, tmp_dir).collect())
    assert got == [("1", "a", 1), ("1", "a", 1), ("2", "", 0), ("None", "", 0)]
    assert op9_html.main_text(spark.createDataFrame([], schema)).count() == 0


def test_empty_tables(spark, tmp_dir):
    spark.createDataFrame([], CLASH).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    for query in (op3_langid.op3_langid, op5_quality_classifier.op5_quality_classifier, op6_quality_rules.op6_quality_rules):
        assert query(spark, tmp_dir).count() == 0
    assert pd.DataFrame(op10_mixing.op10_mixing(spark, tmp_dir).collect()).empty
