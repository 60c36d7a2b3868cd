"""Classifier, language, rules, mixing, pages and pipeline: bounds and brute force."""

import numpy as np
import pandas as pd

import corpus_pipeline
from shopmetrics.llm import common as C
from shopmetrics.llm import op3_langid, op5_quality_classifier, op6_quality_rules, op9_html, op10_mixing
from tests.conftest import SF_SMALL

SF = SF_SMALL.replace("0.001", "0.01")
ODD = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "... 123", "de", "s", 5), (3, "a word " * 400, None, "s", 9)]
SCHEMA = "doc_id long, text string, lang string, source string, words long"


def test_langid_held_out(spark):
    got = op3_langid.op3_langid(spark, SF).toPandas().merge(pd.read_parquet(f"{SF}/documents.parquet"), on="doc_id")
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97 and got.score.between(0, 1).all()
    odd = spark.createDataFrame(ODD, SCHEMA)
    out = op3_langid.predict(odd, op3_langid.fit(odd)).collect()
    assert len(out) == len(ODD) and [r["lang_pred"] for r in out][0] == "und"


def test_classifier(spark):
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    got = op5_quality_classifier.op5_quality_classifier(spark, SF).toPandas().merge(labels, on="doc_id")
    good = got[(got.quality == 1) & (got.toxic == 0)]
    assert good.kept.mean() > 0.95 and got[got.toxic == 1].kept.mean() < 0.2
    odd = spark.createDataFrame(ODD, SCHEMA)
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert op5_quality_classifier.fit(odd, empty) is None


def test_rules_base_counts(spark, tmp_dir):
    spark.createDataFrame(ODD, SCHEMA).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    got = {r["doc_id"]: r for r in op6_quality_rules.op6_quality_rules(spark, tmp_dir).collect()}
    assert got[3]["n_words"] == 800 and got[3]["n_repeat_words"] == 800 and got[3]["base_failed"] and not got[3]["kept"]
    assert got[None]["n_words"] == 0 and got[2]["n_symbols"] == 0


def test_mix_targets(spark):
    got = op10_mixing.op10_mixing(spark, SF).toPandas().merge(pd.read_parquet(f"{SF}/documents.parquet")[["doc_id", "source"]], on="doc_id")
    by = got.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    assert (abs(by.taken - by.target) <= by.most).all() and (got.taken <= 2 * got["size"]).all()
    assert abs(by.target.sum() / (1.5 * by["size"].sum()) - 1) < 1e-9
    again = op10_mixing.op10_mixing(spark, SF).toPandas()
    assert again.set_index("doc_id").taken.sort_index().equals(got.set_index("doc_id").taken.sort_index())
    odd = spark.createDataFrame(ODD, SCHEMA)
    assert op10_mixing.plan_mix(odd, op10_mixing.word_count()).count() == len(ODD)
    assert op10_mixing.plan_mix(odd.limit(0), op10_mixing.word_count()).count() == 0


def test_leaf_runs_partition_the_quotas():
    quotas = np.array([5, 0, 40, 17])
    runs = [op10_mixing.leaf_runs(quotas, 3, leaf) for leaf in range(8)]
    for s, q in enumerate(quotas):
        cover = sorted(x for start, count in runs for x in range(start[s], start[s] + count[s]))
        assert cover == list(range(q))


def test_pages():
    page = ("<html><body><header>H</header><nav><a>m</a></nav><div class='cookie-notice'>c</div><div class='post-7'><h1>T &amp; t</h1><p>One <b>two</b>"
            "<p>three\n four<script>x<y</script><form>f</form><div class=comments><p>no</p></div></div><footer>F</footer>")
    assert op9_html.extract(page, None) == "T & t\n\nOne two\n\nthree four"
    assert op9_html.extract("", None) == "" and op9_html.extract("<p>a", "no>such") == "a"


def test_pipeline(spark):
    docs = C.table(spark, SF_SMALL, "documents")
    before = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = C.materialize(stage(spark, docs, SF_SMALL), name)
        assert docs.columns == before
    assert 0 < docs.count() < 200
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() > docs.count()


def test_names_do_not_drop_the_article():
    text = "<h1>Title</h1><p>The whole article of this page.</p>"
    want = "Title\n\nThe whole article of this page."
    for wrap in ("<body class='has-sidebar'>{}</body>", "<div class='layout no-sidebar'>{}</div>", "<div class='page with-header'>{}</div>",
                 "<article class='post has-comments'>{}</article>", "<section class='legal news'>{}</section>", "<div id=sidebar><div class=menu>{}</div></div>",
                 "<div class=banner><main>{}</main><p class=ad>buy</p></div><div class=site-footer>f</div>"):
        assert op9_html.extract(wrap.format(text), None) == want, wrap
    long = "<div class='comments'><article class='comment'><p>" + "many words " * 50 + "</p></article></div>"
    assert op9_html.extract(f"<article>{text}</article>{long}", None) == want


def test_vote_keeps_the_whole_article():
    long, short = "word " * 65, "word " * 35
    for page in (f"<article><h1>Title</h1><p>lead</p><div class='content'><p>{long}</p></div><p>end {short}</p></article>",
                 f"<div class=a><h1>Title</h1><p>lead</p>{long}</div><div class=b>{short} end</div>",
                 f"<table><tr><td class=x>Title lead {long}</td><td class=y>{short} end</td></tr></table>",
                 f"<main><article class=a>Title lead {long}</article><article class=b>{short} end</article></main>"):
        parsed = op9_html.parse(page)
        text = op9_html.extract(page, parsed.path_text(op9_html.vote(parsed)))
        assert "Title" in text and "lead" in text and "end" in text and text.count("word") == 100, page
    page = f"<div class=teaser><p>short</p></div><article><p>{long}</p></article>"
    assert op9_html.extract(page, "body>div.teaser") == long.strip()
