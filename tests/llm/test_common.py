"""Samples for the driver."""

from distaff.llm import common, html_extract


def test_copies_are_drawn_once(spark):
    texts = [f"text {i}" for i in range(300)]
    alone = spark.createDataFrame([(t,) for t in texts], "text string")
    copies = alone.union(spark.createDataFrame([(t,) for t in texts[:5] for _ in range(200)], "text string")).repartition(7)
    for limit in (1, 40, 300, 1000):
        wanted = [r.text for r in common.hashed_sample(alone, limit, "text").collect()]
        assert [r.text for r in common.distinct_sample(copies, limit, "text").collect()] == wanted
        assert len(wanted) == min(limit, 300)
    assert common.distinct_sample(alone.limit(0), 5, "text").count() == 0


def test_page_copies_do_not_fill_the_fitting_pages(spark, monkeypatch):
    page = "<html><body><article><p>{}</p></article></body></html>"
    rows = [(page.format("words " * (9 + i)),) for i in range(60)] + [(page.format("copied " * 20),)] * 60
    read = []
    monkeypatch.setattr(html_extract, "article_of", lambda text, f=html_extract.article_of: read.append(text) or f(text))
    html_extract.fit_extractor(spark.createDataFrame(rows, "html string"), fit_pages=61, layouts=1)
    assert len(read) == len(set(read)) == 61
