"""The insight report reads stored sales, so that they are joined once."""

from tillwise.catalog import sources


def test_report_joins_the_sales_once(tables, monkeypatch):
    handed = {}
    plain = sources.insight_report

    def kept(sales, customers, articles, features):
        handed.update(sales=sales, features=features)
        return plain(sales, customers, articles, features)

    monkeypatch.setattr(sources, "insight_report", kept)
    text = sources.s13(tables).first().value
    for frame in handed.values():
        assert "Join" not in frame._jdf.queryExecution().optimizedPlan().toString()
    assert f"{tables.sales.count()} transactions" in text
