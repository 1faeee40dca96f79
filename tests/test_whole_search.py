"""The registered searches that are whole: what they draw, and their SQL on a smaller search."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from plugtide import config
from plugtide.operators import learn
from plugtide.plans import catalog
from tests.test_pipeline import SF, duck, ordered, shared_stages  # noqa: F401


class Asked(Exception):
    pass


@pytest.mark.parametrize("name", catalog.WHOLE_QUERIES)
def test_every_draw_fold_and_tree_is_searched(monkeypatch, name):
    """The published search: 150 draws on three folds, with its own ranges, in the query and in its SQL."""

    def trained(fx, settings):
        raise Asked(settings)

    monkeypatch.setattr(catalog, "trained", trained)
    entry = catalog.entries()[name]
    with pytest.raises(Asked) as asked:
        entry.run(SimpleNamespace(spark=None))
    settings, published = asked.value.args[0], config.Settings()
    assert (settings.search_iterations, settings.folds) == (published.search_iterations, published.folds) == (150, 3)
    assert settings.search_spaces == config.SEARCH_SPACES and settings.grain == "points"
    jobs = entry.extra()["plans_points_s"].split("VALUES ")[1].split(") p(job")[0]
    for model in learn.MODELS:
        drawn = learn.draw_settings(model, settings)
        assert jobs.count(f"'{model}'") == 150 * 4
        assert all(f"'{model}', {draw}, -1, {int(model == 'forest')}, {d['trees']}, " in jobs for draw, d in enumerate(drawn))
        assert max(d["trees"] for d in drawn) > 2400


@pytest.mark.parametrize("name", catalog.WHOLE_QUERIES)
def test_sql_of_any_number_of_trees_agrees(spark, duck, name):  # noqa: F811
    entry = catalog.model_entries(catalog.BY_POINT, "_points", "", whole=True)[name]
    df = entry.query(spark, SF)
    result = duck.execute(entry.oracle)
    columns = [d[0] for d in result.description]
    assert ordered(df.columns, df.collect()) == ordered(columns, result.fetchall())
