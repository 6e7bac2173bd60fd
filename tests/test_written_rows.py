"""Rows that several steps read are written once: the wide rows of the dense ids, the scores of the season chain."""

import pytest

from conftest import SF_SMALL
from medalcast.operators.boosting import HistogramGBTModel
from medalcast.operators.modeling import load_model, save_model


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_rows_with_ids_run_the_joins_once(spark):
    from medalcast.plans.q_features import dense_row_id_wide
    assert "lineitem.parquet" not in _plan(dense_row_id_wide(spark, SF_SMALL))


def test_the_chain_scores_its_rows_once_and_loaded_models_score_batches(spark, monkeypatch, tmp_path):
    from medalcast.plans import q_model

    class Seen(Exception):
        pass

    def curves(pred, *_):
        assert "ArrowEvalPython" not in _plan(pred) and "predicted_votes_raw" in pred.columns
        raise Seen
    monkeypatch.setattr(q_model, "_FITTED", {})
    monkeypatch.setattr(q_model, "BOOST_TREES", 2)
    monkeypatch.setattr(q_model, "calibrate_curves", curves)
    with pytest.raises(Seen):
        q_model.season_chain(spark, SF_SMALL)
    (model, data), = q_model._FITTED.values()
    save_model(model, str(tmp_path / "m"))
    again = load_model(str(tmp_path / "m"))
    assert isinstance(model.stages[-1], HistogramGBTModel) and isinstance(again.stages[-1], HistogramGBTModel)
    assert "ArrowEvalPython" in _plan(again.transform(data))
