"""IO4: both branches of loading the feature table."""

SF_SMALL = "/root/testdata/sf0.001"


def test_missing_table_is_derived_and_stored_one_is_loaded(spark, tmp_path):
    from provisio.operators import features as fe
    from provisio.plans.inputs import Inputs
    from provisio.plans.q_sinks import load_or_derive
    from provisio.sources import sinks

    i, path = Inputs(spark, SF_SMALL), str(tmp_path / "features")
    derived = load_or_derive(i, path)
    assert derived.columns == list(fe.FEATURE_COLUMNS) and sinks.path_exists(spark, path)
    assert derived.exceptAll(i.features).isEmpty() and i.features.exceptAll(derived).isEmpty() and not derived.isEmpty()
    stored = str(tmp_path / "stored")
    sinks.write_table(i.features.limit(3), stored)
    assert load_or_derive(i, stored).count() == 3


def test_the_query_loads_what_it_stored(spark, monkeypatch):
    from __spark_entry__ import queries
    from provisio.sources import sinks

    found, exists = [], sinks.path_exists
    monkeypatch.setattr(sinks, "path_exists", lambda s, p: found.append(exists(s, p)) or found[-1])
    assert not queries()["load_features"](spark, SF_SMALL).isEmpty()
    assert found == [False, True]
