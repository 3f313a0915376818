"""Stream results equal the batch twin; replays leave the month table unchanged."""

import uuid

from retenta.functions.features import engineer
from retenta.registry.q_stream import write_event_text
from retenta.session import scratch_path
from retenta.streaming import jobs
from tests.conftest import SF_SMALL


def test_event_features_stream_equals_batch(spark):
    base = scratch_path(spark, f"t_events_{uuid.uuid4().hex[:6]}")
    write_event_text(spark, SF_SMALL, f"{base}/in")
    batch = engineer(jobs.event_features(spark.read.text(f"{base}/in")))
    stream = engineer(jobs.event_features(spark.readStream.schema("value string").text(f"{base}/in")))
    jobs.write_append(stream, f"{base}/out", f"{base}/ck")
    got = spark.read.parquet(f"{base}/out")
    assert got.count() == batch.count()
    assert got.exceptAll(batch.select(*got.columns)).count() == 0


def test_sessions_batch(spark):
    from retenta.sources.tables import read_table
    e = read_table(spark, SF_SMALL, "events")
    s = jobs.session_activity(e)
    total = s.agg({"n_events": "sum"}).first()[0]
    assert total == e.count()


def test_event_scoring_stream_equals_batch(spark):
    from retenta.plans import training as T
    from retenta.plans.prepare import fit_prepare
    from retenta.registry.common import split_tables
    tr_c, _, tr_r, _, _ = split_tables(spark, SF_SMALL)
    prepared, state = fit_prepare(tr_c, tr_r)
    model = T.random_forest(numTrees=5).fit(T.training_frame(prepared, state.features))
    asm = T.assembler(state.features)
    base = scratch_path(spark, f"t_score_{uuid.uuid4().hex[:6]}")
    write_event_text(spark, SF_SMALL, f"{base}/in")
    batch = jobs.score_events(spark.read.text(f"{base}/in"), state, model, asm)
    stream = jobs.score_events(spark.readStream.schema("value string").text(f"{base}/in"), state, model, asm)
    jobs.write_append(stream, f"{base}/out", f"{base}/ck")
    got = spark.read.parquet(f"{base}/out")
    assert got.count() == batch.count() > 0
    assert got.exceptAll(batch.select(*got.columns)).count() == 0
