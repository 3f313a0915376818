"""Stateful stream jobs over several micro-batches: merging sessions, late rows, restarts, exact distinct counts."""

import datetime as dt

from retenta.streaming import jobs

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def run(spark, base, batches, job, schema):
    """One micro-batch a list of rows; the job stops after each and goes on from its checkpoint."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        jobs.write_append(job(stream), f"{base}/out", f"{base}/ck")
    return sorted(map(tuple, spark.read.parquet(f"{base}/out").collect()))


def text(minutes):
    return at(minutes).strftime("%Y-%m-%d %H:%M:%S")


def test_sessions_grow_merge_and_expire(spark, tmp_path):
    schema = "user_id long, ts timestamp"
    batches = [
        [(1, at(0)), (1, at(50)), (2, at(10))],   # two sessions of client 1 so far
        [(1, at(25)), (1, at(25))],               # joins them
        [(2, at(500)), (1, at(505))],             # the watermark passes the first sessions
        [(2, at(30)), (1, at(510))],              # too late for client 2; client 1 goes on
        [(-1, at(5000))],                         # nothing follows
    ]
    got = run(spark, str(tmp_path), batches, jobs.session_activity, schema)
    assert got == [(1, text(0), text(80), 4), (1, text(505), text(540), 2), (2, text(10), text(40), 1), (2, text(500), text(530), 1)]


def test_exact_types_with_late_rows(spark, tmp_path):
    schema = "user_id long, event_type string, ts timestamp"
    day = 24 * 60
    batches = [
        [(1, f"t{i % 30}", at(i)) for i in range(90)] + [(2, "a", at(5)), (2, "a", at(6))],
        [(1, "t3", at(200)), (1, "t99", at(700)), (1, None, at(900)), (2, "b", at(day + 10))],
        [(1, "z", at(3 * day)), (2, "late but in time", at(3 * day - 30))],
        [(1, "dropped", at(10))],
        [(-1, "end", at(40 * day))],
    ]
    got = run(spark, str(tmp_path), batches, jobs.request_windows_exact, schema)
    assert got == [(1, text(0), 93, 31), (1, text(3 * day), 1, 1), (2, text(0), 2, 1), (2, text(day), 1, 1), (2, text(2 * day), 1, 1)]


def test_clients_joined_with_their_requests(spark, tmp_path):
    clients = "ID_CORRELATIVO long, EDAD double, client_ts timestamp"
    requests = ("ID_CORRELATIVO long, TIPO_REQUERIMIENTO2 string, DICTAMEN string, PRODUCTO_SERVICIO_2 string, "
                "SUBMOTIVO_2 string, request_ts timestamp")
    day = 24 * 60
    steps = [
        ([], [(1, "r", None, "p", "s", at(0)), (1, "r", "x", "p", "t", at(day)), (9, "r", "x", "p", "s", at(day))]),
        ([(1, 30.0, at(10 * day)), (2, 40.0, at(10 * day)), (3, None, at(11 * day))], [(3, "q", "x", None, "s", at(9 * day))]),
        ([], [(1, "new", "y", "p", "s", at(9 * day)), (1, "after", "y", "p", "s", at(12 * day))]),
        ([(-1, None, at(900 * day))], [(-1, None, None, None, None, at(900 * day))]),
        ([(-1, None, at(901 * day))], [(-1, None, None, None, None, at(901 * day))]),
    ]
    base = str(tmp_path)
    for c, r in steps:
        for rows, schema, name in ((c, clients, "c"), (r, requests, "r")):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/{name}")
        read = lambda schema, name: spark.readStream.schema(schema).parquet(f"{base}/{name}")
        jobs.write_append(jobs.client_requests(read(clients, "c"), read(requests, "r")), f"{base}/out", f"{base}/ck")
    got = sorted(map(tuple, spark.read.parquet(f"{base}/out").where("ID_CORRELATIVO > 0").collect()))
    assert got == [(1, 30.0, 3, 2, 2, 1, 2), (2, 40.0, 0, 0, 0, 0, 0), (3, None, 1, 1, 1, 0, 1)]
