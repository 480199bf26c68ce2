"""Landing files, upserts and incremental ingestion."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ticketmill.operators import comments as M
from ticketmill.operators import tickets as K
from ticketmill.plans import jobs
from ticketmill.schemas import INTENTS, RAW_TICKETS, conform
from ticketmill.session import fresh_path, settle
from ticketmill.sources import landing as L
from ticketmill.sources import tables as S
from ticketmill.streaming import ingest as I


def line(i, updated="2024-01-16T14:00:00Z", **more):
    return {"id": i, "subject": "Devolución", "description": "¿Cuánto demora?", "created_at": "2024-01-15T10:30:00Z",
            "updated_at": updated, "tags": ["devolución"], "via": {"channel": "email"}, "assignee_id": 9,
            "status": "open", "priority": "high", "requester": {"email": "c@example.com"},
            "comments": [{"id": 1, "body": "Gracias 😊", "author_id": 100}, {"id": 2, "body": "b", "author_id": 2, "public": None}],
            **more}


def land(path, *records):
    path.mkdir(exist_ok=True)
    name = path / f"{len(list(path.iterdir()))}.json"
    name.write_text("\n".join(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in records), encoding="utf-8")


def test_landing_parse(spark, tmp_path):
    land(tmp_path / "in", line(1), line(2, requester=5, tags=None, via=None, comments=None), "bad", {"id": 3},
         line(4, created_at="nonsense"), line(5, requester="x", assignee_id=None))
    got = {r.ticket_id: r for r in L.read_tickets(spark, str(tmp_path / "in")).collect()}
    assert set(got) == {1, 2, 5}
    assert "😊" in got[1].comments_json and json.loads(got[1].comments_json)[0]["public"] is True
    assert json.loads(got[1].comments_json)[1]["public"] is None
    assert got[1].created_at == datetime(2024, 1, 15, 10, 30) and got[1].requester_email == "c@example.com"
    assert (got[2].requester_email, got[2].tags, got[2].channel, got[2].comments_json) == (None, [], None, "[]")
    assert L.bad_lines(L.landing_lines(spark, str(tmp_path / "in"))).count() == 3


COMMENTS = "ticket_id long, seq long, id long, body string, author_id long, public boolean, created_at string"


def test_comments_attach_in_order_one_row_a_ticket(spark):
    tickets = spark.createDataFrame([(1, "s", "d"), (2, "s", None), (3, "s", "d")], "ticket_id long, subject string, description string")
    rows = [(1, i, i, f"c{i}", 5, True, None) for i in range(25)] + [(1, None, 99, "unplaced", 5, True, None), (2, 0, 0, "x", 5, None, None)]
    comments = spark.createDataFrame(rows, COMMENTS).repartition(5)
    for size in (4, 10, 10_000):
        got = {r.ticket_id: r for r in M.attach_comments(tickets, comments, piece_size=size).collect()}
        assert sorted(got) == [1, 2, 3] and got[1].subject == "s" and got[3].comments_json == "[]"
        assert [c["body"] for c in json.loads(got[1].comments_json)] == [f"c{i}" for i in range(25)] + ["unplaced"]
        assert json.loads(got[2].comments_json)[0]["public"] is None


def test_large_ticket_that_grows_is_cleaned_whole(spark):
    from ticketmill.operators.cleaning import clean_tickets
    from ticketmill.operators.labels import cluster_examples

    tickets = spark.createDataFrame([(1, None, "d", "chat")], "ticket_id long, subject string, description string, channel string").selectExpr(
        "*", "timestamp'2024-01-01' AS created_at", "timestamp'2024-01-01' AS updated_at", "array() AS tags")
    clean = S.table(spark, fresh_path(spark, "c"), "clean.tickets").ensure()
    for n in (3, 9):
        comments = spark.createDataFrame([(1, i, i, f"c{i}", 5, True, None) for i in range(n)], COMMENTS)
        rows = settle(L.to_raw_rows(M.attach_comments(tickets, comments, piece_size=4)), "raw")
        assert jobs.run_clean(rows, clean)["processed"] == 1
        direct = clean_tickets(M.attach_comments(tickets, comments)).first().text_customer_only
        assert [r.text_customer_only for r in clean.read().collect()] == [direct] == ["\n\n".join(["d", *(f"c{i}" for i in range(n))])]
    clusters = spark.createDataFrame([(1, 0, 0.0)], "ticket_id long, cluster_id long, distance_to_centroid double")
    assert cluster_examples(clusters, clean.read(), 1).count() == 1


def raw(spark, *rows):
    """(id, subject, created day, updated day)"""
    df = spark.createDataFrame(
        [(i, s, datetime(2024, 1, c), datetime(2024, 1, u)) for i, s, c, u in rows],
        "ticket_id long, subject string, created_at timestamp, updated_at timestamp")
    return L.to_raw_rows(df)


@pytest.fixture
def target(spark):
    return S.table(spark, fresh_path(spark, "t"), "raw.tickets", bucket_rows=10).ensure()


def subjects(table):
    return {r.ticket_id: (r.subject, r.created_at.day) for r in table.read().collect()}


def test_upsert_keeps_created_at_and_overwrites_with_null(spark, target):
    assert (lambda r: (r.inserted, r.updated))(target.upsert(raw(spark, (1, "a", 1, 1), (25, "b", 1, 1)))) == (2, 0)
    r = target.upsert(raw(spark, (1, None, 9, 9), (2, "c", 3, 3)))
    assert (r.inserted, r.updated) == (1, 1)
    assert subjects(target) == {1: (None, 1), 25: ("b", 1), 2: ("c", 3)}


def test_repeated_key_in_a_batch_counts_once_and_the_newest_wins(spark, target):
    r = target.upsert(raw(spark, (1, "old", 1, 1), (1, "new", 1, 5), (1, "mid", 1, 3)))
    assert (r.inserted, r.updated) == (1, 0) and subjects(target) == {1: ("new", 1)}


def test_same_batch_twice_is_the_same_as_once(spark, target):
    batch = raw(spark, (1, "a", 1, 1), (2, "b", 1, 1))
    target.upsert(batch)
    once = subjects(target)
    assert target.upsert(batch).updated == 2 and subjects(target) == once
    first = target.upsert(raw(spark, (1, "z", 1, 2)), stream="s", batch_id=0)
    again = target.upsert(raw(spark, (1, "z", 1, 2)), stream="s", batch_id=0)
    assert not first.skipped and again.skipped


def many(spark, ids):
    return raw(spark, *((i, "x", 1, 1) for i in ids))


def test_only_touched_buckets_are_rewritten(spark, target):
    target.upsert(many(spark, range(60)))
    before = target._snapshot()["buckets"]
    assert len(before) >= 5
    target.upsert(raw(spark, (3, "c", 1, 1)))
    after = target._snapshot()["buckets"]
    assert after[0] != before[0] and after[1:] == before[1:]
    assert subjects(target) == {**{i: ("x", 1) for i in range(60)}, 3: ("c", 1)}


def test_sparse_ids_end_in_few_buckets(spark, target):
    ids = [(i * 0x9E3779B97F4A7C15) % 2**63 - 2**62 for i in range(100)]
    for at in range(0, 100, 25):
        target.upsert(many(spark, ids[at:at + 25]))
    assert sorted(subjects(target)) == sorted(ids)
    assert len(target._snapshot()["buckets"]) <= 12
    one = S.table(spark, fresh_path(spark, "one"), "raw.tickets").ensure()
    one.upsert(many(spark, ids))
    assert len(one._snapshot()["buckets"]) == 1


@pytest.mark.parametrize("flip", [False, True])
def test_equal_times_are_settled_by_the_whole_order(spark, flip):
    schema = "user_id long, seq long, updated_at timestamp, created_at timestamp"
    table = S.SnapshotTable(spark, fresh_path(spark, "u"), spark.createDataFrame([], schema).schema, ("user_id",)).ensure()
    rows = [(1, 9, datetime(2024, 1, 1), datetime(2024, 1, 1)), (1, 1, datetime(2024, 1, 1), datetime(2024, 1, 1))]
    for row in reversed(rows) if flip else rows:
        table.upsert(spark.createDataFrame([row], schema), order=("updated_at", "seq"), newest_wins=True)
    assert [r.seq for r in table.read().collect()] == [9]


def test_unfinished_snapshot_is_not_read(spark, target):
    target.upsert(many(spark, [1]))
    S.write_text(spark, f"{target.path}/_log/.000000000009.json-crashed", "{")
    assert sorted(subjects(target)) == [1]


def test_two_writers_cannot_take_the_same_version(spark, target):
    snapshot = {**target._snapshot(), "version": 2}
    target._commit(snapshot)
    with pytest.raises(Exception, match="exist"):
        target._commit(snapshot)


def test_late_rows_lose_when_the_newest_wins(spark, target):
    target.upsert(raw(spark, (1, "new", 1, 9)), newest_wins=True)
    target.upsert(raw(spark, (1, "late", 1, 2)), newest_wins=True)
    assert subjects(target) == {1: ("new", 1)}


def test_required_null_fails_the_write(spark):
    df = spark.createDataFrame([(None,)], "ticket_id long")
    with pytest.raises(Exception, match="required column"):
        conform(df, RAW_TICKETS).collect()


def test_absent_nullable_columns_are_filled(spark):
    df = spark.createDataFrame(
        [("1", 1, "n", 5, "pending", datetime(2024, 1, 1), datetime(2024, 1, 1))],
        "intent_id string, cluster_id long, name string, volume long, status string, created_at timestamp, updated_at timestamp")
    row = conform(df, INTENTS).first()
    assert row.composite_score is None and row.volume == 5


@pytest.fixture(autouse=True, scope="module")
def start_of_time(spark):
    global START
    START = F.lit("2000-01-01").cast("timestamp")


def test_start_holds_for_the_first_run_only(spark, tmp_path, target):
    where, ck, bad = tmp_path / "in", str(tmp_path / "ck"), str(tmp_path / "bad")
    start = F.lit("2024-02-01").cast("timestamp")
    land(where, line(1, updated="2024-01-20T00:00:00Z"), line(2, updated="2024-02-20T00:00:00Z"))
    I.run_incremental(spark, str(where), target, ck, bad, start=start)
    assert sorted(subjects(target)) == [2]
    land(where, line(3, updated="2024-01-20T00:00:00Z"))
    I.run_incremental(spark, str(where), target, ck, bad, start=start)
    assert sorted(subjects(target)) == [2, 3]


def test_default_starts(spark, tmp_path, target):
    from datetime import timedelta, timezone

    def ago(days):
        return (datetime.now(timezone.utc) - timedelta(days=days)).strftime("%Y-%m-%dT%H:%M:%SZ")

    land(tmp_path / "in", line(1, updated=ago(0.5)), line(2, updated=ago(3)), line(3, updated=ago(400)))
    I.run_incremental(spark, str(tmp_path / "in"), target, str(tmp_path / "ck"), str(tmp_path / "bad"))
    assert sorted(subjects(target)) == [1]
    other = S.table(spark, fresh_path(spark, "o"), "raw.tickets").ensure()
    I.run_backfill(spark, str(tmp_path / "in"), other)
    assert sorted(subjects(other)) == [1, 2]


def test_bad_comment_lines_are_stored(spark, tmp_path, target):
    land(tmp_path / "in", line(1), "junk")
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "c.json").write_text('{"ticket_id": 1, "seq": 0, "id": 5, "body": "hi", "author_id": 2}\n{"ticket_id"\n{"body": "lost"}\n')
    got = I.run_backfill(spark, str(tmp_path / "in"), target, comments=str(tmp_path / "c"), start=START, quarantine=str(tmp_path / "q"))
    assert got == {"inserted": 1, "updated": 0, "bad_records": 3}
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "q")).collect()) == ["junk", '{"body":"lost"}', '{"ticket_id"']


def test_faulty_tickets_wait_in_quarantine(spark):
    clean, bad = (S.table(spark, fresh_path(spark, n), n).ensure() for n in ("clean.tickets", "raw.quarantine"))
    base = raw(spark, (1, "a", 1, 1), (2, "b", 1, 1), (3, "c", 1, 1), (4, "d", 1, 1))
    rows = settle(base.withColumn("comments_json", F.expr("element_at(array('[1]', '{}', '\"\"', 'null'), cast(ticket_id as int))")), "raw")
    first = jobs.run_clean(rows, clean, quarantine=bad)
    assert (first["processed"], first["errors"]) == (2, 2)
    assert {r.ticket_id for r in bad.read().collect()} == {1, 4}
    assert jobs.run_clean(rows, clean, quarantine=bad)["errors"] == 0


def test_embedding_hook_counts_failed_batches(spark):
    table = S.table(spark, fresh_path(spark, "e"), "features.embeddings").ensure()
    clean = spark.createDataFrame([(i, "bad" if i == 3 else "fine") for i in range(5)], "ticket_id long, text_customer_only string")

    def encode(texts):
        if "bad" in texts:
            raise ValueError
        return [[1.0, 2.0]] * len(texts)

    assert jobs.run_embeddings(clean, table, encode=encode, batch_size=1) == {"processed": 4, "errors": 1, "total": 5}
    again = jobs.run_embeddings(clean, table, encode=lambda t: [[0.0, 1.0]] * len(t))
    assert again == {"processed": 1, "errors": 0, "total": 1} and table.read().count() == 5


def test_intents_of_lost_clusters_are_retired(spark):
    from ticketmill.operators.labels import intent_summary

    intents = S.table(spark, fresh_path(spark, "i"), "features.intents").ensure()
    clean = spark.createDataFrame([(i, f"word{i % 3} other") for i in range(9)], "ticket_id long, text_customer_only string").withColumn(
        "text_full", F.col("text_customer_only"))

    def clusters(k):
        return spark.createDataFrame([(i, i % k, 0.1 * i) for i in range(9)], "ticket_id long, cluster_id long, distance_to_centroid double")

    jobs.run_labeling(clusters(3), clean, intents)
    jobs.run_labeling(clusters(2), clean, intents)
    assert [r.intent_id for r in intent_summary(intents.read()).collect()] == ["0", "1"] and intents.read().count() == 3
    prompts = jobs.prompts_for(clusters(2), clean, 1, 2).collect()
    assert [(r.cluster_id, r.examples_text.count("Ejemplo")) for r in prompts] == [(0, 2)]


def test_incremental_resumes_and_quarantines(spark, tmp_path, target):
    where, ck, bad = tmp_path / "in", str(tmp_path / "ck"), str(tmp_path / "bad")
    land(where, line(1), line(2), "garbage")
    s = I.run_incremental(spark, str(where), target, ck, bad, start=START)
    assert (s.inserted, s.updated, s.bad_records) == (2, 0, 1)
    assert I.run_incremental(spark, str(where), target, ck, bad, start=START).batches == 0
    land(where, line(2, updated="2024-02-01T00:00:00Z", status="solved"), line(3), {"id": 9})
    s = I.run_incremental(spark, str(where), target, ck, bad, start=START)
    assert (s.inserted, s.updated, s.bad_records) == (1, 1, 1)
    assert {r.ticket_id: r.status for r in target.read().collect()} == {1: "open", 2: "solved", 3: "open"}


def test_stream_result_equals_batch_result(spark, tmp_path, target):
    where = tmp_path / "in"
    land(where, line(1), line(2, updated="2024-03-01T00:00:00Z", status="closed"))
    land(where, line(2, updated="2024-02-01T00:00:00Z"), line(3))
    I.run_incremental(spark, str(where), target, str(tmp_path / "ck"), str(tmp_path / "bad"), START, max_files=1)
    batch = S.table(spark, fresh_path(spark, "b"), "raw.tickets", bucket_rows=10).ensure()
    I.run_backfill(spark, str(where), batch, start=START)
    pick = ("ticket_id", "status", "updated_at")
    assert sorted(target.read().select(*pick).collect()) == sorted(batch.read().select(*pick).collect())


def test_backfill_limit_is_exact_and_start_filters(spark, tmp_path, target):
    land(tmp_path / "in", *[line(i, updated=f"2024-01-{i:02d}T00:00:00Z") for i in range(16, 28)])
    got = I.run_backfill(spark, str(tmp_path / "in"), target, start=F.lit("2024-01-20").cast("timestamp"), limit=3)
    assert got["inserted"] == 3 and sorted(subjects(target)) == [20, 21, 22]


def test_default_time_range_is_a_year(spark):
    df = spark.range(3).select(F.expr("current_timestamp() - make_interval(0, 0, 0, cast(id * 300 as int))").alias("updated_at"))
    assert K.time_range(df).count() == 2


def test_clean_job_is_incremental(spark, target):
    clean = S.table(spark, fresh_path(spark, "c"), "clean.tickets", bucket_rows=10).ensure()
    target.upsert(raw(spark, (1, "a@b.cl", 1, 1), (2, "b", 1, 1)))
    stats = jobs.run_clean(target.read(), clean)
    assert stats == {"processed": 2, "pii_found": 1, "errors": 0, "pii_rate": 0.5}
    target.upsert(raw(spark, (3, "c", 1, 1)))
    assert jobs.run_clean(target.read(), clean)["processed"] == 1
    assert jobs.run_clean(target.read(), clean, reprocess=True)["processed"] == 3
    assert clean.read().count() == 3


def test_no_update_is_lost_while_a_run_is_on(spark, target):
    """A version taken in before the last run stamped its rows is still found, and a re-run touches only what changed."""
    clean = S.table(spark, fresh_path(spark, "c"), "clean.tickets", bucket_rows=10).ensure()
    first = settle(raw(spark, (1, "first", 1, 1), (2, "same", 1, 1), (3, None, 1, 1)), "raw")
    second = settle(raw(spark, (1, "second", 1, 2), (2, "same", 1, 5), (3, None, 1, 1)), "raw")  # arrives while the run is on
    assert jobs.run_clean(first, clean)["processed"] == 3
    stamped = {r.ticket_id: r.processed_at for r in clean.read().collect()}
    assert second.agg(F.max("ingested_at")).first()[0] < min(stamped.values())
    assert jobs.run_clean(second, clean)["processed"] == 1
    after = {r.ticket_id: (r.text_full, r.processed_at) for r in clean.read().collect()}
    assert after[1][0] == "Asunto: second" and after[2][1] == stamped[2] and after[3][1] == stamped[3]
    assert jobs.run_clean(second, clean)["processed"] == 0


def test_input_hash_tells_columns_and_nulls_apart(spark):
    rows = [("a", None, "", "x"), (None, "a", "", "x"), ("a", "", None, "x"), ("", "a", None, "x"), ("a", None, "", "y")]
    df = spark.createDataFrame(rows, "subject string, description string, comments_json string, channel string")
    assert df.select(jobs.input_hash().alias("h")).distinct().count() == len(rows)
