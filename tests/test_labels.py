"""Label replies, prompts, scores and KPIs."""

from ticketmill.operators import intents as T
from ticketmill.operators import kpis
from ticketmill.operators import labels as B


def test_reply_shapes(spark):
    long = "x" * 300
    rows = [
        (1, '{"name": "A", "description": "B"}'), (2, '```json\n{"name": "A", "description": "B"}\n```'),
        (3, '```\n{"name": "A"}\n```'), (4, '{"description": "B"}'), (5, long), (6, '{"name": null}'), (7, "[1]"),
    ]
    df = spark.createDataFrame(rows, "i int, reply string")
    got = {r.i: (r.name, r.description, r.is_faulty) for r in B.parse_labels(df).collect()}
    assert got[1] == got[2] == ("A", "B", False) and got[3] == ("A", "", False)
    assert got[4] == ("Sin clasificar", "B", False) and got[5] == ("Sin clasificar", "x" * 200, False)
    assert got[6] == (None, "", False) and got[7][2] is True


def test_examples_and_prompt(spark):
    clusters = spark.createDataFrame(
        [(i, 0, float(i % 4)) for i in range(12)] + [(50, -1, 0.0)], "ticket_id long, cluster_id long, distance_to_centroid double")
    clean = spark.createDataFrame(
        [(i, "t" * 600 if i == 0 else f"t{i}", "f") for i in range(1, 12)] + [(0, "t" * 600, "f"), (50, "n", "f")],
        "ticket_id long, text_customer_only string, text_full string")
    found = B.cluster_examples(clusters, clean, 4).orderBy("rank").collect()
    assert [r.ticket_id for r in found] == [0, 4, 8, 1]
    text = B.label_prompts(B.cluster_examples(clusters, clean, 2)).first().examples_text
    assert text == "Ejemplo 1:\n" + "t" * 500 + "\n\nEjemplo 2:\nt4"


def test_confidence_bands(spark):
    df = spark.createDataFrame(
        [(1, 0, 0.0), (2, 0, 2.5), (3, 0, 5.0), (4, 0, 5.1), (5, 0, 10.0), (6, -1, 1.0), (7, 1, 0.0)],
        "ticket_id long, cluster_id long, distance_to_centroid double")
    got = {r.ticket_id: (r.confidence_band, r.suggest) for r in T.confidence(df).collect()}
    assert got == {1: ("high", True), 2: ("medium", True), 3: ("medium", True), 4: ("low", False),
                   5: ("low", False), 6: ("low", False), 7: ("high", True)}


def test_rates_of_nothing_are_zero(spark):
    empty = spark.createDataFrame([], "action string")
    r = kpis.feedback_rates(empty).first()
    assert (r.feedback, r.acceptance_rate, r.rejection_rate) == (0, 0.0, 0.0)
