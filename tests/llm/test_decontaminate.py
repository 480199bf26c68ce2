import random
import re

from ticketmill.llm import decontaminate

SEPARATORS = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return [w for w in SEPARATORS.split("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]


def brute(docs, items):
    windows = [(i, w[s:s + 10]) for i, t in items for w in [words(t)] if w for s in range(max(1, len(w) - 9))]
    out = {}
    for doc_id, text in docs:
        ws, hit, names = words(text), set(), set()
        for item, w in windows:
            for s in range(len(ws) - len(w) + 1):
                if ws[s:s + len(w)] == w:
                    hit.update(range(s, s + len(w)))
                    names.add(str(item))
        out[doc_id] = (len(ws), sorted(hit), sorted(names))
    return out


def test_against_brute_force(spark):
    rng = random.Random(1)
    vocabulary = ["the", "of", "A1", "É", "b"] + [f"w{i}" for i in range(30)]

    def some(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    items = [(i, " ".join(some(rng.randint(8, 25)))) for i in range(30)]
    items += [(100, "only two"), (101, "single"), (102, ""), (103, None), (104, items[3][1].upper()), (105, "the of the of the of the of the of the")]
    docs = []
    for i in range(80):
        parts = some(rng.randint(0, 30))
        for _ in range(rng.randint(0, 2)):
            src = (rng.choice(items)[1] or "").split(" ")
            a = rng.randint(0, 5)
            parts += src[a:a + rng.randint(1, 14)] + some(rng.randint(0, 3))
        docs.append((i, rng.choice([" ", ", ", "\n", "\x00", "`~"]).join(parts)))
    docs += [(200, None), (201, ""), (202, "Only\x00TWO singlets"), (203, "the of " * 40), (204, "x " * 3000 + "single")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "'w' AS item_id", "2 AS ws").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "3 AS doc_id")
    got = {r["doc_id"]: (r["n_words"], r["hit"], r["items"]) for r in decontaminate.contaminated(d, b).collect()}
    want = brute(docs, items)
    assert got == want and sum(bool(w[1]) for w in want.values()) > 10
    for r in decontaminate.contaminated(d, b).collect():
        assert r["n_hit"] == len(r["hit"])


def test_empty_sides_and_repeats(spark):
    d = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (2, "c")], "doc_id long, text string")
    b = spark.createDataFrame([(9, "a b"), (9, "a b"), (None, "c")], "item_id long, text string")
    got = sorted(((r["doc_id"], r["n_hit"], r["items"]) for r in decontaminate.contaminated(d, b).collect()), key=str)
    assert got == sorted([(1, 2, ["9"]), (1, 2, ["9"]), (2, 1, []), (None, 0, [])], key=str)
    assert [r["n_hit"] for r in decontaminate.contaminated(d, b.limit(0)).collect()] == [0] * 4
    assert decontaminate.contaminated(d.limit(0), b).count() == 0


def test_plan_has_no_python(spark):
    d = spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string")
    b = spark.createDataFrame([(9, "c d e")], "item_id long, text string")
    plan = decontaminate.contaminated(d, b)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
