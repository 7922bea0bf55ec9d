import re

from starglean.llm import templates


def brute(docs, items):
    """Tokens, windows and slot maps in plain Python."""

    def tokens(text):
        text = (text or "").replace("\x01", " ")
        text = re.sub(r"([0-9])[.,]([0-9])", r"\1\2", text)
        out, at_start = [], True
        for m in re.finditer(r"[^\W_]+|[.!?:\n]|[^\s]", text):
            if re.match(r"[^\W_]", m[0]):
                start = at_start and m[0][0].isupper()
                out.append((m[0], start))
                at_start = False
            else:
                at_start = m[0] in ".!?:\n" if not m[0].isspace() else at_start
        return out

    def kinds(toks):
        out = []
        for k, (t, start) in enumerate(toks):
            if t[0] in "0123456789":
                out.append(templates.NUMBER)
            elif k and toks[k - 1][0][0] in "0123456789" and t.lower() in templates.UNITS:
                out.append(templates.UNIT)
            elif not start and re.fullmatch(r"[A-ZÀ-Þ][a-zß-ÿ]+", t):
                out.append(templates.NAME)
            else:
                out.append(None)
        return out

    def windows(text):
        toks = tokens(text)
        kind, plain = kinds(toks), [t.lower() for t, _ in toks]
        for p in range(len(toks) - 4):
            yield p, 0, tuple(plain[p : p + 5]), None
            if any(kind[p : p + 5]):
                yield p, 1, tuple(k or w for k, w in zip(kind[p : p + 5], plain[p : p + 5])), tuple(
                    k and k + w for k, w in zip(kind[p : p + 5], plain[p : p + 5]))

    out = set()
    for d, text in docs:
        doc = {}
        for p, form, w, slots in windows(text):
            doc.setdefault((form, w), []).append((p, slots))
        for i, item in items:
            n = len(tokens(item)) - 4
            literal, shifts = set(), {}
            for p, form, w, slots in windows(item):
                for q, other in doc.get((form, w), ()):
                    if form == 0:
                        literal.add(p)
                    else:
                        shifts.setdefault(q - p, []).append((p, slots, other))
            places = set(literal)
            for found in shifts.values():
                pairs = {(a, b) for _, x, y in found for a, b in zip(x, y) if a}
                if len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs}):
                    places |= {p for p, _, _ in found}
            if n > 0 and len(places) >= 0.5 * n:
                out.add((d, i, len(places), n, len(literal)))
    return out


ITEM = "A train leaves Boston at 9 with 120 people and Maria waits 35 minutes for it. How many people does Maria see before 9?"
CHANGED = "Some words first. A train leaves Denver at 7 with 250 people and Peter waits 50 minutes for it. How many people does Peter see before 7? More."
MIXED = "A train leaves Denver at 7 with 250 people and Peter waits 50 minutes for it. How many people does Laura see before 8?"


def test_templates_and_slots(spark):
    docs = [(1, "intro text. " + ITEM + " outro"), (2, CHANGED), (3, MIXED), (4, "A train leaves the town at noon and people wait for it"), (5, None),
            (6, ""), (None, ITEM.lower()), (7, "tiny"), (8, CHANGED), (8, "other words"), (9, "pad " * 30_000 + ITEM)]
    items = [(1, ITEM), (2, "too short"), (3, None), (None, "this other item has no number of its own at all"), (4, "in 5 kg of 5 kg of 6 kg of salt")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("doc_id", "text", "1 AS item_id", "2 AS window", "3 AS pos")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = {tuple(r) for r in templates.matches(d, b).collect()}
    assert got == brute([x for x in docs if x[0] != 8] + [(8, CHANGED + "\n" * 3 + "other words")], items)
    assert {(r[0], r[1]) for r in got} >= {(1, 1), (2, 1), (None, 1), (8, 1), (9, 1)}
    assert all(r[0] not in (4, 5, 6, 7) for r in got)
    assert templates.matches(d.limit(0), b).collect() == templates.matches(d, b.limit(0)).collect() == []
    kept = templates.drop_contaminated(d, b)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} >= {4, 5, 6, 7}


def test_slots_must_be_consistent(spark):
    b = spark.createDataFrame([(1, "take 5 of them then add 5 more")], "item_id bigint, text string")
    d = spark.createDataFrame([(1, "take 8 of them then add 8 more"), (2, "take 8 of them then add 9 more")], "doc_id bigint, text string")
    assert [r.doc_id for r in templates.matches(d, b).collect()] == [1]


def test_documents_equal_brute_force(spark, sf):
    docs, bench = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in templates.matches(docs, bench).collect()}
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert got == {(r[0], r[1]) for r in expected} and got


def test_rows_without_an_id_are_judged_one_by_one(spark):
    question = "How many apples did Anna buy at the market on Monday"
    docs = spark.createDataFrame([(None, f"{question}?", "a"), (None, "A clean text that says nothing of the kind at all", "b"), (None, None, "c"),
                                  (1, f"Well. {question}? Yes.", "d"), (1, "Another clean text under the same id as before", "e")], "doc_id bigint, text string, row string")
    items = spark.createDataFrame([(7, question)], "item_id bigint, text string")
    kept = templates.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r["row"] for r in kept.collect()) == ["b", "c", "e"]
