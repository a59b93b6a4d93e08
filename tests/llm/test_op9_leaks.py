import random
import re
from collections import Counter

from tessera.llm import decontaminate as D

rnd = random.Random(2)
WORDS = ("train leaves station speed basket apples shop farmer field water tank fills pump runs child buys pencils paper tower shadow "
         "length garden fence wall painter works alone together finish after before which there would could people money price total").split()


def prose(n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


ITEMS = [(1, "A farmer named Alice has 12 apples and sells 5 kg of them to Robert for 30 dollars. How much does Alice earn for each kg she sold?"),
         (2, "The river that runs by the old stone tower fills a quiet garden with water every spring and then slowly leaves it again"),
         (3, "Which metal melts first here"), (4, "12 34 56 78 90 11 13 15"), (5, None), (6, ""), (7, "one"),
         (9, "Each day 12 pumps lift water from the deep well, and 12 keepers write down how much of it reached the upper basin"),
         (8, "The river that runs by the old stone tower fills a quiet garden with water every spring and then slowly leaves it again")]


def leaks(spark, docs, **kw):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return {(r.doc_id, r.item_id): r for r in D.find_leaks(df, items, **kw).collect()}


def test_whole_changed_and_inconsistent_questions(spark):
    changed = ITEMS[0][1].replace("Alice", "Maria").replace("Robert", "John Smith").replace("12", "40").replace("5 kg", "7 miles").replace("each kg", "each mile").replace("30", "99")
    pumps = dict(ITEMS)[9]
    docs = [(10, prose(80) + ". " + ITEMS[0][1] + " " + prose(50)), (11, prose(30) + ". " + changed + " " + prose(9)), (12, prose(300)),
            (13, prose(20) + " " + ITEMS[1][1].upper() + "!! " + prose(20)), (14, " ".join(ITEMS[1][1].split()[:9])), (15, "we ask Which metal melts first here"),
            (16, "12 34 56 78 90 11 13 15"), (17, None), (18, ""), (19, "one two"), (20, " ".join(ITEMS[1][1].split()[4:19])),
            (21, pumps.replace("12", "70")), (22, pumps.replace("12", "70", 1)), (23, pumps)]
    got = leaks(spark, docs)
    assert set(got) == {(10, 1), (11, 1), (13, 2), (13, 8), (20, 2), (20, 8), (21, 9), (23, 9)} | {k for k in got if k[0] == 15}
    assert got[21, 9].reparameterised and not got[23, 9].reparameterised  # 22: one value stands for two
    assert got[11, 1].reparameterised and not got[10, 1].reparameterised and got[10, 1].coverage > 0.9


def test_short_items_need_all_their_tokens(spark):
    got = leaks(spark, [(1, "say. Which metal melts first here. Then"), (2, "Which metal melts first")])
    assert set(got) == {(1, 3)}


def test_exact_at_any_size_of_the_bit_map(spark):
    docs = [(i, prose(40) + ". " + (ITEMS[1][1] if i % 3 == 0 else "") + " " + prose(40)) for i in range(60)]
    want = {(i, k) for i in range(0, 60, 3) for k in (2, 8)}
    assert set(leaks(spark, docs)) == set(leaks(spark, docs, bits=6)) == want


def test_brute_force_windows(spark):
    c = D.Canon()
    docs = [(i, ". ".join(prose(rnd.randrange(3, 30)) for _ in range(3)) + (" " + ITEMS[0][1] if i % 4 == 0 else "")) for i in range(40)]
    canonical = lambda t, form: c.forms([(t or "").encode()])[form][1].tolist()
    got = leaks(spark, docs)
    for i, t in docs:
        for item, text in ITEMS:
            most = 0
            for form in D.FORMS:
                mine, toks = canonical(t, form), canonical(text, form)
                runs = {tuple(mine[k:k + 8]) for k in range(len(mine) - 7)}
                most = max(most, len({p for k in range(len(toks) - 7) if tuple(toks[k:k + 8]) in runs for p in range(k, k + 8)}))
            assert ((i, item) in got) == (most >= 13), (i, item)


def test_passages_without_punctuation_or_case(spark):
    text = ITEMS[0][1] + " " + ITEMS[1][1] + ". Then Bob Stone walks to the Market of Lisbon. Every Friday he meets Carol there."
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    bare = "".join(x for x in text if x.isalnum() or x == " ")
    df = spark.createDataFrame([(i, prose(20) + " " + t + " " + prose(20)) for i, t in enumerate([text, bare, bare.lower(), bare.upper(), bare.title(), text.replace(" ", "\n")])],
                               "doc_id long, text string")
    got = {r.doc_id: r.coverage for r in D.find_leaks(df, items).collect()}
    assert set(got) == set(range(6)) and min(got.values()) > 0.9


def test_frames_and_copies(spark, docs, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    leaky = spark.createDataFrame([(4, ITEMS[1][1]), (4, "clean text with the same id"), (None, ITEMS[1][1]), (None, "clean"), (5, ITEMS[1][1]), (5, ITEMS[1][1])], "doc_id long, text string")
    assert sorted(r.text for r in D.drop_leaks(leaky, items).collect()) == ["clean", "clean text with the same id"]
    assert len(D.find_leaks(leaky, items).collect()) == 6  # two items, three documents
    assert D.drop_leaks(docs, items).count() == docs.count() and D.drop_leaks(docs, items).columns == docs.columns
    assert D.drop_leaks(none, items).count() == 0 and D.find_leaks(leaky, items.where("1 = 0")).count() == 0


def test_memory_may_forget(monkeypatch):
    texts = [prose(30).encode() for _ in range(20)]
    want = [D.Canon().forms([t])[0][1].tolist() for t in texts]
    monkeypatch.setattr(D, "REMEMBERED", 3)
    c = D.Canon()
    assert [c.forms([t])[0][1].tolist() for t in texts] == want


def test_a_conflict_costs_its_windows_only(spark):
    pumps = dict(ITEMS)[9]
    other = pumps.replace("12 pumps", "70 pumps").replace("12 keepers", "80 keepers")
    got = leaks(spark, [(1, pumps.replace("12", "70", 1)), (2, pumps.replace("12", "70")), (3, pumps), (4, other), (5, prose(60))], **D.WHOLE)
    assert set(got) == {(1, 9), (2, 9), (3, 9), (4, 9)}
    assert 20 <= got[1, 9].covered < got[2, 9].covered == got[3, 9].covered
    assert not got[1, 9].reparameterised and got[2, 9].reparameterised


def test_agreeing_windows():
    w = lambda at, *pairs: {"at": at, "pairs": [{"a": a, "b": b} for a, b in pairs]}
    assert D.agreeing([w(0, ("12", "70")), w(1, ("12", "12")), w(2, ("12", "12"), ("x", "y"))]) == ([1, 2], True)
    assert D.agreeing([w(0, ("12", "70")), w(1, ("12", "12"))]) == ([1], False)
    assert D.agreeing([w(0, ("12", "70"), ("12", "12"))]) == ([], False)


def test_copies_of_items_dense_in_values(spark):
    train = "A train travels 60 miles in 2 hours and 30 minutes at 45 mph"
    mixed = "Mix 12 kg of lime with 5 kg of sand, then wait 3 days and sell it"
    items = spark.createDataFrame([(1, train), (2, mixed), (3, "12 34 56 78 90 11 13 15")], "item_id long, text string")
    rows = [(1, prose(20) + ". " + train + ". " + prose(20)), (2, prose(20) + " " + mixed.lower() + " " + prose(20)), (3, "12 34 56 78 90 11 13 15"),
            (4, train.replace("60", "61")), (5, "12 34 56 78 90 11 13 16"), (6, prose(60))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in D.find_leaks(df, items, **D.WHOLE).collect()}
    # 4 has another number in the item's template
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 1)} and all(r.coverage == 1 and r.reparameterised == (r.doc_id == 4) for r in got.values())


def test_a_verbatim_run_is_a_leak_whatever_the_other_slots_say(spark):
    text = "12 boats and 12 nets and 12 ropes lie by 12 posts while 12 men at the old grey harbour wall mend one more sail before the tide is high"
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    df = spark.createDataFrame([(1, text.replace("12", "70", 4))], "doc_id long, text string")
    assert D.find_leaks(df, items, **D.WHOLE).first().covered >= 13


def test_names_that_begin_sentences(spark):
    tom = "Tom has 3 apples. Tom buys 5 more. How many apples does Tom have?"
    items = spark.createDataFrame([(1, tom)], "item_id long, text string")
    ann = tom.replace("Tom", "Ann").replace("3", "8")
    rows = [(1, prose(20) + ". " + ann + " " + prose(20)), (2, prose(20) + ": " + tom), (3, "Say How to do. " + ann), (4, tom.replace("Tom", "Ann", 1)), (5, prose(60))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for kw in ({}, D.WHOLE):
        got = {r.doc_id: r for r in D.find_leaks(df, items, **kw).collect()}
        assert {1, 2, 3} <= set(got) and 5 not in got and got[1].reparameterised and not got[2].reparameterised


def test_a_sentence_end_parts_names():
    doc, _, kinds, _, at, span = D.Canon().forms([b"we met Robert Stone. Tom left -. Ann"])[2]
    assert span.tolist() == [1, 1, 2, 1, 1, 1] and (kinds == D.NAME).tolist() == [False, False, True, True, False, True]


def test_places_far_into_an_item(spark):
    text = prose(400)
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    df = spark.createDataFrame([(1, " ".join(text.split()[300:330])), (2, text)], "doc_id long, text string")
    assert {r.doc_id: r.covered for r in D.find_leaks(df, items, **D.WHOLE).collect()} == {1: 30, 2: 400}


def own_tokens(text, form):
    """An independent reading: (template token, kind or None, value) of each token."""
    out, opens, named = [], True, False
    for chunk in (text or "").split():
        word = chunk
        while word and not word[0].isalnum():
            word = word[1:]
        while word and not word[-1].isalnum():
            word = word[:-1]
        tail, end = chunk, False
        while tail and tail[-1] in ".!?:;\"')]":
            end, tail = end or tail[-1] in ".!?:;", tail[:-1]
        low = word.lower()
        if word:
            kind = None
            if form != D.EXACT:
                if low in D.NUMBERS or re.fullmatch(r"[+-]?\d[\d.,:/]*[a-z%]{0,3}", low):
                    kind = "number"
                elif low in D.UNITS:
                    kind = "unit"
                elif form != 1 and word[0].isupper() and word != word.upper() and (form == 2 or not opens):
                    kind = "name"
            value = low.rstrip("s") if kind == "unit" else low
            if kind == "name" and named:
                out[-1] = (out[-1][0], "name", out[-1][2] + " " + low)
            else:
                out.append((f"<{kind}>" if kind else low, kind, value))
            named = kind == "name"
        opens = end or (opens and not word)
        named = named and not (end and form == 2)
    return out


def own_leaks(docs, items):
    """(doc, item) by loops over all pairs of places: the settings of the query."""
    found = set()
    for form in (0, 1, 2, D.EXACT):
        mine = {d: own_tokens(t, form) for d, t in docs}
        for item, text in items:
            toks = own_tokens(text, form)
            lit = [k is None for _, k, _ in toks]
            need = min(5, len(toks))
            spans = []
            for i in range(len(toks)):
                n = 8
                while i + n <= len(toks) and sum(lit[i:i + n]) < need:
                    n = int(n * 1.5)
                if i + n <= len(toks) and sum(lit) >= need:
                    spans.append((i, n))
            if toks and sum(lit) >= need and (not spans or sum(spans[-1]) < len(toks)):
                n = 8
                while n < len(toks) and sum(lit[-n:]) < need:
                    n = int(n * 1.5)
                spans.append((max(0, len(toks) - n), min(n, len(toks))))
            for d, have in mine.items():
                shifts = {}
                for i, n in spans:
                    for k in range(len(have) - n + 1):
                        if [x[0] for x in have[k:k + n]] == [x[0] for x in toks[i:i + n]]:
                            shifts.setdefault(k - i, []).append((i, n, {(a[2], b[2]) for a, b in zip(toks[i:i + n], have[k:k + n]) if a[1]}))
                covered = set()
                for windows in shifts.values():
                    votes = Counter(p for *_, ps in windows for p in ps)
                    best = {}
                    for (a, b), v in votes.items():
                        best[a] = max(best.get(a, (0, False, "")), (v, a == b, b))
                    for i, n, ps in windows:
                        if all(best[a][2] == b for a, b in ps):
                            covered.update(range(i, i + n))
                if toks and len(covered) >= min(13, len(toks)):
                    found.add((d, item))
    return found


TRAIN = "A train travels 60 miles in 2 hours and 30 minutes at 45 mph"


def test_value_dense_items_with_other_values(spark):
    items = spark.createDataFrame([(1, TRAIN), (2, "Mix 12 kg of lime with 5 kg of sand, then wait 3 days and sell it")], "item_id long, text string")
    other = TRAIN.replace("60", "75").replace("2", "3").replace("30", "10").replace("45", "80")
    df = spark.createDataFrame([(1, prose(20) + ". " + other + ". " + prose(9)), (2, prose(40)), (3, other.replace("train", "boat"))], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in D.find_leaks(df, items, **D.WHOLE).collect()}
    assert set(got) == {(1, 1)} and got[1, 1].reparameterised


def test_against_an_independent_reading(spark):
    pool = ["Tom", "Ann Lee", "Oslo", "12", "7", "3.5", "seven", "kg", "miles", "miles", "THE", "each", "a", "of", "river.", "How", "ran,", "to", "(old)", "boat!"]
    text = lambda n: " ".join(rnd.choice(pool) for _ in range(n))
    items = [(i, text(rnd.randrange(4, 30))) for i in range(25)] + [(90, TRAIN), (91, TRAIN.replace("60", "61"))]

    def changed(t):
        return " ".join(rnd.choice(pool) if rnd.random() < .07 else x for x in t.replace("12", "99").replace("Tom", "Eve").split())
    docs = [(i, " ".join([text(rnd.randrange(20)), changed(rnd.choice(items)[1]) if i % 3 else rnd.choice(items)[1], text(rnd.randrange(20))])) for i in range(150)]
    got = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), **D.WHOLE)
    want = own_leaks(docs, items)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and len(want) > 80


def test_planted_items_in_the_whole_table(spark):
    """Benchmark items with other numbers, among all documents of the smallest data."""
    from pyspark.sql import functions as F

    from tests.conftest import SF
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    own = [(1_000_000 + i, f"{prose(15)} where {9 + i} {prose(12)} {40 + i} miles {prose(6)} while Robert {prose(8)}") for i in range(6)]
    more = [(2_000_000 + i, prose(30) + " " + t.replace(f" {9 + i} ", f" {500 + i} ").replace("Robert", "Ann Lee").replace(str(40 + i), "7")) for i, (_, t) in enumerate(own)]
    items = bench.select("item_id", "text").union(spark.createDataFrame(own, "item_id long, text string"))
    got = D.find_leaks(docs.union(spark.createDataFrame(more, docs.schema)), items, **D.WHOLE).where(F.col("item_id") >= 1_000_000).collect()
    assert {(r.doc_id - 1_000_000, r.item_id) for r in got} == {(k, k) for k, _ in own} and all(r.reparameterised for r in got)
