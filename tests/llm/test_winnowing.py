import random
import re

from groundwork.llm import winnowing

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items):
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    windows = {}
    for item, text in items:
        w = WORD.findall(low(text))
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = WORD.findall(low(text)), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, item_id string")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, words int")
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in winnowing.contamination(d, b).collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(3)
    words = ["a", "b", "É", "x1", "cc"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(1, 8)] + [(9, None), (9, "One one, ONE!"), (3, text(12))]
    docs = [(i, text(rng.choice([0, 1, 5, 9, 10, 40]))) for i in range(12)]
    docs += [(20, None), (20, ""), (21, f"zz {items[5][1]} yy {items[5][1].upper()}"), (21, f"zz {items[5][1]} yy {items[5][1].upper()}"), (None, "one-one.one"), (22, "same " * 3000)]
    items.append((30, "same " * 40))
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a b")], []) == [(1, 2, 0, [])]
