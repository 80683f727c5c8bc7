import hashlib
import random
import re

from triagelake.llm.decontaminate import Automaton, decontaminate, find_items, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow(words, items, window):
    hit, found = set(), set()
    for name, item in items:
        n = min(window, len(item))
        for at in range(len(item) - n + 1) if n else ():
            for i in range(len(words) - n + 1):
                if words[i : i + n] == item[at : at + n]:
                    hit |= set(range(i, i + n))
                    found.add(name)
    return hit, found


def test_automaton_equals_brute_force():
    rnd = random.Random(4)
    for round_ in range(300):
        letters = [bytes([c]) for c in b"abcdefgh"[: rnd.randint(1, 8)]]
        items = [(str(i), rnd.choices(letters, k=rnd.randint(0, 14))) for i in range(rnd.randint(0, 6))]
        window = rnd.randint(1, 6)
        words = rnd.choices([*letters, b"x"], k=rnd.randint(0, 60))
        spans, found = Automaton(items, window).matches(words)
        hit, want = slow(words, items, window)
        assert ({p for a, b in spans for p in range(a, b)}, found) == (hit, want)
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_words():
    for text in ("", None, "Ab-c9 É x_y", "\x7f{z}"):
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        assert [w.decode() for w in words_of(text)] == WORD.findall(low)


def test_passes_agree_and_edges(spark):
    long_item = " ".join(f"w{i}" for i in range(25))
    items = [(1, long_item), (2, "only three words"), (3, None), (None, "nothing has this id"), (2, "..."), (10, long_item)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "a, " + long_item.upper() + " b", 5, "m"), (2, None, 0, None), (3, "", 0, "m"), (4, "ONLY three: words", 9, "m"),
         (5, "see only three words in a clean text about other things that stay as they are", 9, "m"),
         (6, "w0 w1 w2 w3 w4 w5 w6 w7 w8", 3, "m"), (7, "x " * 30000, 3, "m"), (8, "only only three words three words tail of it here", 1, "m")],
        "doc_id long, text string, n_chars long, matched string")
    one = {r.doc_id: r.hit for r in find_items(docs, bench, "hit").collect()}
    many = {r.doc_id: r.hit for r in find_items(docs, bench, "hit", max_words=3).collect()}
    assert one == many
    assert one[1]["items"] == ["1", "10"] and one[1]["spans"] == [[1, 26]] and one[6]["spans"] == []
    done = {r.doc_id: r for r in decontaminate(docs, bench).collect()}
    assert set(done) == {2, 3, 5, 6, 7, 8}
    assert done[5].text == "see  in a clean text about other things that stay as they are"
    assert done[8].text.split() == "tail of it here".split()  # what removal brings together goes too
    assert done[5].n_chars == len(done[5].text) and done[6].n_chars == 3 and done[5].matched == "m"
    assert decontaminate(docs.limit(0), bench).count() == 0
    assert decontaminate(docs, bench.limit(0)).count() == 8


def test_query_equals_brute_force(spark, sf_dir):
    from triagelake.llm.decontaminate import op6_suffix_automaton

    low = lambda t: WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    items = [(str(r.item_id), low(r.text)) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    windows = {}
    for name, item in items:
        for at in range(max(1, len(item) - 9)):
            windows.setdefault(tuple(item[at : at + 10]), set()).add(name)
    lengths = {len(w) for w in windows}
    want = set()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        words, hit, found = low(r.text), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if names := windows.get(tuple(words[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        want.add((r.doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    assert {tuple(r) for r in op6_suffix_automaton(spark, sf_dir).collect()} == want
    assert sum(w[-1] for w in want) > 5
