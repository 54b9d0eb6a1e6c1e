import random

from wellspring.llm import minhash

SCHEMA = "text string, doc_id bigint, component_id string, band int, node string"


def shingles(text, size):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in lowered).split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size, num, den):
    sets = {i: shingles(t, size) for i, t in rows}
    low = {i: i for i in sets}
    changed = True
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return {i: (len(sets[i]), low[i], low[i] == i) for i in sets}


def answer(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeÉß") for _ in range(rng.randint(1, 6)))
    rows = []
    for _ in range(25):
        base = [word() for _ in range(rng.choice((4, 9, 40, 150, 700)))]
        for _ in range(8):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = word()
            text = rng.choice((" ", "\n", "\t ")).join(copy)
            rows.append(text.upper() if rng.random() < 0.2 and text.isascii() else text)
    rows += [None, "", " \t\n", "one", "ONE", "one two", "one two", "one two three", "x" * 100_000, "x" * 100_000 + " y"]
    rows += ["same text of the very common kind " * 3] * 40
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_components_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(t, i, "c", 1, "n") for i, t in rows], SCHEMA).repartition(5)
    assert answer(minhash.near_duplicates(df, 3, 85, 100)) == brute(rows, 3, 85, 100)
    kept = minhash.first_of_each(df, 5, 80, 100)
    want = brute(rows, 5, 80, 100)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, w in want.items() if w[2])


def test_blocks_of_an_open_bucket(spark, monkeypatch):
    """A dense bucket that its star does not join is judged across its blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert answer(minhash.near_duplicates(df, 3, 85, 100)) == brute(rows, 3, 85, 100)


def test_empty_null_and_repeated_rows(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA), 3, 85, 100).collect() == []
    df = spark.createDataFrame([(None, "a b c"), (7, "a b c"), (7, "a b c"), (9, None), (8, "A b c")], "doc_id bigint, text string")
    got = sorted(map(tuple, minhash.near_duplicates(df, 3, 85, 100).collect()), key=str)
    assert got == sorted([(None, 1, None, True), (7, 1, 7, True), (7, 1, 7, True), (9, 0, 9, True), (8, 1, 7, False)], key=str)


def test_one_id_with_two_texts(spark, monkeypatch):
    """All sets of a document take part, and hold its component together."""
    rng = random.Random(8)
    rows = [(rng.randrange(120), t) for _, t in corpus()]
    sets, ids = [shingles(t, 3) for _, t in rows], sorted({i for i, _ in rows})
    links = [
        (rows[x][0], rows[y][0]) for x in range(len(rows)) for y in range(x)
        if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 85 * len(sets[x] | sets[y])
    ]
    # All rows, and few enough for several components.
    some = [k for k, (i, _) in enumerate(rows) if i < 12 or i > 112]
    for part, block in ((range(len(rows)), 1024), (some, 4)):
        monkeypatch.setattr(minhash, "BLOCK", block)
        mine = [rows[k] for k in part]
        want = {i: i for i, _ in mine}
        for _ in ids:
            for a, b in links:
                if a in want and b in want:
                    want[a] = want[b] = min(want[a], want[b])
        got = minhash.near_duplicates(spark.createDataFrame(mine, "doc_id bigint, text string").repartition(3), 3, 85, 100).collect()
        assert len(got) == len(mine)
        assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(i, m, i == m) for i, m in want.items()}
    s1, s2 = ("alpha beta gamma delta epsilon " * 2, " ".join(f"w{i}" for i in range(60)))
    rows = [(5, s1), (5, s2), (5, ""), (9, s2 + " more"), (2, None), (7, s1.upper())]
    got = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 85, 100).collect()}
    assert got == {(5, 5), (9, 5), (7, 5), (2, 2)}


def test_one_row_of_each_group_stays(spark):
    """Repeated rows of one id and rows without an id are copies as well."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(3, "x y z"), (3, "x y z"), (3, "X  y z"), (None, "x y z"), (None, long), (None, long), (None, long + " more")]
    rows += [(None, ""), (None, None), (4, None), (4, None), (6, "p q"), (6, "p q r s"), (None, "alone"), (8, "p q")]
    df = spark.createDataFrame([(t, i, "c", 1, "n") for i, t in rows], SCHEMA).repartition(4)
    kept = minhash.first_of_each(df, 5, 80, 100)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, " ".join((r.text or "").lower().split())) for r in kept.collect()), key=str)
    text = next(t for i, t in got if i is None and t.startswith("w0"))
    assert text in (long, long + " more")
    want = [(3, "x y z"), (None, text), (None, ""), (None, ""), (4, ""), (6, "p q r s"), (None, "alone")]
    assert got == sorted(want, key=str)


def test_query_agrees_with_sql(same):
    same("op1_minhash")
