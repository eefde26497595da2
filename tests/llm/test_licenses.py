import random

from landledger.llm import licenses as L


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        above = row[:]
        for j, y in enumerate(b):
            row[j + 1] = above[j] + 1 if x == y else max(above[j + 1], row[j])
    return row[-1]


def test_alignment_against_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        template = [rng.choice("abcdefghijkl") for _ in range(rng.randint(1, 15))]
        text = [w for w in template if rng.random() < 0.8] + [rng.choice("abcxyz") for _ in range(rng.randint(0, 5))]
        pairs = L.align(text, template)
        assert all(text[i] == template[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
        assert len(pairs) <= lcs(text, template)
        if len(set(template)) == len(template) and text == [w for w in template if w in text]:
            assert len(pairs) == len(text)


def test_increasing():
    rng = random.Random(2)
    for _ in range(100):
        values = [rng.randint(0, 9) for _ in range(rng.randint(0, 8))]
        places = L.increasing(values)
        chosen = [values[i] for i in places]
        assert chosen == sorted(set(chosen))
        best = 0
        for mask in range(1 << len(values)):
            some = [v for i, v in enumerate(values) if mask >> i & 1]
            best = max(best, len(some) if some == sorted(set(some)) else 0)
        assert len(chosen) == best


def test_scan(spark):
    mit, gpl = L.TEMPLATES["MIT-notice"], L.TEMPLATES["GPL-3.0-notice"]
    rows = [
        (1, "some prose. " + L.TEMPLATES["CC-BY-NC-4.0"] + " more"), (2, f"{mit}\n\nthe end of the file\n\n{gpl}\n and again \n{gpl.replace('hope', 'wish')}"),
        (3, "under the license of the version"), (4, ""), (5, None), (None, "Released under the MIT License."), (None, "Released under the MIT License."),
        (6, "the " * 50_000 + "Released under the MIT License." + " of the license" * 1000),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, matches string")
    got = L.scan(docs).collect()
    names = {}
    for r in got:
        names.setdefault(r.doc_id, []).append([m.license for m in r.matches])
    assert names[1] == [["CC-BY-NC-4.0"]]
    assert names[2] == [["MIT-notice", "GPL-3.0-notice", "GPL-3.0-notice"]]
    assert names[3] == names[4] == names[5] == [[]]
    assert names[None] == [["MIT"], ["MIT"]] and names[6] == [["MIT"]]
    match = next(r for r in got if r.doc_id == 1).matches[0]
    assert rows[0][1][match.start:match.end] == "Licensed under CC BY-NC 4.0" and match.coverage == 1
    assert L.scan(docs.limit(0)).count() == 0
    assert all(not r.matches for r in L.scan(docs, {"empty": " . "}).collect())


def test_every_planted_line_is_found(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = {r.doc_id for r in L.scan(docs).where("size(matches) > 0").collect()}
    planted = {r.doc_id for r in docs.where("text rlike '(?m)^(Licensed under|Released under|This work is licensed)'").collect()}
    assert found == planted


def test_a_stretch_that_fails_hides_no_match():
    scanner = L.Scanner(L.TEMPLATES, 0.9)

    def places(text):
        return [(m["license"], m["first_word"], m["last_word"]) for m in scanner.scan(text)[1]]

    assert places("Released [2020] under the MIT License. Released under the MIT License.") == [("MIT", 0, 5), ("MIT", 6, 10)]
    notice = L.TEMPLATES["MIT-notice"].split()
    changed = [w if i % 16 else "xyz" for i, w in enumerate(notice)]
    for copies in ([changed, notice], [changed, notice, changed], [notice, changed, changed, notice]):
        found = places(" ".join(w for copy in copies for w in copy))
        assert [m[0] for m in found] == ["MIT-notice"] * len(copies)
    # A word that comes again out of turn: nine of ten words are in order, but only from the first one on.
    assert len(L.Scanner({"t": "a b c d e f g h i j"}, 0.9).scan("a b c d e f g h a i")[1]) == 1


def test_no_match_is_lost():
    rng = random.Random(3)
    template = "a b c d e f c a g h".split()
    scanner = L.Scanner({"t": " ".join(template)}, 0.8)
    for _ in range(400):
        text = [w for _ in range(rng.randint(1, 3)) for w in template if rng.random() < 0.85 or rng.random() < 0.3]
        text = [w if rng.random() < 0.93 else rng.choice("abgxyz") for w in text]
        got = scanner.scan(" ".join(text))[1]
        free = [i for i in range(len(text)) if not any(m["first_word"] <= i <= m["last_word"] for m in got)]
        for i in free:
            j = i
            while j + 1 in free and j + 1 - i < 2 * len(template):
                j += 1
            pairs = L.trimmed(L.common_subsequence(text[i:j + 1], template))
            assert len(pairs) < 8, (text, got)
