import random
import re
from collections import Counter

import numpy as np
import pytest

from landledger.llm import divergence as dv
from landledger.llm import transducer as td

ROWS = "doc_id long, text string, lang string, source string, term string"
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, min_docs, most_terms):
    docs, counts, groups = Counter(), Counter(), {}
    for _, text, lang, source, _ in rows:
        lang, source, terms = lang or "", source or "", TERM.findall((text or "").encode().lower())
        groups.setdefault(lang, set()).add(source)
        docs.update((lang, t) for t in set(terms))
        counts.update((lang, source, t) for t in terms)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for (of, t), n in docs.items() if of == lang and n >= min_docs)

        def shares(names):
            n = {t: sum(counts[lang, s, t] for s in names) for t in kept}
            return {t: 1 + 10 ** 9 * (n[t] + 5) // (sum(n.values()) + 5 * len(kept)) for t in kept}

        own, q = {s: shares([s]) for s in sources}, shares(sources)
        for s in sources:
            pairs = [(-sum(abs(own[s][t] - own[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(q[t] - own[s][t], t) for t in kept if counts[lang, s, t] and own[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, most_terms)):
                out += [(lang, s, part, item.decode(), -v, rank) for rank, (v, item) in enumerate(sorted(found)[:most], 1)]
    return sorted(out)


def table_rows():
    random.seed(5)
    words = [*(f"w{chr(97 + i)}{chr(97 + i * i % 26)}" for i in range(60)), "Ärger", "ÄRGER", "naïve", "日本語", "emoji😀x", "it's", "a_b", "x9y", "THE", "the", "thE"]
    rows = [
        (i, " ".join(random.choices(words, k=random.randrange(0, 60))), random.choice(["en", "en", "de", None]), random.choice(["hot", "hot", "hot", "s1", "s2", None]), "clash")
        for i in range(300)
    ]
    rows += [(900, None, "en", "silent"), (901, "", "xx", "only"), (902, "rare words here", "xx", "other"), (None, "the the wab", None, ""), (903, "Z" * 70_000 + " the", "en", "s2", )]
    rows = [(*r, "clash")[:5] for r in rows]
    return rows + rows[:3] + [(904, "the " * 30_000, "en", "long", "clash")]


@pytest.mark.parametrize("small", [False, True])
def test_against_plain_counts(spark, monkeypatch, small):
    """Also with work so small that texts are cut, transducers are split and closed again, and sources are tiled."""
    rows = table_rows()
    if small:
        for name, value in {"SLICE": 2000, "ENTRIES": 50, "STATES": 12, "HELD": 10_000, "BLOCK": 4, "TILE": 2}.items():
            monkeypatch.setattr(dv, name, value)
    frame = spark.createDataFrame(rows, ROWS).repartition(3)
    got = dv.divergence(frame, min_docs=8, most_terms=5)
    assert sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in got.collect()) == plain(rows, 8, 5)


def test_nothing_kept_and_no_rows(spark):
    rows = [(i, "a b c", "en", f"s{i}", "") for i in range(3)]
    got = dv.divergence(spark.createDataFrame(rows, ROWS)).collect()
    assert len(got) == 6 and {(r.part, r.value) for r in got} == {("pair", 0)}
    assert [r["item"] for r in sorted(got, key=lambda r: r["rank"]) if r.source == "s1"] == ["s0", "s2"]
    assert dv.divergence(spark.createDataFrame([], ROWS)).count() == 0
    assert dv.divergence(spark.createDataFrame(rows[:1], ROWS)).count() == 0


def bytes_of(words):
    data = np.frombuffer(b" ".join(words), np.uint8)
    return data, *td.words(data)


def test_transducer_is_a_minimal_perfect_numbering():
    random.seed(3)
    terms = sorted({bytes(random.choices(b"ab\xc3\xa9z", k=random.randrange(1, 9))) for _ in range(2000)})
    t = td.build(terms)
    assert [t.term(i) for i in range(len(terms))] == terms
    asked = terms + [b"q", terms[0] + b"zzzzzzzzzz", b"abababababababab", b"\xff\xff"]
    got = t.ordinals(*bytes_of(asked))
    known = {term: i for i, term in enumerate(terms)}
    assert got.tolist() == [known.get(a, -1) for a in asked]
    # Minimal: no two states have the same terms behind them.
    behind = {}
    for state in range(len(t.final)):
        seen = set()
        stack = [(state, b"")]
        while stack:
            at, word = stack.pop()
            if t.final[at]:
                seen.add(word)
            stack += [(int(t.follow[at][c]), word + bytes([c])) for c in range(t.follow.shape[1]) if t.follow[at][c] >= 0]
        behind.setdefault(frozenset(seen), []).append(state)
    assert all(len(states) == 1 for states in behind.values())
    with pytest.raises(ValueError):
        td.build([b"b", b"a"])
    assert td.build([]).ordinals(*bytes_of([b"a"])).tolist() == [-1]


def test_prefix_order():
    words = sorted([b"a", b"ab", b"abcdefgh", b"abcdefghi", b"\xc3\xa9", b"z"])
    keys = td.prefixes(*bytes_of(words))
    assert keys.tolist() == [td.prefix(w) for w in words] == sorted(keys.tolist())


def test_slices_cut_no_term():
    text = ("xy " * 50 + "q" * 400 + " zé").encode()
    parts = list(dv.slices(text, 64))
    assert b"".join(parts) == text and sum((TERM.findall(p) for p in parts), []) == TERM.findall(text)
