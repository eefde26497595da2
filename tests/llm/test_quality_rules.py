import math
import re

from pyspark.sql import functions as F

from landledger.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + d for i, g in enumerate(grams) if grams.count(g) > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_features(spark):
    texts = [
        None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a", "x\ny\nx\n\n\n x \nx", "# $ % <a|b>", "naïve café x　y\x0bz\x1cq",
        "w " * 3000, "the end. " * 20 + "other words here", "ab c a bc ab c", "\r\nline\r\nline\r\n",
    ]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    for r in qr.features(docs).collect():
        assert tuple(r)[1:] == plain(texts[r.doc_id]), texts[r.doc_id]


def test_binomial_tail(spark):
    for n, x, share in ((10, 3, 0.2), (500, 2, 0.01), (40_000, 5, 0.002), (7, 7, 0.5)):
        exact = sum(math.comb(n, i) * share ** i * (1 - share) ** (n - i) for i in range(x + 1)) if n < 1000 else None
        got = spark.range(1).select(F.expr(qr.log_tail(f"{n}L", f"{x}L", share))).head()[0]
        if exact is None:
            exact = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(share) + (n - i) * math.log(1 - share)) for i in range(x + 1))
        assert math.isclose(math.exp(got), exact, rel_tol=1e-9)


def labelled(spark, stratum, good, bad, lost=(), caught=()):
    """Trials of one stratum: ``lost`` and ``caught`` are the levels of good and bad documents that fall."""
    rows = [(stratum, i, 1, lost[i] if i < len(lost) else None) for i in range(good)]
    rows += [(stratum, 10 ** 6 + i, 0, caught[i] if i < len(caught) else None) for i in range(bad)]
    return spark.createDataFrame(rows, "stratum string, doc_id long, quality int, level int")


def test_levels_are_nested_and_reach_every_cutoff(spark):
    for rule, (_, grid) in qr.RULES.items():
        assert [qr.cutoff(rule, i) for i in range(1, len(grid) + 1)] == grid[::-1] and qr.cutoff(rule, 99) == grid[0]
    rows = spark.createDataFrame([(100, 500, n, 0, 0) for n in (0, 3, 15, 250)] + [(0, 0, 9, 0, 0), (100, 450, 0, 0, 11), (100, 450, 0, 6, 0)],
                                 "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")
    # 5 characters a word are caught by the strictest cutoffs of the short words only.
    assert [r[0] for r in rows.select(qr.level()).collect()] == [8, 8, 6, 1, None, 7, 2]


def test_levels_are_certified(spark):
    data = labelled(spark, "en", 400, 30, lost=[3] * 4, caught=[2] * 10 + [3] * 10 + [4] * 10)
    data = data.unionAll(labelled(spark, None, 30, 20, caught=[1] * 20)).unionAll(labelled(spark, "fr", 400, 20, lost=[2] * 40, caught=[1] * 3 + [5] * 10))
    got = {r.stratum: (r.level, r.good_lost, r.bad_caught) for r in qr.certified(data).collect()}
    # 4 of 400 prove less than 5 %; 0 of 30 do not; 40 of 400 end the series at level 2, whatever comes after.
    assert got == {"en": (4, 4, 30), None: (0, 0, 0), "fr": (1, 0, 3)}
    assert qr.certified(data.limit(0)).count() == 0
    # An id is one trial, however often it comes: 30 good documents stay 30.
    again = labelled(spark, "x", 30, 20, caught=[1] * 20)
    for _ in range(4):
        again = again.unionAll(again)
    assert qr.certified(again).head()[1:4] == (30, 20, 0)


def test_false_rejections_stay_below_the_limit(spark):
    """Of strata whose true loss is above the limit at level 1, at most ``risk`` get a level: here none of 40 at once."""
    import random

    random.seed(11)
    frames = None
    rows = []
    for s in range(40):
        rows += [(f"s{s}", i, 1, 1 if random.random() < 0.06 else None) for i in range(500)] + [(f"s{s}", 10_000 + i, 0, 1) for i in range(50)]
    frames = spark.createDataFrame(rows, "stratum string, doc_id long, quality int, level int")
    assert qr.certified(frames).where("level > 0").count() == 0


def test_a_level_is_in_use_and_decides(spark):
    """On the test tables the method rejects documents that the base rules keep."""
    from landledger.llm.common import table

    folder = "/root/testdata/sf0.01"
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    got = qr.judged(documents, labels).cache()
    assert got.where("not base_failed and not kept").count() > 0
    good = got.where("not base_failed").join(labels.where("quality = 1"), "doc_id")
    assert good.where("not kept").count() <= 0.05 * good.count()


def test_judged(spark):
    good = "the small house by the river has a garden and a gate number {} with old trees standing in rows along its northern wall " \
        "where every spring the blackbirds come back to nest under ivy leaves while children watch them quietly from an upper window of room {} " \
        "before they walk down again to breakfast"
    rows = [(i, good.format(i, i * 7), "en") for i in range(4000)]
    rows += [(10_000 + i, good.format(i, i).replace(" ", " ### "), "en") for i in range(30)]
    rows += [(20_000, None, "en"), (20_001, "", None), (None, good.format(1, 2), "en"), (20_002, good.format(5, 6), None), (20_003, "w " * 30_000, "en"), (0, rows[0][1], "en")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, stratum string")
    labels = spark.createDataFrame([(i, 1) for i in range(4000)] + [(10_000 + i, 0) for i in range(30)] + [(None, 0), (3, 0)], "doc_id long, quality int")
    got = qr.judged(docs, labels).collect()
    assert len(got) == len(rows)
    kept = {}
    for r in got:
        kept.setdefault(r.doc_id, []).append(r.kept)
    assert all(kept[i] == [True] for i in range(1, 4000)) and kept[0] == [True, True]
    assert not any(kept[10_000 + i][0] for i in range(30))
    assert kept[20_000] == kept[20_001] == kept[20_003] == [False] and kept[20_002] == kept[None] == [True]


def test_no_python(spark, sf):
    from landledger.llm.queries import op6_quality_rules, op8_mixing

    for build in (op6_quality_rules, op8_mixing):
        plan = build(spark, sf)._jdf.queryExecution().toString()
        assert not re.search("Python|Arrow|Pandas", plan)
