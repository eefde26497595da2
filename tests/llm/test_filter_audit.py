import re
from collections import Counter
from itertools import permutations

from landledger.llm import filter_audit as fa

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ROWS = "doc_id long, text string, source string, mask string"
LABELS = "doc_id long, quality int, toxic int"


def plain_fails(rows):
    smallest = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    for doc_id, text, source, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": doc_id is not None and doc_id > smallest[text],
        }
        yield doc_id, source or "", {c for c, failed in fails.items() if failed}


def plain(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = {}
    for part in {r[2] or "" for r in rows}:
        docs = [(d, f) for d, p, f in plain_fails(rows) if p == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = docs
            for step, c in enumerate(order, 1):
                gone, left = [x for x in left if c in x[1]], [x for x in left if c not in x[1]]
                shapley[c] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(c in f and bool(f & set(order[:step - 1])) for _, f in docs), sum(f == {c} for _, f in docs),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), c,
                ]
        for key in [k for k in out if k[0] == part]:
            out[key][6] = shapley[out[key][6]]
    return out


def test_against_plain_loops(spark):
    long = " ".join(f"w{i}" for i in range(250))
    texts = [None, "", long, long, "A" * 90, "a b " * 150, long + " #", "é " * 300, "X y " * 120 + long, long.upper(), "naïve\x0bcafé　x $", "w " * 40_000]
    rows = [(i, t, ("hot", "b", None, "")[i % 4], "clash") for i, t in enumerate(texts)]
    rows += [(50 + i, texts[i % 5], "hot", "x") for i in range(40)] + [(3, long, "hot", ""), (3, long, "b", ""), (None, long, "b", ""), (None, "only", None, "")]
    labels = [(i, i % 2, (i // 2) % 2) for i in range(60)] + [(4, 1, 1), (None, 1, 1), (5, None, None)]
    got = fa.audit(spark.createDataFrame(rows, ROWS), spark.createDataFrame(labels, LABELS)).collect()
    want = plain(rows, labels)
    assert len(got) == len(want) == 600 * 3
    for r in got:
        assert [r[c] for c in (*fa.COUNTS, "shapley")] == want[r.part, r.filter_order, r.step], r


def test_no_rows_and_no_labels(spark):
    empty, labels = spark.createDataFrame([], ROWS), spark.createDataFrame([], LABELS)
    assert fa.audit(empty, labels).count() == 0
    one = fa.audit(spark.createDataFrame([(None, None, None, None)], ROWS), labels)
    assert one.count() == 600 and one.where("filter_order = 'DABCE' and step = 1").head()["kept"] == 1


def test_a_part_gathers_cells_only(spark):
    """The rows that meet per part are its masks, not its documents."""
    rows = spark.range(5000).selectExpr("'hot' as part", "cast(id % 7 as int) as mask", "1L as n", "0L as good", "0L as toxic")
    cells = rows.groupBy("part", "mask").count().selectExpr("part", "mask", "count as n", "0L as good", "0L as toxic")
    got = fa.folded(cells, "ABC")
    assert got.count() == 18 and got.where("step = 3").selectExpr("min(kept)", "max(kept)").head()[0] == 715
