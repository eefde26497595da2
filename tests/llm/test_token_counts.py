import bisect

import public_tokenizers

from landledger.llm import token_counts as tc
from landledger.llm.queries import RANKS, file_bytes

PATTERN = public_tokenizers.PATTERN


def test_histogram_and_sums(spark):
    texts = ["", None, "one two three", "one two three", "<|endoftext|>", "a" * 30_000, " ".join(["word"] * 3000), *["x y z " * i for i in range(40)]]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    ranks = file_bytes(RANKS)
    coder = tc.encoding(ranks, PATTERN)
    lengths = sorted(len(coder.encode_ordinary(t or "")) for t in texts)
    sums = tc.suffix_sums(tc.histogram(docs, ranks, PATTERN)).cache()
    rows = {r.n_tokens: r for r in sums.collect()}
    assert sorted(rows) == sorted(set(lengths))
    for n, r in rows.items():
        assert r.n_docs == lengths.count(n)
        assert r.docs_from == sum(x >= n for x in lengths) and r.tokens_from == sum(x for x in lengths if x >= n)
        assert r.docs_below == bisect.bisect_left(lengths, n) and r.tokens_below == sum(x for x in lengths if x < n)
        assert r.tokens_cut == sum(min(x, n) for x in lengths)
    for limit in (0, 1, 2, 17, 2048, 5000, 10 ** 6):
        assert tc.at_limit(sums, limit) == {"limit": limit, "docs_cut": sum(x > limit for x in lengths), "tokens_cut": sum(min(x, limit) for x in lengths)}
    for share in (0.01, 0.25, 0.5, 0.99, 1.0):
        assert tc.quantile(sums, share) == lengths[max(0, -int(-share * len(lengths) // 1) - 1)]


def test_no_documents(spark):
    sums = tc.suffix_sums(tc.histogram(spark.createDataFrame([], "text string"), file_bytes(RANKS), PATTERN))
    assert sums.count() == 0 and tc.quantile(sums, 0.5) is None and tc.at_limit(sums, 10)["tokens_cut"] == 0
