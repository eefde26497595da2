"""Heuristic quality rules whose cutoffs are certified: per stratum, false rejections stay below a limit with stated confidence.

Features are array expressions over a text's words and lines. Every rule has a grid of cutoffs from mild to strict; level l puts
each rule at its l-th cutoff, so what a level rejects, all rules together, grows with it. Labelled good documents test the levels
of a stratum in this fixed order, and the first that fails ends the series: a level is certified if so few good documents fall to
it that, were the true share above the limit, this would have happened with a probability under ``risk`` divided by the number of
strata. That is an exact binomial tail; a fixed order needs no correction for the number of levels, and Bonferroni covers
the strata. Only DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.llm.common import materialize

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

# Rule: (feature, cutoffs from strict to mild); a document with a greater value falls to the rule.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / n_words", [0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 1.0, 2.0]),
    "repeats": ("n_repeat_words / n_words", [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45]),
    "lines": ("n_dup_lines / n_words", [0.001, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1]),
    "long_words": ("word_chars / n_words", [6.0, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0]),
    "short_words": ("- word_chars / n_words", [-6.0, -5.0, -4.5, -4.0, -3.5, -3.0, -2.5, -2.0]),
}
LEVELS = max(len(grid) for _, grid in RULES.values())


def features(documents: DataFrame, text_column: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of every whole text; null has no words.

    Each step names what the next ones use more than once, so that it is computed once a row.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = documents.select(*keep, text.alias("q_text")).withColumns({
        "q_words": F.expr(rf"filter(split(q_text, r'{SPACES}'), w -> w <> '')"),
        "q_lines": F.expr(rf"filter(split(q_text, '\n'), l -> l rlike r'{WORD}')"),
    })
    rows = rows.withColumn("q_grams", F.expr("""
        if(size(q_words) < 3, cast(array() as array<string>),
            transform(slice(q_words, 1, size(q_words) - 2), (w, i) -> concat_ws(' ', w, q_words[i + 1], q_words[i + 2])))
    """))
    # Only texts that repeat a window at all have them sorted, each with its place.
    rows = rows.withColumn("q_sorted", F.expr("""
        if(size(array_distinct(q_grams)) = size(q_grams), cast(array() as array<struct<g: string, i: int>>),
            array_sort(transform(q_grams, (g, i) -> struct(g, i))))
    """))
    repeated = """
        size(array_distinct(flatten(transform(
            filter(transform(q_sorted, (x, k) -> if(
                (k > 0 and q_sorted[greatest(k - 1, 0)].g = x.g) or (k + 1 < size(q_sorted) and q_sorted[least(k + 1, size(q_sorted) - 1)].g = x.g),
                x.i, -1)), i -> i >= 0),
            i -> array(i, i + 1, i + 2)))))
    """
    return rows.select(
        *keep, F.size("q_words").cast("long").alias("n_words"),
        F.expr("aggregate(q_words, 0L, (n, w) -> n + char_length(w))").alias("word_chars"),
        F.regexp_count("q_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(repeated).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def cutoff(rule: str, level: int) -> float:
    """The cutoff of a rule at a level from 1 (mildest); a shorter grid stays at its strictest."""
    grid = RULES[rule][1]
    return grid[max(len(grid) - level, 0)]


def level() -> Column:
    """The mildest level that rejects a row of features; null if none does. No words, no level."""
    reached = []
    for rule, (feature, grid) in RULES.items():
        value = F.expr(feature).cast("double")
        # The value passes the mildest of the cutoffs below it first.
        reached.append(F.coalesce(*[F.when(value > cutoff(rule, i), F.lit(i)) for i in range(1, len(grid) + 1)]))
    return F.when(F.col("n_words") > 0, F.least(*reached))


def log_tail(n: str, x: str, share: float) -> str:
    """SQL for ln P(X <= x), X binomial of ``n`` trials with probability ``share``: terms added up in logarithms."""
    return f"""
        aggregate(sequence(1L, {x}),
            named_struct('term', {n} * ln(1 - {share}D), 'total', {n} * ln(1 - {share}D)),
            (s, i) -> transform(array(s.term + ln(({n} - i + 1) / i) + ln({share}D / (1 - {share}D))), term -> named_struct(
                'term', term, 'total', greatest(s.total, term) + log1p(exp(- abs(s.total - term)))))[0],
            s -> s.total)
    """


def certified(labelled: DataFrame, limit: float = 0.05, risk: float = 0.05) -> DataFrame:
    """(stratum, good, bad, level, good_lost, bad_caught): the level in use of each stratum with labels, 0 where none is certified
    or none rejects a bad document.

    ``labelled``: (stratum, doc_id, quality, level) of documents that pass the base rules; other qualities than 0 and 1 teach
    nothing. An id is one trial, at its mildest level, however many rows it has. ``limit``: share of good documents that all rules
    together may reject in any stratum. Of the certified levels, that with the most bad documents rejected, less the good ones,
    is used, the mildest if they tie. One row per stratum, whatever the number of documents.
    """
    trials = labelled.where("quality in (0, 1)").groupBy("stratum", "doc_id").agg(F.max("quality").alias("quality"), F.min("level").alias("level"))
    good, bad = F.col("quality") == 1, F.col("quality") == 0
    counted = materialize(trials.groupBy("stratum").agg(
        F.count_if(good).alias("good"), F.count_if(bad).alias("bad"),
        F.array(*[F.count_if(good & (F.col("level") <= i)) for i in range(1, LEVELS + 1)]).alias("lost"),
        F.array(*[F.count_if(bad & (F.col("level") <= i)) for i in range(1, LEVELS + 1)]).alias("caught"),
    ), "rule-levels")
    n_strata = max(counted.count(), 1)
    # A tail that starts above the limit's mean can't be small: it is not added up.
    tail = f"if(x = 0, good * ln(1 - {limit}D), {log_tail('good', 'x', limit)})"
    passes = F.expr(f"transform(lost, x -> good > 0 and (x = 0 or x < good * {limit}D) and {tail} <= ln({risk}D / {n_strata}))")
    tested = counted.withColumn("passes", passes).withColumn("proven", F.expr("if(array_position(passes, false) = 0, size(passes), cast(array_position(passes, false) as int) - 1)"))
    gains = "transform(sequence(1, proven), i -> named_struct('gain', caught[i - 1] - lost[i - 1], 'mild', -i))"
    best = F.expr(f"if(proven = 0 or caught[greatest(proven, 1) - 1] = 0, 0, -array_max({gains}).mild)")
    used = tested.withColumn("level", best)
    return used.select(
        "stratum", "good", "bad", "level", F.expr("if(level = 0, 0L, lost[greatest(level, 1) - 1])").alias("good_lost"),
        F.expr("if(level = 0, 0L, caught[greatest(level, 1) - 1])").alias("bad_caught"),
    )


def labelled_rows(rows: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Rows of features that pass the base rules, with ``quality``; ids that are null or labelled in two ways teach nothing."""
    one = labels.select(F.col(id_column).alias("doc_id"), "quality").where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("quality").alias("most"),
    ).where("quality = most").drop("most")
    return rows.where("not base_failed").join(one, "doc_id").select("stratum", "doc_id", "quality", "level")


def judged(
    documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", stratum_column: str = "lang",
    limit: float = 0.05, risk: float = 0.05,
) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept): one row per row of ``documents``.

    Features are computed once and written. A null stratum is one of its own; a stratum without a certified level keeps all that
    passes the base rules. Repeated rows are judged alike; no documents, no rows.
    """
    rows = features(documents.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"), F.col(stratum_column).cast("string").alias("stratum"),
    ), keep=("doc_id", "stratum")).withColumn("base_failed", base_failed())
    # Levels are worked out from the written features: inside one plan with them, their terms would be computed over and over.
    rows = materialize(rows, "rule-features").withColumn("level", level())
    used = materialize(certified(labelled_rows(rows, labels, id_column), limit, risk).where("level > 0"), "rule-cutoffs")
    used = used.select(F.col("stratum").alias("s"), F.col("level").alias("used"))
    joined = rows.join(used, F.col("stratum").eqNullSafe(F.col("s")), "left")
    rejected = F.coalesce(F.col("level") <= F.col("used"), F.lit(False))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~rejected).alias("kept"),
    )


def _oracle() -> str:
    tests = ", ".join(f"('{rule}', {i}, {cutoff(rule, i)})" for rule in RULES for i in range(1, LEVELS + 1))
    pairs = " union all ".join(f"select doc_id, lang, '{rule}' as rule, cast({feature.replace('/', '* 1.0 /')} as double) as value from f where n_words > 0" for rule, (feature, _) in RULES.items())
    return rf"""
    with t as (select doc_id, lang, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
    g as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from t)),
    r as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from g) where n > 1),
    c as (select doc_id, count(distinct i + d) as n from r, (values (0), (1), (2)) o(d) group by doc_id),
    l as (select doc_id, count(*) - count(distinct line) as n from (select doc_id, unnest(string_split(text, chr(10))) as line from t)
          where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
    f0 as (
        select doc_id, lang, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
            cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols, cast(coalesce(l.n, 0) as bigint) as n_dup_lines,
            cast(coalesce(c.n, 0) as bigint) as n_repeat_words
        from t left join l using (doc_id) left join c using (doc_id)
    ), f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from f0),
    y as (select doc_id, min(quality) as quality from labels where doc_id is not null group by doc_id having min(quality) = max(quality)),
    tests(rule, level, cutoff) as (values {tests}),
    v as (select v.doc_id, min(level) as level from ({pairs}) v join tests on v.rule = tests.rule and v.value > tests.cutoff group by v.doc_id),
    learn as (select f.lang, f.doc_id, y.quality, v.level from f join y using (doc_id) left join v using (doc_id) where not f.base_failed and y.quality in (0, 1)),
    strata as (select count(distinct coalesce(lang, chr(0))) as n from learn),
    counted as (
        select lang, i as level, cast(count(*) filter (quality = 1) as bigint) as good, cast(count(*) filter (quality = 1 and level <= i) as bigint) as lost,
            cast(count(*) filter (quality = 0 and level <= i) as bigint) as caught
        from learn, (select unnest(range(1, {LEVELS + 1})) as i) group by lang, i
    ), tail as (
        select *, (select sum(exp(lgamma(good + 1) - lgamma(i + 1) - lgamma(good - i + 1) + i * ln(0.05) + (good - i) * ln(0.95)))
            from (select unnest(range(0, lost + 1)) as i)) <= 0.05 / strata.n and good > 0 and (lost = 0 or lost < good * 0.05) as passes from counted, strata
    ), proven as (select *, bool_and(passes) over (partition by lang order by level) as certified from tail),
    used as (
        select lang, level from proven where certified qualify row_number() over (partition by lang order by caught - lost desc, level) = 1 and max(caught) over (partition by lang) > 0
    ), bad as (select distinct f.doc_id from f join v using (doc_id) join used on f.lang is not distinct from used.lang where v.level <= used.level)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and bad.doc_id is null as kept
    from f left join bad using (doc_id)
    """


ORACLE = _oracle()
