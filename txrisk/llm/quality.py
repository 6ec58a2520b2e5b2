"""Quality rules: per-document rule counts and a hashed n-gram log-likelihood ratio
between a trusted-target and a raw-corpus multinomial (native DataFrame code only).

Every document's hashed unigrams and bigrams (``BUCKETS`` buckets) are counted over
the whole corpus and, in the same pass, over trusted documents; the log ratio of the
two multinomials is summed over a document's n-grams and divided by their number. The
target is smoothed towards the raw multinomial, as if ``PRIOR`` n-grams drawn from it
had been trusted: little evidence gives ratios near 0, whatever the corpus' size. A
document passes at ``THRESHOLD`` or more: no draw is involved.

Both constants were fixed on labelled rows left out of the trusted counts, at sf0.01
and sf0.1 with 30 trusted rows up to all: the lowest good row had -0.166.

The trusted multinomial is fitted on at most ``TRUSTED_ROWS`` rows labelled of good
quality (those whose id hashes lowest), which bounds the broadcast of their ids. The
raw multinomial and the scores cover every row. The ratio table has ``BUCKETS`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import once, text_of, words_of, written

BUCKETS = 65536
TRUSTED_ROWS = 50_000
PRIOR = 262_144.0    # n-grams
THRESHOLD = -0.2     # nats per n-gram
MIN_WORDS = 50


def rule_columns(docs: DataFrame) -> DataFrame:
    """``docs`` plus the rule counts n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words (all long) and the word array ``_words``.

    For the repeated 3-word windows, the hashes of a text's windows and their positions
    are sorted together: equal neighbours mark a repeated window, and each of them adds
    the words that the one before it did not cover."""
    text = text_of()
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    d = once(docs, _words=words_of(text), _lines=F.filter(F.split(text, "\n"), has_word))
    n = F.size("_words")
    windows = F.slice(
        F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2))),
        1, F.greatest(n - 2, F.lit(0)))
    d = once(d, _win=windows)
    repeats = F.size("_win") > F.size(F.array_distinct("_win"))
    d = once(d, _sorted=F.when(repeats, F.array_sort(F.transform(
        "_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twin = lambda k: F.get("_sorted", k)["h"]
    at = F.sort_array(F.transform(
        F.filter("_sorted", lambda x, k: x["h"].eqNullSafe(twin(k - 1)) | x["h"].eqNullSafe(twin(k + 1))),
        lambda x: x["i"]))
    covered = F.aggregate(
        at, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"),
                                p.alias("last")),
        lambda acc: acc["n"])
    return (d.withColumn("n_words", n.cast("long"))
            .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
            .withColumn("n_symbols", F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"))
            .withColumn("n_dup_lines",
                        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
            .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
            .drop("_lines", "_win", "_sorted"))


def gram_buckets(words: Column) -> Column:
    """Buckets of the lower-cased unigrams and bigrams of an array of words."""
    low = F.transform(words, F.lower)
    bucket = lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int")
    n_pairs = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(low, 1, n_pairs), F.slice(low, 2, n_pairs), lambda a, b: bucket(F.xxhash64(a, b)))
    return F.concat(F.transform(low, lambda w: bucket(F.xxhash64(w))), pairs)


def ratio_table(docs: DataFrame, trusted: DataFrame, trusted_rows: int = TRUSTED_ROWS) -> DataFrame:
    """(``_b``, ``ratio``): log p_target(bucket) - log p_raw(bucket) for the buckets
    that occur. ``trusted`` has ``doc_id``; null ids are left out."""
    ids = (trusted.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted_rows)
           .withColumn("_trusted", F.lit(1)))
    counts = (docs.select("doc_id", words_of(text_of()).alias("_words"))
              .join(F.broadcast(ids), "doc_id", "left")
              .select("_trusted", F.explode(gram_buckets(F.col("_words"))).alias("_b"))
              .groupBy("_b").agg(F.count(F.lit(1)).alias("_raw"), F.count("_trusted").alias("_target")))
    counts = written(docs.sparkSession, counts, "quality_counts")
    totals = counts.agg(F.coalesce(F.sum("_raw"), F.lit(0)), F.coalesce(F.sum("_target"), F.lit(0))).head()
    # (target + PRIOR * p) / (total target + PRIOR) / p, where p = raw / total raw
    lift = F.col("_target") * F.lit(float(totals[0])) / F.col("_raw")
    return counts.select("_b", F.log((lift + PRIOR) / F.lit(totals[1] + PRIOR)).alias("ratio"))


def quality_rules(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, the rule counts, base_failed, kept, score.

    Null and empty texts have no words: all counts 0, score 0, base_failed. Repeated
    rows (and ids) keep their own result row. Without trusted rows every ratio, and so
    every score, is 0. Other columns are not read; an empty table gives an empty result.
    """
    table = ratio_table(docs, trusted)
    rules = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    d = rule_columns(docs.select("doc_id", "text")).withColumn("_row", F.monotonically_increasing_id())
    grams = d.select("_row", "doc_id", *rules, F.explode_outer(gram_buckets(F.col("_words"))).alias("_b"))
    scored = (grams.join(F.broadcast(table), "_b", "left")
              .groupBy("_row", "doc_id", *rules)
              .agg(F.coalesce(F.sum("ratio") / F.count("_b"), F.lit(0.0)).alias("score")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.select("doc_id", *rules, failed.alias("base_failed"),
                         (~failed & (F.round("score", 9) >= threshold)).alias("kept"), "score")
