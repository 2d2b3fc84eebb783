"""Quality rules: a hashed n-gram likelihood ratio with one threshold for every document.

Words and pairs of words are hashed into a fixed number of bins. Counts over all documents
make the raw multinomial, counts over the trusted documents (label quality 1) the target. A document's score is the mean over its n-grams of
log(target / raw) of the bin. Labelled documents are sampled (at most `sample`, by hash of
the id): half of them give the target, the other half the threshold, which then holds for
every document. Before that, plain rules fail texts with under 50 words, and
texts in which more than half of the words lie in repeated three-word windows.

Built-in expressions only; counts are summed before they are shuffled, and what comes to the
driver or is broadcast is bounded by `bins` and `sample`.

Defined cases: a null or empty text has no words and fails; repeated rows and shared ids are
judged row by row; a document labelled more than once counts as trusted if any label says so;
without trusted labels every score is 0 and only the plain rules decide; without rejected
labels nothing is below the threshold; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factline.functions.once import once
from factline.llm.names import set_aside
from factline.llm.names import without as without_columns
from factline.llm.words import SPACES, words
from factline.storage import keep

BINS = 1 << 16
SAMPLE = 20_000
SYMBOLS = "#*$%&|<>"


def grams(words: Column, bins: int = BINS) -> Column:
    """The bins of all words and pairs of neighbours; the last word has no pair."""
    single = F.transform(words, lambda word: F.pmod(F.xxhash64(word), F.lit(bins)).cast("int"))
    pair = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda word, i: F.pmod(F.xxhash64(word, F.get(words, i + 1)), F.lit(bins)).cast("int"))
    return F.concat(single, pair)


def labelled(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """A bounded sample of labelled ids, the ones with the smallest hashes: (doc_id, good, fits), fits the half for the target."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg((F.max("quality") > 0).alias("good"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return chosen.withColumn("fits", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0)


def ratios(docs: DataFrame, sample: DataFrame, bins: int = BINS) -> DataFrame:
    """log(target / raw) of each bin that any document has, both smoothed by half a count: (bin, ratio)."""
    trusted = sample.filter("good AND fits").select(F.col("doc_id").alias("_id"), F.lit(1).alias("_trusted"))
    split = once(docs.select("doc_id", "text"), _words=words(F.col("text")))
    counts = (split.join(F.broadcast(trusted), F.col("doc_id") == F.col("_id"), "left")  # at most `sample` ids
              .select("_trusted", F.explode(grams(F.col("_words"), bins)).alias("bin"))
              .groupBy("bin").agg(F.count("*").alias("raw"), F.count("_trusted").alias("target")))
    counts = keep(counts, "gram-counts")
    raw, target = counts.agg(F.sum("raw"), F.sum("target")).first()
    ratio = F.lit(0.0)
    if target:
        of = lambda n, total: F.log((F.col(n) + 0.5) / F.lit(total + 0.5 * bins))
        ratio = of("target", target) - of("raw", raw)
    return keep(counts.select("bin", ratio.alias("ratio")), "gram-ratios")


def scored(split: DataFrame, keys: list[str], model: DataFrame, bins: int = BINS) -> DataFrame:
    """(keys, score): the mean ratio of the n-grams of each row's `_words`; 0 if there are none. Keys tell rows apart."""
    listed = split.select(*keys, F.explode_outer(grams(F.col("_words"), bins)).alias("bin"))
    return (listed.join(F.broadcast(model), "bin", "left")  # at most `bins` rows
            .groupBy(*keys).agg(F.coalesce(F.sum("ratio") / F.count("bin"), F.lit(0.0)).alias("score")))


def threshold(docs: DataFrame, sample: DataFrame, model: DataFrame, bins: int = BINS) -> float:
    """The score that parts the labelled sample best, losing a good document counted twice; ties to the lowest score.

    Candidates are the middles between neighbouring quantiles of both classes; `sample` bounds
    what is scored.
    """
    known = sample.filter("NOT fits").select(F.col("doc_id").alias("_id"), "good")
    split = once(docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_id")),
                 _words=words(F.col("text")), _row=F.monotonically_increasing_id())
    judged = keep(scored(split, ["_row", "good"], model, bins).select("good", "score"), "scored-sample")
    cuts = [i / 400 for i in range(401)]
    good, bad = (judged.filter(F.col("good") == side).agg(F.percentile("score", cuts)).first()[0] for side in (True, False))
    if not good or not bad:
        return float("-inf")
    share = lambda side, at: sum(x < at for x in side) / len(side)
    scores = sorted({*good, *bad})
    middles = [(one + other) / 2 for one, other in zip(scores, scores[1:])]
    return min(middles or scores, key=lambda at: (2 * share(good, at) + 1 - share(bad, at), at))


def repeated_words(rows: DataFrame) -> DataFrame:
    """Add `n_repeat_words` to rows with an array `_words`: words in three-word windows that are found twice or more.

    Windows are compared by 64-bit hashes, sorted beside their places; texts without any
    repeated window skip the sort.
    """
    hashes = F.transform(
        F.slice("_words", 1, F.greatest(F.size("_words") - 2, F.lit(0))),
        lambda word, i: F.xxhash64(word, F.get("_words", i + 1), F.get("_words", i + 2)))
    rows = once(rows, _windows=hashes)
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    none = F.array().cast("array<struct<hash:bigint,at:int>>")
    rows = once(rows, _sorted=F.when(some, F.sort_array(F.transform(
        "_windows", lambda hash, at: F.struct(hash.alias("hash"), at.alias("at"))))).otherwise(none)).drop("_windows")
    same = lambda one, at: F.coalesce(F.get("_sorted", at)["hash"] == one["hash"], F.lit(False))
    places = F.sort_array(F.transform(
        F.filter("_sorted", lambda one, i: same(one, i - 1) | same(one, i + 1)), lambda one: one["at"]))
    rows = once(rows, _places=places).drop("_sorted")
    start = F.struct(F.lit(0).alias("covered"), F.lit(-3).alias("last"))
    covered = F.aggregate("_places", start, lambda state, at: F.struct(
        (state["covered"] + F.least(F.lit(3), at - state["last"])).alias("covered"), at.alias("last")))
    return rows.withColumn("n_repeat_words", covered["covered"].cast("long")).drop("_places")


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def verdicts(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bins: int = BINS) -> DataFrame:
    """One row a document: doc_id, a hash of its text as `tie`, the five counts, base_failed, score and kept."""
    docs = docs.select("doc_id", "text")
    chosen = keep(labelled(labels, sample), "labelled")
    model = ratios(docs, chosen, bins)
    least = threshold(docs, chosen, model, bins)

    text = F.coalesce("text", F.lit(""))
    split = once(docs, _words=words(F.col("text")), _row=F.monotonically_increasing_id(), _lines=F.filter(
        F.split(text, "\n"), lambda line: without(line, SPACES) != ""))
    split = split.withColumns({
        "tie": F.xxhash64(text), "n_words": F.size("_words").cast("long"), "word_chars": F.length(without(text, SPACES)).cast("long"),
        "n_symbols": (F.length(text) - F.length(without(text, SYMBOLS))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")}).drop("_lines", "text")
    rows = scored(repeated_words(split), ["_row", "doc_id", "tie", *METRICS], model, bins)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select("doc_id", "tie", *METRICS, failed.alias("base_failed"), "score",
                       (~failed & (F.col("score") >= F.lit(least))).alias("kept"))


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bins: int = BINS) -> DataFrame:
    """The documents with the counts, base_failed, score and kept added; other columns keep their names and order."""
    made = [*METRICS, "base_failed", "score", "kept"]
    docs, columns = set_aside(without_columns(docs, made), "doc_id", "text")
    found = verdicts(docs, labels, sample, bins).dropDuplicates(["doc_id", "tie"]).withColumnsRenamed({"doc_id": "_id", "tie": "_tie"})
    whole = docs.withColumn("_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    return whole.join(found, whole["doc_id"].eqNullSafe(found["_id"]) & (whole["_hash"] == found["_tie"])).select(*columns, *made)
