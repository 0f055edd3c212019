"""Quality rules by weak supervision, in DataFrame functions only.

Each rule looks at one statistic of a text and votes good (1), votes bad (-1) or abstains (0). No labels are read: an
expectation-maximisation over all documents estimates how far each rule can be trusted, for either class by itself, and
how many documents are good. A document is kept by its posterior probability of being good, so that one unlucky rule no
longer throws a document away. Texts below the base rules (too short, or mostly repeated) go whatever the votes say.

Texts are read once. What goes on is a row of counts for each document, and then one row for each distinct combination of
votes, of which there are 3 ** len(RULES) = 59,049 at most whatever the corpus. The maximisation runs over that table
in one expression.

Windows of three words are compared by hash first; those whose hash occurs twice in their text are compared as words.

Defined results: null text is empty and has no words; rows without a doc_id are left out; rows that share a doc_id are
judged each; ties of the posterior with KEEP are kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrivena.llm._common import documents, scratch

#: Base rules: fewest words, and the greatest share of repeated words in percent.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: The posterior from which a document is kept, rounds of the maximisation, and the bounds of an accuracy.
KEEP, ROUNDS, LOW, HIGH = 0.5, 30, 0.55, 0.999
SYMBOLS = "#*$%&|<>"
#: Frequent short words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "a", "al", "als", "an", "and", "are", "as", "at", "au", "auf", "be", "but", "by", "con", "das", "de", "del", "dem", "den", "der", "des", "die", "du", "ein", "el",
    "elle", "en", "es", "et", "for", "from", "he", "im", "in", "is", "it", "la", "le", "les", "los", "mit", "nicht", "of", "on", "or", "par", "para", "pas", "por", "pour",
    "que", "qui", "se", "sich", "su", "sur", "than", "that", "the", "this", "to", "un", "una", "und", "une", "von", "was", "with", "y", "zu",
)

#: Names of the rules, in the order of their votes.
RULES = ("symbols", "plain_words", "function_words", "letters", "doubled_marks", "shouting", "repetition", "variety", "duplicate_lines", "sentence_ends")


def rules() -> dict[str, tuple[Column, Column]]:
    """name -> (votes bad where, votes good where), over the columns of statistics(); a rule abstains where neither holds."""
    n, lines = F.col("n_words"), F.col("n_lines")
    more = lambda c, percent, of=n: 100 * F.col(c) > percent * of
    found = (
        (more("n_symbols", 10), ~more("n_symbols", 2)),
        (~more("n_plain", 70), more("n_plain", 95)),
        (~more("n_function", 8), more("n_function", 12)),
        (~more("n_letters", 80, F.col("word_chars")), more("n_letters", 90, F.col("word_chars"))),
        (more("n_doubled", 10), ~more("n_doubled", 2)),
        (more("n_upper", 30), ~more("n_upper", 10)),
        (more("n_repeat_words", 20), ~more("n_repeat_words", 5)),
        (~more("n_distinct", 15), more("n_distinct", 35)),
        (more("n_dup_lines", 30, lines), (F.col("n_dup_lines") == 0) & (lines >= 2)),
        (~more("n_ended", 10, lines) & (lines >= 4), more("n_ended", 60, lines)),
    )
    return dict(zip(RULES, found, strict=True))


def _with(value: Column, f) -> Column:
    """f(value), value computed once."""
    return F.transform(F.array(value), f)[0]


def repeated_words(words: Column) -> Column:
    """How many words lie in three-word windows that occur twice or more in the array."""
    three = lambda w, i: (F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    none = F.array().cast("array<int>")
    starts = lambda w: F.when(F.size(w) >= 4, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(none)
    # Sorted structs of key and place; a key that equals one of its neighbours' occurs twice.
    twins = lambda s: F.filter(F.transform(s, lambda x, k: F.when((x["k"] == F.get(s, k - 1)["k"]) | (x["k"] == F.get(s, k + 1)["k"]), x["i"])), lambda i: i.isNotNull())
    keyed = lambda at, key: _with(F.sort_array(F.transform(at, lambda i: F.struct(key(i).alias("k"), i.alias("i")))), twins)
    alike = lambda w: keyed(starts(w), lambda i: F.xxhash64(*three(w, i)))
    equal = lambda w: keyed(alike(w), lambda i: F.concat_ws(" ", *three(w, i)))
    # Every window covers three words, or as many as there are up to the next one.
    cover = lambda p: F.aggregate(F.transform(p, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - i, F.lit(3)))), F.lit(0), lambda a, b: a + b)
    return _with(words, lambda w: _with(F.sort_array(equal(w)), cover)).cast("long")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules look at; no texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents(docs).select("doc_id", text.alias("text"))
    rows = rows.withColumn("w", F.filter(F.split("text", r"[ \t\n\x0B\f\r]+"), lambda w: w != "")).withColumn("l", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]")))
    count = lambda of, what: F.size(F.filter(of, what)).cast("long")
    without = lambda chars: F.char_length("text") - F.char_length(F.translate("text", chars, ""))
    return rows.select(
        "doc_id", F.size("w").cast("long").alias("n_words"), F.char_length(F.regexp_replace("text", r"[ \t\n\x0B\f\r]+", "")).cast("long").alias("word_chars"),
        without(SYMBOLS).cast("long").alias("n_symbols"), (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"), repeated_words(F.col("w")).alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"), F.char_length(F.regexp_replace("text", r"\P{L}+", "")).cast("long").alias("n_letters"), F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        count(F.col("w"), lambda w: w.rlike(r"^[\"'(\[]?\p{L}+(?:[-'\u2019]\p{L}+)*[.,;:!?)\]\"']?$")).alias("n_plain"), count(F.col("w"), lambda w: w.rlike(r"[^\p{L}\p{N}]{2}$")).alias("n_doubled"),
        count(F.col("w"), lambda w: w.rlike(r"^(?=..)\P{Ll}*\p{Lu}\P{Ll}*$")).alias("n_upper"), count(F.col("w"), lambda w: F.lower(w).isin(*FUNCTION_WORDS)).alias("n_function"),
        count(F.col("l"), lambda x: x.rlike(r"[.!?][\"')\]]*\s*$")).alias("n_ended"),
    )


def votes() -> Column:
    """array<int>, one vote a rule. A text without words gets no good vote."""
    return F.array(*(F.when(bad, -1).when(good & (F.col("n_words") > 0), 1).otherwise(0) for bad, good in rules().values()))


def failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def posterior(vote: Column, model: Column) -> Column:
    """The probability of being good, given the votes and struct<prior, good: array, bad: array> of accuracies."""
    weights = F.zip_with(model["good"], model["bad"], lambda g, b: F.struct(F.log(g / (1 - b)).alias("up"), F.log((1 - g) / b).alias("down")))
    terms = F.zip_with(vote, weights, lambda v, w: F.when(v == 1, w["up"]).when(v == -1, w["down"]).otherwise(0.0))
    return 1 / (1 + F.exp(-F.aggregate(terms, F.log(model["prior"] / (1 - model["prior"])), lambda a, x: a + x)))


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row: model, the accuracies after so many rounds of expectation and maximisation. patterns: votes, n."""
    k = len(RULES)
    # 3 ** k combinations at most, in a fixed order, so that sums come out alike however the rows lay.
    table = patterns.groupBy("votes").agg(F.sum("n").alias("n")).agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("p"))
    start = F.struct(F.lit(0.7).alias("prior"), F.array_repeat(F.lit(0.8), k).alias("good"), F.array_repeat(F.lit(0.8), k).alias("bad"))
    total = lambda of, what: F.aggregate(of, F.lit(0.0), lambda a, x: a + what(x))
    inside = lambda x, low, high: F.least(F.greatest(x, F.lit(low)), F.lit(high))

    def accuracy(rows: Column, share: str, vote: int) -> Column:
        """Of the share's votes on each rule, how many are the right one; one more right and one more wrong."""
        right = lambda j: total(rows, lambda x: F.when(F.get(x["votes"], j) == vote, x[share]).otherwise(0.0))
        all_ = lambda j: total(rows, lambda x: F.when(F.get(x["votes"], j) != 0, x[share]).otherwise(0.0))
        return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: inside((right(j) + 1) / (all_(j) + 2), LOW, HIGH))

    def maximised(rows: Column) -> Column:
        prior = (total(rows, lambda x: x["good"]) + 1) / (total(rows, lambda x: x["good"] + x["bad"]) + 2)
        return F.struct(inside(prior, 0.01, 0.99).alias("prior"), accuracy(rows, "good", 1).alias("good"), accuracy(rows, "bad", -1).alias("bad"))

    def step(model: Column, p: Column) -> Column:
        split = lambda x, q: F.struct(x["votes"].alias("votes"), (x["n"] * q).alias("good"), (x["n"] * (1 - q)).alias("bad"))
        return _with(F.transform(p, lambda x: _with(posterior(x["votes"], model), lambda q: split(x, q))), maximised)

    return table.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda m, _: step(m, F.col("p"))).alias("model"))


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, votes, base_failed, quality (the posterior) and kept."""
    rows = scratch(statistics(docs).select("*", votes().alias("votes"), failed().alias("base_failed")), "rules")
    # The model is one row of 2 * len(RULES) + 1 numbers. Texts that the base rules reject tell nothing about the others.
    model = estimate(rows.where(~F.col("base_failed")).groupBy("votes").agg(F.count("*").alias("n")))
    rows = rows.crossJoin(F.broadcast(model)).withColumn("quality", posterior(F.col("votes"), F.col("model"))).drop("model")
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP))
