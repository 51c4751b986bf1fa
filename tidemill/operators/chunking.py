"""Splitting, packing, summarising and tagging of documents.

Steps on one document are column expressions on its row. The only step across documents, how many
use a word, is a sum over a fixed number of hash buckets. The summaries and tags are word
statistics, not the output of a language model.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.jsonx import DOCUMENT_TAGS, validate
from tidemill.functions.text import TOKEN, tokens, word_bucket, words
from tidemill.operators.skew import positions

# Frequent function words of five languages.
STOP_WORDS = {
    "english": "the of and to a in is that it for was on with as be by this are at from",
    "french": "de la le et les des en un du une que pour est par qui dans avec sur pas au",
    "german": "der die und in den von zu das mit sich des auf für ist im nicht dem ein eine als",
    "italian": "di e il che la in un per del non è una si con le da sono gli della al",
    "spanish": "de la que el en y los se del las un por con no su una para es al lo",
}
# Words that count for or against, and as aggressive.
POSITIVE = "good great excellent happy love best nice wonderful bon bien gut schön bueno feliz"
NEGATIVE = "bad poor terrible sad hate worst awful wrong mal mauvais schlecht malo triste"
AGGRESSIVE = "kill attack destroy fight war stupid idiot shut angry guerre krieg guerra"


def split_tokens(docs: DataFrame, size: int = 1000, overlap: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of at most ``size`` tokens: ``<key>, piece, n_tokens, text``; no shuffle.

    Each piece repeats the last ``overlap`` tokens of the one before. A text without tokens has
    no piece.
    """
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    step, together = size - overlap, 32
    n_pieces = F.greatest(F.ceil((F.size("__t") - overlap) / F.lit(step)), F.lit(1)).cast("int")
    # A generator copies its row's columns to each row it makes. Cutting blocks of 32 pieces first,
    # then pieces from a block, keeps these copies small beside the text.
    at = F.col("__i") * step
    return (
        docs.select(key, tokens(F.col(text)).alias("__t"))
        .where(F.size("__t") > 0)
        .select(key, "__t", n_pieces.alias("__n"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("__n") - 1, F.lit(together))).alias("__first"))
        .select(
            key, "__first", F.least(F.lit(together), F.col("__n") - F.col("__first")).alias("__n"),
            F.slice("__t", F.col("__first") * step + 1, F.lit(together * step + overlap)).alias("__b"),
        )
        .select("*", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("__i"))
        .select(key, (F.col("__first") + F.col("__i")).alias("piece"), F.slice("__b", at + 1, F.lit(size)).alias("__p"))
        .select(key, "piece", F.size("__p").alias("n_tokens"), F.array_join("__p", " ").alias("text"))
    )


def piece_sizes(text: Column, size: int) -> Column:
    """Token counts of a text's pieces, from its token count alone."""
    n = F.regexp_count(text, F.lit(TOKEN))
    full = F.floor(n / F.lit(size)).cast("int")
    rest = F.filter(F.array(n - full * size), lambda r: r > 0)
    return F.concat(F.array_repeat(F.lit(size), full), rest)


def pack(sizes: Column, budget: int) -> Column:
    """Group number of each consecutive piece, filling groups greedily up to ``budget``.

    A piece larger than the budget has a group of its own.
    """
    # Sizes of closed groups; an array is copied when it grows, so once per group and not per piece.
    start = F.struct(
        F.lit(0).alias("open"), F.lit(0).cast("long").alias("used"), F.array().cast("array<int>").alias("closed")
    )

    def step(state: Column, size: Column) -> Column:
        size = size.cast("long")
        fits = (state["open"] == 0) | (state["used"] + size <= budget)
        return F.when(
            fits, F.struct((state["open"] + 1).alias("open"), (state["used"] + size).alias("used"), state["closed"].alias("closed"))
        ).otherwise(
            F.struct(F.lit(1).alias("open"), size.alias("used"), F.concat(state["closed"], F.array(state["open"])).alias("closed"))
        )

    groups = F.aggregate(sizes, start, step, lambda s: F.when(s["open"] == 0, s["closed"]).otherwise(F.concat(s["closed"], F.array(s["open"]))))
    return F.flatten(F.transform(groups, lambda n, i: F.array_repeat(i, n)))


def packed_pieces(docs: DataFrame, size: int, budget: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``<key>, piece, grp``: groups of consecutive pieces of ``size`` tokens, filled up to ``budget``; no shuffle.

    All pieces are of one size but the last, so a group follows from a division, and only the last piece asks
    whether it still fits. :func:`pack` takes pieces of any sizes.
    """
    together = max(budget // size, 1)
    n = F.regexp_count(F.col(text), F.lit(TOKEN))
    counted_ = docs.select(key, n.alias("__n")).where(F.col("__n") > 0)
    full, rest = F.floor(F.col("__n") / F.lit(size)).cast("int"), F.col("__n") % size
    pieces = counted_.select(key, "__n", F.explode(F.sequence(F.lit(0), F.ceil(F.col("__n") / F.lit(size)).cast("int") - 1)).alias("piece"))
    group = F.floor(F.col("piece") / F.lit(together)).cast("int")
    # The group before the last piece, if that piece begins one and is small enough for what is left there.
    left = budget - F.when(F.col("piece") > 0, together * size).otherwise(budget + 1)
    fits = (F.col("piece") == full) & (F.col("piece") % together == 0) & (rest <= left)
    return pieces.select(key, "piece", F.when(fits, group - 1).otherwise(group).alias("grp"))


def stuff(text: Column, separator: str = " ") -> Column:
    """All tokens of a document in one string with single separators."""
    return F.array_join(tokens(text), separator)


def word_weights(docs: DataFrame, n_docs: Column, text: str = "text") -> DataFrame:
    """``bucket, idf`` with idf = ln((n_docs + 1) / (uses + 1)), at most 2**20 rows.

    Uses are counted per hash bucket, map-side first, so neither the vocabulary nor a word that
    every document uses makes the result or the shuffle grow.
    """
    uses = docs.select(F.explode(F.array_distinct(words(F.col(text)))).alias("word"))
    per_bucket = uses.groupBy(word_bucket(F.col("word")).alias("bucket")).agg(F.count("*").alias("uses"))
    return per_bucket.select("bucket", F.log((n_docs + 1) / (F.col("uses") + 1)).alias("idf"))


def counted(ws: Column) -> Column:
    """``array<struct<word,tf>>`` of an array of words, by word: counted in the row, without an exchange.

    Equal words are neighbours in the sorted array, so a count is the distance of two starts.
    """

    def starts_in(ordered: Column) -> Column:
        n = F.size(ordered)
        starts = F.filter(
            F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
            lambda i: (i < n) & ((i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))),
        )
        count = lambda at, j, starts: F.struct(
            F.get(ordered, at).alias("word"), (F.coalesce(F.get(starts, j + 1), n) - at).cast("long").alias("tf")
        )
        return _bound(starts, lambda held: F.transform(held, lambda at, j: count(at, j, held)))

    return _bound(F.sort_array(ws), starts_in)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def piece_words(docs: DataFrame, size: int, key: str = "doc_id", text: str = "text", *keep: str) -> DataFrame:
    """``<key>, <keep>, piece, word, tf`` with pieces of ``size`` words, each counted where its text is."""
    last = F.greatest(F.floor((F.size("__w") - 1) / F.lit(size)).cast("int"), F.lit(0))
    pieces = F.transform(F.sequence(F.lit(0), last), lambda p: F.slice("__w", p * size + 1, F.lit(size)))
    cut = docs.select(key, *keep, words(F.col(text)).alias("__w")).select(key, *keep, F.posexplode(pieces).alias("piece", "__p"))
    return cut.select(key, *keep, "piece", F.inline(counted(F.col("__p"))))


def _top(rows: DataFrame, by: list[str], n: int) -> DataFrame:
    """The ``n`` rows of each group with the highest score; cut inside each task before anything is shuffled."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc("word")))
    return rows.select("*", rank.alias("__r")).where(F.col("__r") <= n).drop("__r")


def _scored(rows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """``word`` and ``tf`` replaced by ``word, score``, with the weights of all texts in ``docs``."""
    weights = F.broadcast(word_weights(docs, docs.agg(F.count("*")).scalar(), text))
    kept = [c for c in rows.columns if c not in ("word", "tf")]
    scored = rows.withColumn("bucket", word_bucket(F.col("word"))).join(weights, "bucket")
    return scored.select(*kept, "word", (F.col("tf") * F.col("idf")).cast("decimal(18,6)").alias("score"))


def piece_themes(docs: DataFrame, size: int = 1000, n: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The ``n`` words of each piece with the highest TF-IDF: ``<key>, piece, word, score``.

    Scores are decimals of 6 places: equal ones tie, so that the word decides, and sums of them
    do not depend on the order.

    No exchange carries a text or all of its words: words are counted in the text's row, weighted by a
    broadcast of at most 2**20 rows, and only the best of each piece in a task go on to the reducers.
    """
    return _top(_scored(piece_words(docs, size, key, text), docs, text), [key, "piece"], n)


def primary_topics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The word of each document with the highest TF-IDF."""
    whole = piece_themes(docs, size=1_000_000_000, n=1, key=key, text=text)
    return whole.select(key, F.col("word").alias("primary_topic"))


def theme_summary(themes: DataFrame, n: int = 10, key: str = "doc_id") -> DataFrame:
    """Merge the themes of a document's pieces: scores add up, the ``n`` best remain.

    A sum combines in any grouping, so there is no size at which pieces need an extra merge round.
    """
    # By document, where they are ranked: a few rows per piece move once.
    merged = themes.repartition(key).groupBy(key, "word").agg(
        F.sum("score").alias("score"), F.count("*").alias("n_pieces")
    )
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), F.asc("word")))
    return merged.select("*", rank.alias("rank")).where(F.col("rank") <= n)


def refine_additions(themes: DataFrame, key: str = "doc_id") -> DataFrame:
    """What each piece adds to the summary so far: ``<key>, piece, position, word``.

    A word is added by the first piece that has it, in the order of that piece's scores. The summary
    after a piece is the words of all pieces up to it by ``position``, so every state is a prefix of one list,
    and the result has a row per word, not per word and piece.
    """
    firsts = themes.groupBy(key, "word").agg(F.min(F.struct("piece", (-F.col("score")).alias("below"))).alias("__f"))
    placed = firsts.select(key, F.col("__f.piece").alias("piece"), F.col("__f.below").alias("__below"), "word")
    return positions(placed, [key], "piece", "__below", "word").select(key, "piece", "position", "word")


def refine_summary(themes: DataFrame, key: str = "doc_id") -> DataFrame:
    """The summary after each piece that has themes, written out: as long as all states together.

    A document's additions are one list, no longer than its text, and each state is cut from it: only additions are
    shuffled, not states.
    """
    listed = F.sort_array(F.collect_list(F.struct("position", "piece", "word")))
    added = refine_additions(themes, key).groupBy(key).agg(listed.alias("__added"))
    steps = themes.select(key, "piece").distinct()
    so_far = F.filter("__added", lambda a: a["piece"] <= F.col("piece"))
    return steps.join(added, key).select(key, "piece", F.transform(so_far, lambda a: a["word"]).alias("summary"))


def _share(ws: Column, vocabulary: str) -> Column:
    known = vocabulary.split()  # a hash set in the plan
    return F.size(F.filter(ws, lambda w: w.isin(known)))


def with_language(docs: DataFrame, text: str = "text", out: str = "language") -> DataFrame:
    """Add the language with the most stop words in the whole text; the first by name on a tie."""
    every = sorted({w for listed in STOP_WORDS.values() for w in listed.split()})
    # A column of its own, so that texts are split once and not once per language.
    found = docs.select("*", F.filter(words(F.col(text)), lambda w: w.isin(every)).alias("__s"))
    scores = [
        F.struct(_share(F.col("__s"), STOP_WORDS[name]).alias("score"), F.lit(-i).alias("order"), F.lit(name).alias("name"))
        for i, name in enumerate(sorted(STOP_WORDS))
    ]
    return found.withColumn(out, F.array_max(F.array(*scores))["name"]).drop("__s")


def _tags(ws: Column) -> list[Column]:
    """``sentiment`` (happy, neutral, sad) and ``aggressiveness`` (1 to 5) of an array of words, from word lists."""
    lean = _share(ws, POSITIVE) - _share(ws, NEGATIVE)
    per_hundred = F.floor(_share(ws, AGGRESSIVE) * 100 / F.greatest(F.size(ws), F.lit(1)))
    return [
        F.when(lean > 0, "happy").when(lean < 0, "sad").otherwise("neutral").alias("sentiment"),
        F.least(1 + per_hundred, F.lit(5)).cast("int").alias("aggressiveness"),
    ]


def tag_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``sentiment`` and ``aggressiveness`` of each text."""
    return docs.select(key, words(F.col(text)).alias("__w")).select(key, *_tags(F.col("__w")))


def tag_with_topic(docs: DataFrame, key: str = "doc_id", text: str = "text", *keep: str) -> DataFrame:
    """``<key>, <keep>, sentiment, aggressiveness, primary_topic``, one row per document, its tags checked as a reply.

    Tags are found in the row that is counted for the topic, so a text is read once for both and once
    for the weights. A text without words has no topic, and is reported as not valid: ``errors, valid``.
    """
    ws = F.col("__w")
    # Tags come before the generator, which would find them, and copy the text, once for each word.
    tagged = docs.select(key, *keep, words(F.col(text)).alias("__w")).select(key, *keep, *_tags(ws), counted(ws).alias("__c"))
    rows = tagged.select(key, *keep, "sentiment", "aggressiveness", F.inline_outer("__c"))
    # The weight of a bucket without a word is that of no word: an outer row keeps its place.
    bucket = F.when(F.col("word").isNotNull(), word_bucket(F.col("word")))
    weights = F.broadcast(word_weights(docs, docs.agg(F.count("*")).scalar(), text))
    scored = rows.withColumn("bucket", bucket).join(weights, "bucket", "left").select(
        key, *keep, "sentiment", "aggressiveness", "word", (F.col("tf") * F.col("idf")).cast("decimal(18,6)").alias("score")
    )
    best = _top(scored, [key], 1).withColumnRenamed("word", "primary_topic")
    reply = F.to_json(F.struct("sentiment", "aggressiveness", "primary_topic")).alias("__reply")
    checked = validate(best.select(key, *keep, reply), "__reply", DOCUMENT_TAGS)
    return checked.drop("__reply")


def page_text(html: Column) -> Column:
    """A page's words without its markup, scripts and styles."""
    shown = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(shown, "<[^>]*>", " ")
