"""Bills to buildings by what is printed on them: customer name and service address.

Both sides become sets of words. Two sets are similar if their Jaccard similarity reaches a
threshold; pairs are found by prefix filtering, which misses none:

- Words are put in one order, rarest first. Two similar sets of sizes a and b share at least
  `need(a)` words, and so one among the first a - need(a) + 1 of each, and two among the first
  a - need(a) + 2.
- Where the rarest shared word is not hot, it is a key of both sets by itself. Where it is hot,
  every other shared word is, too, so pairs of a hot word with a commoner one are keys. A word that
  much of the table holds ("street") is never a key by itself, however large the table.
- A pair of words that is hot itself is a key together with a third one, three hot ones with a
  fourth, and so on: two sets share three among the first a - need(a) + 3 of each, and so on. Keys
  are counted for it, so words that often go together ("new york") are followed, too.
- Words and keys that only one of the tables has are shared by no two sets. Such words come first
  in the order, where they take the places of words that could be keys.
- Sets that share a key and whose sizes allow it are compared in full.

Equal sets are one row on either side before anything is joined, so a customer that much of the
bills name costs one comparison. Parties and words grow with the bills, and rows of words are many
times larger than the columns they are made of, by which Spark estimates: all joins are shuffled.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.operators.bills import bill_columns
from wattledger.operators.joins import dealt_anew, join_lookup
from wattledger.session import stored

PARTY = ("customer_name", "service_address")
THRESHOLD = 0.7
# A word that more sets hold than this is only a key together with another one.
HOT_SETS = 200


def word_set(*texts: str) -> Column:
    """The different words of some columns, sorted; words are letters and digits, lower case."""
    words = F.split(F.lower(F.concat_ws(" ", *texts)), r"[^\p{L}\p{N}]+")
    return F.array_sort(F.array_distinct(F.filter(words, lambda word: word != "")))


def party_key(*texts: str) -> Column:
    """A party's words as one text, null without any: what tells parties apart."""
    return F.nullif(F.array_join(word_set(*texts), " "), F.lit(""))


def _ranked(sets: DataFrame, frequency: DataFrame) -> DataFrame:
    """words, ranked: each set's words with the number of sets that hold them, rarest first."""
    entry = F.struct("sets", "word")
    held = sets.select("words", F.explode("words").alias("word"))
    # Words are as many as parties, so neither side is sent whole to the driver; a hot word's sets
    # are cut into parts.
    return (
        join_lookup(held, frequency.hint("merge"), "word", "inner", spread_by=["words"])
        .groupBy("words")
        .agg(F.array_sort(F.collect_list(entry)).alias("ranked"))
    )


def _need(size: Column, threshold: float) -> Column:
    """The least number of words that a set shares with any similar one; rounding must not raise it."""
    return F.ceil(F.lit(threshold) * size - 1e-9).cast("int")


def _keys(ranked: Column, threshold: float, hot: int) -> Column:
    """The keys of a set of one and two words, by prefix filtering."""
    size = F.size(ranked)
    need = _need(size, threshold)
    first = F.slice(ranked, F.lit(1), size - need + 1)
    second = F.slice(ranked, F.lit(1), F.least(size - need + 2, size))
    rare = F.transform(F.filter(first, lambda w: w["sets"].between(1, hot)), lambda w: w["word"])
    pairs = F.flatten(
        F.transform(
            first,
            lambda w, at: F.transform(
                F.filter(second, lambda _, place: (w["sets"] > hot) & (place > at)),
                lambda other: F.concat_ws(" ", w["word"], other["word"]),
            ),
        )
    )
    # A set of one hot word is similar to its equal only.
    alone = F.when(
        (size == 1) & (F.size(rare) == 0), F.array(F.concat(F.lit(" "), ranked[0]["word"]))
    ).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(rare, pairs, alone))


def _longer(threshold: float, words: int) -> Column:
    """A set's keys of `words` words that begin with its `key` of one word less: one more of its
    words, in their order. A set similar to one that shares more words than itself needs has them
    anywhere."""
    size = F.size("ranked")
    last = F.array_position("ranked", F.element_at(F.split("key", " "), -1)).cast("int")
    window = F.least(size - _need(size, threshold) + words, size)
    return F.transform(
        F.slice("ranked", last + 1, F.greatest(window - last, F.lit(0))),
        lambda word: F.concat_ws(" ", "key", word),
    )


def _keyed(sets: DataFrame, threshold: float, hot: int) -> DataFrame:
    """left, ranked, key: the sets of two tables (`left` or not; `ranked`: words with the number of
    sets that hold them) under keys that both tables have and that are not hot, or can't be longer."""
    keyed = stored(
        sets.select(
            "left", "ranked", F.explode(_keys(F.col("ranked"), threshold, hot)).alias("key")
        ).withColumn("ranked", F.col("ranked.word")),
        "keyed",
    )
    kept, words = [], 2
    while True:
        counts = (
            keyed.groupBy("key")
            .agg(F.count_if("left").alias("_left"), F.count_if(~F.col("left")).alias("_right"))
            .where("_left > 0 and _right > 0")
        )
        long = F.size(F.split("key", " ")) == words
        is_hot = long & ~F.startswith("key", F.lit(" ")) & (F.col("_left") + F.col("_right") > hot)
        counted = stored(
            join_lookup(keyed, dealt_anew(counts).hint("merge"), "key", "inner").select(
                "left", "ranked", "key", is_hot.alias("hot")
            ),
            "counted",
        )
        # Sets that need no more words than the key has are similar under it at the latest.
        ended = _need(F.size("ranked"), threshold) <= words
        kept.append(counted.where(~F.col("hot") | ended).drop("hot"))
        open_ = counted.where("hot")
        if open_.isEmpty():
            return reduce(DataFrame.unionAll, kept)
        words += 1
        keyed = open_.select("left", "ranked", F.explode(_longer(threshold, words)).alias("key"))


def similar_sets(
    left: DataFrame, right: DataFrame, threshold: float = THRESHOLD, hot: int = HOT_SETS
) -> DataFrame:
    """left_words, right_words, similarity: all pairs of the sets `words` of two tables, sets
    equal within a table counted once, that reach the threshold."""
    if not 0.5 < threshold <= 1:
        raise ValueError("threshold must be above one half, at most 1")
    sides = [
        stored(side.select("words").where(F.size("words") > 0).distinct(), "sets").select(
            F.lit(is_left).alias("left"), "words"
        )
        for is_left, side in ((True, left), (False, right))
    ]
    held = sides[0].unionAll(sides[1]).select("left", F.explode("words").alias("word"))
    # A word of one table only is held by no two sets that are compared.
    shared_by = F.when(F.count_if("left") * F.count_if(~F.col("left")) > 0, F.count(F.lit(1)))
    frequency = held.groupBy("word").agg(F.coalesce(shared_by, F.lit(0)).alias("sets"))
    ranked = [
        _ranked(side, frequency).select(F.lit(is_left).alias("left"), "ranked")
        for is_left, side in zip((True, False), sides)
    ]
    keyed = _keyed(ranked[0].unionAll(ranked[1]), threshold, hot)
    of_side = [
        keyed.where(F.col("left") == is_left).select(F.col("ranked").alias(f"{name}_words"), "key")
        for name, is_left in (("left", True), ("right", False))
    ]
    a, b = F.size("left_words"), F.size("right_words")
    shared = F.size(F.array_intersect("left_words", "right_words"))
    similarity = shared / (a + b - shared)
    in_order = [F.array_sort(name).alias(name) for name in ("left_words", "right_words")]
    return (
        of_side[0]
        .join(of_side[1].hint("merge"), "key")
        .where(F.least(a, b) >= threshold * F.greatest(a, b) - 1e-9)
        .select("left_words", "right_words", similarity.alias("similarity"))
        .where(F.col("similarity") >= threshold)
        .select(*in_order, "similarity")
        .distinct()
    )


def link_buildings(
    bills: DataFrame, buildings: DataFrame, threshold: float = THRESHOLD, hot: int = HOT_SETS
) -> DataFrame:
    """The building of every party that bills name: `party` (its words), `building_id` (null if
    several fit best or none does), `similarity` of the best, `candidates` (buildings that fit
    that well), `link` (LINKED, AMBIGUOUS, UNMATCHED).

    buildings: building_id and the columns of PARTY; a building may be listed under several
    names. A bill without any word in these columns has no party.
    """
    # Words are looked for in every bill once.
    words = bills.select(word_set(*PARTY).alias("words")).where(F.size("words") > 0)
    parties = stored(words.distinct(), "parties")
    known = stored(
        buildings.where("building_id is not null").select(
            word_set(*PARTY).alias("right_words"), "building_id"
        ),
        "known",
    )
    pairs = similar_sets(parties, known.withColumnRenamed("right_words", "words"), threshold, hot)
    # One building may be found under several of its names: its best one counts.
    scored = (
        pairs.join(known.hint("merge"), "right_words")
        .groupBy("left_words", "building_id")
        .agg(F.max("similarity").alias("similarity"))
    )
    # Ties are counted before the best is taken, so no list of candidates is gathered.
    best = (
        scored.groupBy("left_words", "similarity")
        .agg(F.count(F.lit(1)).alias("candidates"), F.min("building_id").alias("building_id"))
        .groupBy("left_words")
        .agg(F.max(F.struct("similarity", "candidates", "building_id")).alias("best"))
        .select(F.array_join("left_words", " ").alias("party"), "best.*")
    )
    several = F.col("candidates") > 1
    return (
        parties.select(F.array_join("words", " ").alias("party"))
        .join(best.hint("merge"), "party", "left")
        .select(
            "party",
            F.when(~several, F.col("building_id")).alias("building_id"),
            "similarity",
            F.coalesce("candidates", F.lit(0)).alias("candidates"),
            F.when(F.col("candidates").isNull(), F.lit("UNMATCHED"))
            .when(several, F.lit("AMBIGUOUS"))
            .otherwise(F.lit("LINKED"))
            .alias("link"),
        )
    )


def add_linked_buildings(
    bills: DataFrame, buildings: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """Bills with `building_id`, `similarity`, `candidates` and `link` of their party; bills
    without a party are UNMATCHED. The bills are read twice: pass a stored table."""
    links = link_buildings(bills, buildings, threshold)
    named = bills.withColumn("party", party_key(*PARTY))
    joined = join_lookup(named, links, "party", spread_by=bill_columns(bills))
    return joined.withColumns(
        {
            "candidates": F.coalesce("candidates", F.lit(0)),
            "link": F.coalesce("link", F.lit("UNMATCHED")),
        }
    ).drop("party")
