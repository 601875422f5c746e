"""Operator 12: spelling variants of words, found by pivotal grams.

1. Words are counted over the whole texts. Bigrams are ranked by the number of words that have them, rarest first.
2. A word's prefix is its three rarest bigrams (and others of the same bigram as the third). One edit touches at most
   two neighbouring bigrams, so that of two *disjoint* bigrams of the prefix, the pivots, one survives. They are chosen
   by dynamic programming as the pair with the smallest number of words.
3. Of two words that are one edit apart, the pivots of the one whose prefix ends earlier in the ranking meet the prefix
   of the other. Pivots of all words are therefore joined with the prefixes of all others.
4. Limits by position: a surviving pivot has the edit on one side, so the other side of the word is equal, and with it the
   pivot's place from that end. Of the side with the edit, one half is equal, too. Both go into the join key, so that
   words that only share a bigram never meet.
5. Pairs that meet are verified by their edit distance inside the join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.storage import stored

#: Letters of a word once A-Z are lower-cased, and the two alphabets of that step.
LETTERS = "a-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Code points and occurrences of a word at least, and how many times as frequent its form must be.
LEAST_LENGTH, LEAST_COUNT, FORM_TIMES = 7, 2, 10
#: Every so-manyth run loses a code point.
TYPO = 31
#: A side of so many code points with the edit is not cut into halves.
SHORT_SIDE = 3

Ranks = dict[str, tuple[int, int]]


def counted_words(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    typo: int = TYPO,
) -> DataFrame:
    """``word, n`` of all texts. A null text has no words; a null id counts as an empty one in the checksum."""
    text = F.translate(docs[text_column].cast("string"), UPPER, LOWER)
    ident = F.coalesce(docs[id_column].cast("string"), F.lit(""))
    runs = docs.select(ident.alias("id"), F.explode(F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))).alias("run"))
    check = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "utf-8"))
    at = F.pmod(check, F.length("run").cast("long")).cast("int")
    short = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = runs.select(F.when(F.pmod(check, F.lit(typo).cast("long")) == 0, short).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def gram_ranks(words: DataFrame) -> Ranks:
    """(rank, number of words) of every bigram, rarest first; bounded by the square of the alphabet (90 letters)."""
    places = F.sequence(F.lit(1), F.length("word") - 1)
    grams = F.array_distinct(F.transform(places, lambda i: F.substring(F.col("word"), i, F.lit(2))))
    found = words.select(F.explode(grams).alias("gram")).groupBy("gram").count().collect()
    return {gram: (rank, n) for rank, (n, gram) in enumerate(sorted((r["count"], r["gram"]) for r in found))}


def prefix_of(word: str, ranks: Ranks) -> list[int]:
    """Positions of the prefix grams in rising order: the three rarest, and all that equal the third."""
    grams = sorted((ranks[word[i : i + 2]][0], i) for i in range(len(word) - 1))
    last = grams[min(2, len(grams) - 1)][0]
    return sorted(i for rank, i in grams if rank <= last)


def pivots_of(word: str, prefix: list[int], ranks: Ranks) -> tuple[int, int]:
    """The two disjoint prefix grams that the fewest words have.

    ``one[i]`` is the cheapest gram at or before ``i``; a pair ends in a gram and has the cheapest one that is disjoint from it.
    """
    one: list[tuple[int, int] | None] = [None] * len(word)
    pair = None
    cost = {i: ranks[word[i : i + 2]][1] for i in prefix}
    for i in range(len(word) - 1):
        one[i] = one[i - 1] if i else None
        if i in cost:
            before = one[i - 2] if i >= 2 else None
            if before and (pair is None or before[0] + cost[i] < pair[0]):
                pair = before[0] + cost[i], before[1], i
            if one[i] is None or cost[i] < one[i][0]:
                one[i] = cost[i], i
    return pair[1], pair[2]


def side_keys(word: str, at: int, side: str, own: bool) -> Iterator[str]:
    """Keys of the gram at ``at`` if the edit lies behind it; for an edit before it, the word comes reversed.

    The word up to the gram's end is equal. What comes behind has ``rest`` code points in the word that has the pivot,
    and one of its halves is equal; the other word (``own`` false) doesn't know ``rest``, but it is its own up to one.
    """
    known = at + 2
    mine = len(word) - known
    for rest in {mine} if own else {max(mine - 1, 0), mine, mine + 1}:
        if rest <= SHORT_SIDE:
            yield f"{side}{known}:{word[:known]}"
        else:
            half = rest // 2
            yield f"{side}{known}<{word[: known + half]}"
            if rest - half <= mine:
                yield f"{side}{known}>{word[:known]} {word[half - rest :]}"


def keys_of(word: str, ranks: Ranks, own: bool) -> set[str]:
    """Join keys of a word as the one with the pivots (``own``), or as the one with the prefix."""
    prefix = prefix_of(word, ranks)
    back = word[::-1]
    keys: set[str] = set()
    for at in pivots_of(word, prefix, ranks) if own else prefix:
        keys.update(side_keys(word, at, "+", own))
        keys.update(side_keys(back, len(word) - 2 - at, "-", own))
    return keys


def _keyed(words: DataFrame, ranks: Ranks, own: bool) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        for batch in batches:
            listed = [[xxh3_64_intdigest(key) - (1 << 63) for key in keys_of(word, ranks, own)] for word in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(listed, pa.list_(pa.int64()))], names=["word", "n", "keys"])

    return words.select("word", "n").mapInArrow(task, "word string, n long, keys array<long>")


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: pairs of words that one inserted, deleted or replaced code point tells apart, both ways.

    ``words`` has distinct ``word`` of at least four code points, and ``n``.
    """
    ranks = gram_ranks(words)
    pivots = _keyed(words, ranks, True).select("word", "n", F.explode("keys").alias("key"))
    prefixes = _keyed(words, ranks, False).select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.explode("keys").alias("key"))
    close = F.levenshtein(F.col("word"), F.col("near"), 1) == 1
    met = pivots.join(prefixes, "key").where((F.abs(F.length("word") - F.length("near")) <= 1) & close)
    pair = ["word", "n", "near", "near_n"]
    back = met.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return met.select(*pair).unionByName(back).distinct()


def roots(forms: DataFrame, most_n: int, times: int = FORM_TIMES) -> DataFrame:
    """``word, root`` for rows ``word, form``: the last of the forms that follow each other.

    A form is ``times`` as frequent as its word at least, so chains end, after a number of steps that ``most_n`` bounds;
    every round doubles the steps taken.
    """
    steps = max(1, math.ceil(math.log(max(most_n, 2), times)))
    jump = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        onward = jump.select(F.col("word").alias("_at"), F.col("root").alias("_on"))
        jump = stored(jump.join(onward, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_on", "root").alias("root")))
    return jump


def spelling_variants(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    times: int = FORM_TIMES,
    typo: int = TYPO,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: one row per word.

    Words are runs of letters, A-Z lower-cased; every ``typo``-th one by checksum of id and run loses a code point first.
    They have at least ``least_length`` (four or more) code points and ``least_count`` occurrences. ``form`` is the near
    word with the most occurrences (ties: the smallest in code-point order) if it has ``times`` as many or more, else
    null; ``root`` is the last form of the chain, or the word. Null, empty and white texts have no words; repeated rows
    count again; an empty table gives no rows. Other columns are left out, so their names can't clash.
    """
    if least_length < 4:
        raise ValueError("words of fewer than four code points have no two disjoint bigrams that are sure to be rare ones")
    words = stored(counted_words(docs, id_column, text_column, least_length, least_count, typo))
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w")))
    near = stored(near_words(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best")))
    formed = near.where(-F.col("best.m") >= times * F.col("n")).select("word", F.col("best.w").alias("form"), (-F.col("best.m")).alias("form_n"))
    formed = stored(formed)
    most = words.agg(F.max("n")).first()[0] or 1
    found = (
        words.join(near.select("word", "n_near"), "word", "left")
        .join(formed, "word", "left")
        .join(roots(formed, most, times), "word", "left")
    )
    return found.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )
