"""Near-duplicate lines removed by an exact set-similarity join.

A line is the set of its words. Two lines match if their Jaccard similarity reaches the threshold;
the later one, by document id and line number, is removed. The words of every line are ordered by
rarity. Two lines that match differ in few words, so that somewhere early in that order two words
follow each other in both lines: each word in which they differ parts one such pair at most. Lines
meet by pairs of words that follow each other, as many from the beginning as it takes (at thresholds
too low for that, by single words). Most pairs of words have one class of lines only: they are summed
up and go without a sort. What meets must be of similar size (length filter), a parity sketch of the
words bounds how many differ, and what passes is verified on the words themselves.

Lines of equal sets meet once, as a class. A line is removed by any one earlier line, so each is first
compared with a few likely ones: those that share its smallest or its largest word hashes, the first
of them and the last few before it. Only classes for which none of these matches look for all
others. So a group of similar lines does not give all its pairs, and none is lost.

All of it is DataFrame expressions. The driver gets one thing, for each of ``BUCKETS`` buckets how
far the words in it exceed an even share, by which rarity is ordered: a frequent word is never taken
for a rare one.
Any order gives the same result. Words meet by 58 bits of hash, sets by 64-bit hashes of those.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from vintara.llm.common import BLANKS, let, packed, unpacked
from vintara.operators.joins import lookup_join
from vintara.session import release, settle, tidy

#: Similarity of at least this fraction.
THRESHOLD = (4, 5)
BUCKETS = 1 << 16
#: Words from which a line's sketch has 128 bits, not 64.
WIDE = 64
#: Lines before it that a line is compared with at once, of those with which it shares a sign.
LAGS = 6
#: Rows up to which documents to look at again are sent to the tasks instead of shuffling texts.
SMALL = 200_000
#: The same for the lines to look at in them.
ENTRIES = 1_000_000
_BLANK = r"[\x20\x09-\x0D]+"


def _words(line: Column) -> Column:
    """The words of a text without line breaks."""
    # split by one character, where that is enough: no pattern is run
    odd = [F.contains(line, F.lit(c)) for c in "\x09\x0b\x0c\x0d"]
    return F.array_remove(F.when(reduce(or_, odd), F.split(line, _BLANK, -1)).otherwise(F.split(line, " ", -1)), "")


def _id(doc_id: str, text: str) -> list[Column]:
    return [F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("doc_h")]


def _hashed(word: Column) -> Column:
    """58 bits of hash."""
    return F.shiftrightunsigned(F.xxhash64(word), 6)


def _bucket(h: Column) -> Column:
    return h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def frequencies(docs: DataFrame, text: str) -> list[int]:
    """For each bucket, how often its number of words over all texts doubles an even share."""
    texts = docs.select(F.replace(F.col(text), F.lit("\n"), F.lit(" ")).alias("t"))
    counts = texts.select(F.explode(_words(F.col("t"))).alias("w")).groupBy(_bucket(_hashed(F.col("w"))).alias("b")).count().collect()
    share = sum(r["count"] for r in counts) / BUCKETS
    levels = [0] * BUCKETS
    for r in counts:
        levels[r.b] = max(0, min(31, int(2 * math.log2(r["count"] / share))))
    return levels


def _rare_first(hashes: Column, levels: list[int]) -> Column:
    """Hashes of different words as numbers that ascend from rare to frequent."""
    # folded to a literal array once; an element of it is found at once, unlike a map's
    table = F.split(F.lit(",".join(str(x << 58) if x else "0" for x in levels)), ",").cast("array<long>")
    # no element is null, and saying so lets them be sorted as plain numbers
    return F.sort_array(F.transform(hashes, lambda h: h.bitwiseOR(F.coalesce(F.get(table, _bucket(h)), F.lit(0).cast("long")))))


def _parity(keys: Column, half: bool = False) -> Column:
    """Parity of the keys over 64 places; for a half, of those only that have a bit set."""
    def place(k: Column) -> Column:
        one = F.call_function("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(F.lit(63)).cast("int"))
        return one * F.shiftright(k, 6).bitwiseAND(F.lit(1)) if half else one

    return F.aggregate(keys, F.lit(0).cast("long"), lambda acc, k: acc.bitwiseXOR(place(k)))


def _sketch(keys: Column, half: int) -> Column:
    """Parity of the keys of a line of ``n`` over 64 places; where lines are long, also of half of them."""
    return _parity(keys) if half == 0 else F.when(F.col("n") >= WIDE, _parity(keys, True)).otherwise(F.lit(0).cast("long"))


def _together(threshold: tuple[int, int]) -> int:
    """Words that follow each other in any two lines that match and differ: 2, or 1 at low thresholds.

    Of ``s`` words in all, two lines share at least ``h`` and differ in ``s - 2 * h`` at most. The shared
    ones follow each other ``h - 1`` times, of which each word they differ in parts one at most.
    """
    num, den = threshold
    if 2 * num <= den:
        return 1
    for s in range(2, 2 * (num + den) // (2 * num - den) + 2):  # for more words it holds by the slope
        h = -(-num * s // (num + den))
        if s - 2 * h >= 1 and 3 * h < s + 2:
            return 1
    return 2


def _first_words(n: Column, threshold: tuple[int, int]) -> Column:
    """How many of the first words of a line of ``n`` have to meet those of others.

    With ``m`` words in the other line and ``h`` shared at least, ``n - h`` own words differ at most, and
    ``n + m - 2 * h`` in all. A single shared word is found among the first ``n - h + 1``. Two that follow
    each other are the ``g``-th and next shared; before them ``g - 1`` words differ or more, so ``g`` is at
    most 1 more than all that differ, and their places at most that and ``n - h`` more. Both are largest
    for the least ``m``.
    """
    num, den = threshold
    least, most = F.ceil(num * n / den), F.floor(den * n / num)
    alike = n - F.ceil(num * 2 * n / (num + den))  # words that one of two lines of this size may have alone
    if _together(threshold) == 1:
        words = n - least + 1
    else:
        words = 2 * n + least + 2 - F.ceil(3 * num * (n + least) / (num + den))
    return F.when((least < n) | (most > n) | (alike >= 1), words).otherwise(0).cast("int")


def lines_of(docs: DataFrame, doc_id: str, text: str, threshold: tuple[int, int]) -> DataFrame:
    """Each line with a word: its place, class, size, sketches, prefix of rare words and ``signs``,
    which lines of similar sets are likely to share; and how many such lines the document has."""
    levels = frequencies(docs, text)
    # step by step, not in lambdas: what stands in no lambda is compiled
    # and what is selected with an explosion is computed for each of its rows
    rows = docs.select(*_id(doc_id, text), F.regexp_count(text, F.lit(f"[^{BLANKS}][^\n]*")).alias("n_lines"),
                       F.split(F.col(text), "\n", -1).alias("ts"))
    rows = rows.select("doc_id", "doc_h", "n_lines", F.posexplode("ts").alias("line", "t")).where(F.col("t").rlike(f"[^{BLANKS}]"))
    rows = rows.select("doc_id", "doc_h", "n_lines", "line", F.sort_array(F.array_distinct(
        F.transform(_words(F.col("t")), _hashed))).alias("h"))
    size = F.size("h")
    rows = rows.select("doc_id", "doc_h", "n_lines", "line", "h", size.alias("n"), _rare_first(F.col("h"), levels).alias("keys"),
                       F.round(3 * F.log(size)).cast("int").alias("about"))
    prefix = F.slice("keys", 1, _first_words(F.col("n"), threshold))
    return rows.select(
        "doc_id", "doc_h", "n_lines", "line", F.xxhash64("h").alias("cid"), "n",
        _sketch(F.col("keys"), 0).alias("s0"), _sketch(F.col("keys"), 1).alias("s1"),
        F.transform(prefix, lambda k: k.bitwiseAND(F.lit((1 << 24) - 1)).cast("int")).alias("prefix"),
        F.array(F.xxhash64(F.slice("h", 1, 2), "about"),
                F.xxhash64(F.slice("h", F.greatest(size - 1, F.lit(1)), 2), "about", F.lit(1))).alias("signs"))


def _classes(lines: DataFrame) -> DataFrame:
    """A row for each class, at its first place; ``more`` if it may have others."""
    classes = lines.groupBy("cid").agg(
        F.min(F.struct("doc_id", "line", "doc_h")).alias("at"), (F.count("*") > 1).alias("more"),
        *[F.min(c).alias(c) for c in ("n", "s0", "s1", "prefix", "signs")])  # the same in all rows of a class
    # a small number that stands for the class where many rows hold it; settled, it stays
    return classes.select("cid", F.monotonically_increasing_id().alias("id"), "at.doc_id", "at.doc_h", "at.line", "more", "n", "s0", "s1", "prefix", "signs")


def _sizes(least: Column, most: Column, threshold: tuple[int, int]) -> tuple[Column, Column]:
    """(lines of these sizes may match, words that may differ)."""
    num, den = threshold
    shared = F.floor((num * (least + most) + (num + den) - 1) / (num + den))
    return den * least >= num * most, least + most - 2 * shared


def _filters(a: dict[str, Column], b: dict[str, Column], threshold: tuple[int, int]) -> tuple[Column, Column, Column]:
    """(pair may match by size, differing sketch bits, words that may differ)."""
    least = F.least(a["n"], b["n"])
    may, allowed = _sizes(least, F.greatest(a["n"], b["n"]), threshold)
    whole, half = a["s0"].bitwiseXOR(b["s0"]), a["s1"].bitwiseXOR(b["s1"])
    wide = F.bit_count(whole.bitwiseXOR(half)) + F.bit_count(half)
    return may, F.when(least >= WIDE, wide).otherwise(F.bit_count(whole)), allowed


def _columns(names: str, prefix: str = "") -> dict[str, Column]:
    return {c: F.col(prefix + c) for c in names.split()}


def likely(classes: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (late, early), one for each class at most: the likeliest match among a few earlier
    classes that share a sign with it."""
    rows = classes.select(F.explode("signs").alias("sign"), "cid", "doc_id", "line", "n", "s0", "s1")
    order = W.partitionBy("sign").orderBy("doc_id", "line", "cid")
    one = F.struct("cid", "n", "s0", "s1")
    others = {"f": F.first(one).over(order)} | {f"l{k}": F.lag(one, k).over(order) for k in range(1, LAGS + 1)}
    rows, found = rows.withColumns(others), []
    for name in others:
        may, differ, allowed = _filters(_columns("n s0 s1"), _columns("n s0 s1", f"{name}."), threshold)
        fits = may & (differ <= allowed) & (F.col("cid") != F.col(f"{name}.cid"))
        found.append(F.when(fits, F.struct(differ.alias("differ"), F.col(f"{name}.cid").alias("early"))))
    rows = rows.select(F.col("cid").alias("late"), F.least(*found).alias("best")).where("best IS NOT NULL")
    return rows.groupBy("late").agg(F.min("best").alias("best")).select("late", "best.early")


_LOW = (1 << 32) - 1


def meeting(classes: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Classes by ``sign``, words of their prefix that follow each other: for signs that several have, not
    all of them ``gone``. ``n`` holds the flag too, ``mark`` the word ahead (0 at the beginning) and half a sketch."""
    ahead = F.when(F.col("i") > 0, F.get("prefix", F.col("i") - 1).cast("long") + 1).otherwise(F.lit(0).cast("long"))
    fold = F.col("s0").bitwiseXOR(F.shiftrightunsigned("s0", 32)).bitwiseAND(F.lit(_LOW))
    sign = F.col("word").cast("long")
    rows = classes.select("id", "n", "gone", "s0", "prefix", F.posexplode("prefix").alias("i", "word"))
    if _together(threshold) == 2:
        rows = rows.where(F.col("i") < F.size("prefix") - 1)
        sign = F.shiftleft(sign, 24).bitwiseOR(F.get("prefix", F.col("i") + 1).cast("long"))
    none = F.lit(0).cast("long")
    # one shuffle for both sides: both use all columns; none is null, and saying so keeps it one
    rows = rows.select(F.coalesce(sign, none).alias("sign"), "id", F.shiftleft(F.col("n").cast("long"), 1).bitwiseOR(F.col("gone").cast("long")).alias("n"),
                       F.coalesce(F.shiftleft(ahead, 32).bitwiseOR(fold), none).alias("mark")).repartition("sign")
    size = F.shiftright("n", 1)
    groups = rows.groupBy("sign").agg(F.count("*").alias("rows"), F.bit_xor("id").alias("ids"), F.sum(size).alias("both"), F.max(size).alias("most"),
                                      F.min(F.col("n").bitwiseAND(F.lit(1))).alias("gone"), F.bit_xor("mark").alias("marks"))
    # the sums over two tell in how many places their sketches differ
    may, allowed = _sizes(F.col("both") - F.col("most"), F.col("most"), threshold)
    pair = (F.col("ids") != 0) & may & (F.bit_count(F.col("marks").bitwiseAND(F.lit(_LOW))) <= allowed)
    several = groups.where((F.col("gone") == 0) & ((F.col("rows") > 2) | ((F.col("rows") == 2) & pair)))
    # the few signs are looked up by hash: the many rows need no sort
    several = several.select(F.col("sign").alias("_sign")).hint("shuffle_hash")
    return rows.join(several, F.col("sign") == F.col("_sign")).drop("_sign")


def candidates(classes: DataFrame, threshold: tuple[int, int], met: DataFrame | None = None) -> DataFrame:
    """Pairs (late, early) that may match, of all classes that are not ``gone`` with all earlier ones."""
    met = meeting(classes, threshold) if met is None else met
    rows = lookup_join(met, classes.select("id", "cid", "doc_id", "line", "s0", "s1"), ["id"], "inner").drop("id")
    # one shuffle again
    rows = rows.where(" AND ".join(f"{c} IS NOT NULL" for c in rows.columns if c != "doc_id")).repartition("sign")
    early = rows.select(*[F.col(c).alias(f"e_{c}") for c in rows.columns])
    a, b = ({"n": F.shiftright(f"{e}n", 1), "ahead": F.shiftrightunsigned(f"{e}mark", 32)} | _columns("cid doc_id line s0 s1", e) for e in ("", "e_"))
    may, differ, allowed = _filters(a, b, threshold)
    before = F.struct(b["doc_id"], b["line"], b["cid"]) < F.struct(a["doc_id"], a["line"], a["cid"])
    # two that have the word ahead in common as well have met by it
    first = (a["ahead"] == 0) | (a["ahead"] != b["ahead"])
    # the flag is asked with the other side's columns: alone it would be moved in front of the shuffle
    open_ = F.when(F.col("n").bitwiseAND(F.lit(1)) == 1, F.lit(-1)).otherwise(b["n"]) >= 0
    return rows.join(early, (F.col("sign") == F.col("e_sign")) & open_ & first & may & (differ <= allowed) & before).select(
        a["cid"].alias("late"), b["cid"].alias("early")).distinct()


def _few(need: DataFrame) -> bool:
    """Whether documents and the entries of their arrays, some 32 bytes each, are few enough to be broadcast."""
    rows, entries = need.agg(F.count("*"), F.coalesce(F.sum(F.size("need")), F.lit(0))).first()
    return rows <= SMALL and entries <= ENTRIES


def _places(classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each document that is looked at again, ``need``: classes and the lines they stand in."""
    places = lookup_join(classes.select("cid", "doc_id", "doc_h", "line"), wanted, ["cid"], "inner")
    return places.groupBy(F.struct("doc_id", "doc_h").alias("doc")).agg(
        F.collect_list(F.struct("cid", "line")).alias("need"))  # no more than the document has lines


def _sets(docs: DataFrame, doc_id: str, text: str, need: DataFrame) -> DataFrame:
    """``cid`` and ``words`` of the needed classes, read from the texts again."""
    rows = docs.select(F.struct(*_id(doc_id, text)).alias("_doc"), F.col(text).alias("_text"))
    need = F.broadcast(need) if _few(need) else need
    found = rows.join(need, F.col("_doc") == F.col("doc")).select("need", F.split("_text", "\n", -1).alias("t"))
    found = found.select(F.explode(F.transform(
        "need", lambda x: F.struct(x["cid"].alias("cid"), F.get("t", x["line"]).alias("t")))).alias("x"))
    return found.groupBy("x.cid").agg(F.min("x.t").alias("t")).select("cid", F.array_distinct(_words(F.col("t"))).alias("words"))


def verified(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs whose similarity reaches the threshold."""
    num, den = threshold
    late = lookup_join(pairs, sets.select(F.col("cid").alias("late"), F.col("words").alias("a")), ["late"], "inner")
    both = lookup_join(late, sets.select(F.col("cid").alias("early"), F.col("words").alias("b")), ["early"], "inner")
    shared = F.size(F.array_intersect("a", "b"))
    return both.where(den * shared >= num * (F.size("a") + F.size("b") - shared)).select("late", "early")


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """``doc_id``, ``doc_h`` (hash of the text), ``n_lines`` with words and ``removed``, the sorted
    numbers (from 0) of the lines that match an earlier one; a row for each text with words.

    A line matches whether the earlier one is itself removed or not. Lines without words stay.
    Places are ordered by id, null first, and number; rows that repeat id and text stand at the
    same places, and no line is earlier than another at its own place.
    """
    spark = docs.sparkSession
    tidy(spark)
    whole = settle(lines_of(docs, doc_id, text, threshold))
    classes = settle(_classes(whole))
    lines = settle(whole.select("cid", "doc_id", "doc_h", "n_lines", "line"))
    release(whole)
    tidy(spark)

    def matched(pairs: DataFrame) -> DataFrame:
        """The late classes of pairs that match."""
        pairs = settle(pairs)
        wanted = pairs.select(F.col("late").alias("cid")).union(pairs.select(F.col("early").alias("cid"))).distinct()
        need = settle(_places(classes, wanted))
        tidy(spark)  # the shuffle that gave the pairs
        found = settle(verified(pairs, _sets(docs, doc_id, text, need), threshold).select(
            F.col("late").alias("cid"), F.lit(True).alias("gone")).distinct())
        release(pairs)
        release(need)
        tidy(spark)
        return found

    at_once = matched(likely(classes, threshold))
    few = at_once.count() <= SMALL
    tidy(spark)  # after another job: the shuffles of the last one
    if few:
        left = classes.join(F.broadcast(at_once), "cid", "left")
    else:
        left = lookup_join(classes, at_once, ["cid"])
    left = left.withColumn("gone", F.coalesce("gone", F.lit(False)))
    met = settle(meeting(left, threshold))
    met.count()  # another job again, for the shuffle of all signs
    tidy(spark)
    gone = at_once.union(matched(candidates(left, threshold, met)))
    release(met)
    # only classes that are gone or stand in several lines have lines to remove
    some = lookup_join(classes.select("cid", F.struct("doc_id", "line").alias("first"), "more"), gone, ["cid"])
    some = settle(some.where("gone OR more").select("cid", "first", F.coalesce("gone", F.lit(False)).alias("gone")))
    release(classes)
    marked = lookup_join(lines.select("cid", "doc_id", "doc_h", "line"), some, ["cid"], "inner")
    removed = marked.where(F.col("gone") | (F.col("first") < F.struct("doc_id", "line"))).groupBy("doc_id", "doc_h").agg(
        F.sort_array(F.collect_set("line")).alias("removed"))
    every = lines.groupBy("doc_id", "doc_h").agg(F.max("n_lines").cast("long").alias("n_lines"))
    return lookup_join(every, removed, ["doc_id", "doc_h"]).select(
        "doc_id", "doc_h", "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def removed_by_row(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The same for every row of the documents; one without words has no lines."""
    found = removed_lines(docs, doc_id, text, threshold)
    rows = lookup_join(docs.select(*_id(doc_id, text)), found, ["doc_id", "doc_h"])
    return rows.select("doc_id", F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"),
                       F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The documents without the lines that match an earlier one; other columns stay.

    A document all of whose words are in removed lines is dropped; one that had no words stays.
    """
    gone = removed_lines(docs, doc_id, text, threshold).where(F.size("removed") > 0)
    gone = gone.select(F.struct("doc_id", "doc_h").alias("_k"), "removed", (F.size("removed") == F.col("n_lines")).alias("_all"))
    rows = lookup_join(docs.select(packed(docs), F.struct(*_id(doc_id, text)).alias("_k")),
                       gone.withColumnRenamed("removed", "_removed"), ["_k"])
    whole = F.col("_row")[text]
    left = let(F.split(whole, "\n", -1), lambda t: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(t) - 1), F.col("_removed")), lambda i: F.get(t, i)), "\n"))
    rows = rows.where(~F.coalesce("_all", F.lit(False)))
    return unpacked(rows, docs, {text: F.when(F.col("_removed").isNull(), whole).otherwise(left)})
